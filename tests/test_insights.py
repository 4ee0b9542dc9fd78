"""Break-downs are compared with pandas on the same mart rows."""

import datetime as dt

import pandas as pd
import pytest

from marketloom.operators import insights as bi

SALES = "year_number int, month_number int, order_status string, order_count bigint, item_count bigint, gross_revenue decimal(24,2)"


@pytest.fixture
def sales(rows):
    return rows(SALES, (2017, 1, "delivered", 3, 4, None), (2017, 1, None, 2, 2, None), (2018, 2, "new", 5, 9, None),
                (None, None, "new", 1, 1, None)).withColumn("gross_revenue", bi.F.col("item_count").cast("decimal(24,2)") * 10)


def test_years(sales):
    assert [r.year_number for r in bi.available_years(sales).collect()] == [2017, 2018]
    assert bi.in_years(sales, []).count() == 4 and bi.in_years(sales, None).count() == 4
    assert bi.in_years(sales, [2017, 2018]).count() == 3


def test_sales_figures(sales):
    assert tuple(bi.sales_kpis(sales).first()) == (160.0, 11, 16, 160.0 / 11)
    assert tuple(bi.sales_kpis(sales.where("false")).first()) == (0.0, 0, 0, 0.0)
    monthly = {r.period: (float(r.gross_revenue), r.order_count) for r in bi.monthly_sales(sales).collect()}
    assert monthly == {dt.date(2017, 1, 1): (60.0, 5), dt.date(2018, 2, 1): (90.0, 5)}
    assert [tuple(r) for r in bi.orders_by_status(sales).collect()] == [("delivered", 3, 3 / 9), ("new", 6, 6 / 9)]


def test_top_categories_break_ties_by_name(rows):
    df = rows("product_category string, item_count int, order_count int, gross_revenue int", *[(f"c{i:02d}", 1, 1, i // 2) for i in range(40)])
    got = [r.product_category for r in bi.top_categories(df).collect()]
    assert len(got) == 15 and got[:3] == ["c38", "c39", "c36"]
    plan = bi.top_categories(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_payment_figures(rows):
    df = rows("payment_type string, payment_installments int, payment_count bigint, total_payment_value double",
              ("card", 3, 2, 10.0), ("card", None, 1, 5.0), (None, 1, 1, 1.0), ("slip", 1, 4, 40.0))
    assert tuple(bi.payment_kpis(df).first()) == (56.0, 8, 7.0, 11 / 8)
    assert tuple(bi.payment_kpis(df.where("false")).first()) == (0.0, 0, 0.0, 0.0)
    assert [tuple(r) for r in bi.payments_by_type(df).collect()] == [("slip", 40.0, 4), ("card", 15.0, 3)]
    assert [tuple(r) for r in bi.installment_distribution(df).collect()] == [(1, 5), (3, 2)]


def test_satisfaction_figures(rows):
    df = rows("year_number int, month_number int, review_score int, review_count bigint",
              (2018, 1, 5, 6), (2018, 1, 1, 2), (2018, 2, 3, 1), (2018, 2, None, 1), (None, None, 4, 10))
    assert tuple(bi.satisfaction_kpis(df).first()) == (20, (30 + 2 + 3 + 40) / 20, 16 / 20, 2 / 20)
    assert tuple(bi.satisfaction_kpis(df.where("false")).first()) == (0, 0.0, 0.0, 0.0)
    monthly = {r.period.month: (r.avg_score, r.review_count) for r in bi.monthly_satisfaction(df).collect()}
    assert monthly == {1: (4.0, 8), 2: (1.5, 2)}
    assert [tuple(r) for r in bi.score_distribution(df).collect()] == [(1, 2), (3, 1), (4, 10), (5, 6)]


def test_delivery_figures_count_missing_averages_as_zero(rows):
    df = rows("year_number int, month_number int, order_status string, delivered_orders bigint, avg_days_purchase_to_delivery double, avg_days_vs_estimate double, on_time_rate double",
              (2018, 1, "delivered", 3, 2.0, None, 1.0), (2018, 1, "late", 1, 6.0, 4.0, 0.0), (2018, 2, None, 4, 1.0, 1.0, 0.5))
    assert tuple(bi.delivery_kpis(df).first()) == (8, 16 / 8, 8 / 8, 5 / 8)
    assert tuple(bi.delivery_kpis(df.where("false")).first()) == (0, 0.0, 0.0, 0.0)
    assert {r.period.month: tuple(r)[1:] for r in bi.monthly_delivery(df).collect()} == {1: (3.0, 0.75), 2: (1.0, 0.5)}
    assert [tuple(r) for r in bi.on_time_by_status(df).collect()] == [("late", 0.0), ("delivered", 1.0)]


def test_funnel_figures(rows):
    df = rows("marketing_origin string, mql_count bigint, won_deal_count bigint, declared_monthly_revenue_sum double",
              ("a", 10, 1, 5.0), ("b", 4, 2, 1234.6), ("c", 0, 0, 0.0), (None, 2, 1, 1.0))
    assert tuple(bi.funnel_kpis(df).first()) == (16, 4, 1240.6, 0.25)
    assert [(r[0], r[4]) for r in bi.funnel_by_origin(df).collect()] == [("a", 0.1), ("b", 0.5), ("c", None)]
    assert [r[0] for r in bi.funnel_by_origin(df, 1).collect()] == ["a"]
    assert [r[0] for r in bi.conversion_ranking(df).collect()] == ["b", "a", "c"]
    shown = {r.marketing_origin: (r.conversion_rate, r.declared_monthly_revenue_sum) for r in bi.origin_table(df).collect()}
    assert shown == {"a": ("10.0 %", "R$ 5"), "b": ("50.0 %", "R$ 1 235"), "c": ("0.0 %", "R$ 0")}


def test_monthly_delivery_agrees_with_pandas(warehouse):
    pdf = bi.with_period(warehouse.delivery_performance).toPandas()
    pdf = pdf[pdf.period.notna()]
    weighted = (pdf.on_time_rate.fillna(0) * pdf.delivered_orders).groupby(pdf.period).sum()
    expected = (weighted / pdf.delivered_orders.groupby(pdf.period).sum()).sort_index()
    got = bi.monthly_delivery(warehouse.delivery_performance).toPandas().set_index("period").on_time_rate.sort_index()
    pd.testing.assert_series_equal(got, expected, check_names=False)


def test_detail_pages_are_ordered_with_missing_keys_last(warehouse):
    page = bi.detail_page("sales_overview", warehouse.sales_overview).collect()
    order = [(r.year_number or 9999, r.month_number or 99, r.order_status or "~") for r in page]
    assert order == sorted(order)
    for mart in ("payment_analysis", "customer_satisfaction", "delivery_performance", "marketing_funnel"):
        assert bi.detail_page(mart, warehouse.table(mart), [1996, 2024]).where("year_number IS NULL").count() == 0
