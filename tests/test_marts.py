import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.operators import marts

T = dt.datetime(2018, 1, 1)


@pytest.fixture
def dates(rows):
    return rows("date_key int, year_number int, month_number int, month_name string",
                (20180101, 2018, 1, "January"), (20180102, 2018, 1, "January"), (20190101, 2019, 1, "January"))


@pytest.fixture
def statuses(rows):
    return rows("order_status_key bigint, order_status string", (1, "delivered"))


def D(x):
    return Decimal(x)


ORDER_COLUMNS = """order_key bigint, purchase_date_key int, order_status_key bigint, order_purchase_ts timestamp_ntz,
    order_delivered_customer_ts timestamp_ntz, order_estimated_delivery_ts timestamp_ntz, is_delivered_on_time boolean"""
ITEM_COLUMNS = "order_key bigint, order_purchase_date_key int, order_status_key bigint, item_price decimal(12,2), freight_value decimal(12,2)"


def test_sales_overview(rows, dates, statuses):
    orders = rows(ORDER_COLUMNS, *[(*r, None, None, None, None) for r in ((1, 20180101, 1), (2, 20180102, 1), (3, 20190101, None), (4, None, 1))])
    items = rows(ITEM_COLUMNS, (1, 20180101, 1, D(10), None), (1, 20180101, 1, D(5), D(1)), (None, None, None, D(99), D(9)), (3, 20190101, None, None, None))
    days = marts.order_days(orders, items)
    got = {(r.year_number, r.order_status): tuple(r)[4:] for r in marts.sales_overview(days, dates, statuses).collect()}
    assert got == {
        (2018, "delivered"): (2, 2, D(15), D(1), D(6)),
        (2019, None): (1, 1, 0, 0, 0),
        (None, "delivered"): (1, 0, 0, 0, 0),
    }
    legacy = {(r.year_number, r.order_status): tuple(r)[4:] for r in marts.sales_overview(days, dates, statuses, null_sums=True).collect()}
    assert legacy[(2019, None)] == (1, 1, None, None, None)
    only = marts.sales_overview(days, dates, statuses, years=[2019]).collect()
    assert [(r.year_number, r.order_count) for r in only] == [(2019, 1)]
    assert marts.delivery_performance(days, dates, statuses).collect() == []


def test_sales_by_category(rows):
    items = rows("order_id string, product_key bigint, item_price decimal(12,2), freight_value decimal(12,2)",
                 ("a", 1, D(1), D(1)), ("a", 1, D(1), D(1)), ("b", 1, D(1), None), ("b", 2, D(4), D(1)), ("c", None, D(7), D(1)))
    products = rows("product_key bigint, product_category_key bigint", (1, 1), (2, 2), (3, 3))
    categories = rows("product_category_key bigint, product_category_name string, product_category_name_english string",
                      (1, "brinquedos", "toys"), (2, "x", ""), (3, "unused", "unused"))
    got = {r.product_category: tuple(r)[1:] for r in marts.sales_by_category(items, products, categories).collect()}
    assert got == {"toys": (3, 2, D(3), D(2), D(4)), "x": (1, 1, D(4), D(1), D(5)), "unknown": (1, 1, D(7), D(1), D(8))}


def test_payment_analysis(rows, dates):
    payments = rows("order_purchase_date_key int, purchase_year int, payment_type_key bigint, payment_installments int, payment_value decimal(12,2)",
                    (20180101, 2018, 1, 3, D(10)), (20180101, 2018, 1, 3, None), (20180102, 2018, 1, 3, D(5)), (None, None, 1, 1, D(2)), (20180101, 2018, None, 3, None))
    types = rows("payment_type_key bigint, payment_type string", (1, "card"))
    got = {(r.year_number, r.payment_type, r.payment_installments): tuple(r)[5:]
           for r in marts.payment_analysis(payments, dates, types).collect()}
    assert got == {(2018, "card", 3): (3, D(15), 7.5), (None, "card", 1): (1, D(2), 2.0), (2018, None, 3): (1, 0, None)}
    legacy = marts.payment_analysis(payments, dates, types, null_sums=True).where("payment_type IS NULL").first()
    assert legacy.total_payment_value is None
    assert {r.year_number for r in marts.payment_analysis(payments, dates, types, years=[2018]).collect()} == {2018}


def test_delivery_performance_counts_unknown_punctuality_as_late(rows, dates, statuses):
    orders = rows(
        ORDER_COLUMNS,
        (1, 20180101, 1, T, T + dt.timedelta(days=2), T + dt.timedelta(days=3), True),
        (2, 20180102, 1, T, T + dt.timedelta(days=5), None, None),
        (3, 20180102, 1, T, None, T, None),
    )
    days = marts.order_days(orders, rows(ITEM_COLUMNS))
    r = marts.delivery_performance(days, dates, statuses).collect()
    assert len(r) == 1
    assert tuple(r[0])[4:] == (2, 3.5, -1.0, 0.5)
    assert "on_time_rate" not in marts.delivery_performance(days, dates, statuses, on_time=False).columns


def test_marketing_funnel(rows, dates):
    leads = rows("mql_id string, first_contact_date_key int, marketing_origin_key bigint",
                 ("a", 20180101, 1), ("b", 20180102, 1), ("c", 20180102, None))
    deals = rows("mql_id string, declared_monthly_revenue decimal(14,2)", ("a", D(7)), ("c", None), ("zz", D(1)))
    origins = rows("marketing_origin_key bigint, origin_name string", (1, "social"))
    got = {r.marketing_origin: tuple(r)[4:] for r in marts.marketing_funnel(leads, deals, dates, origins).collect()}
    assert got == {"social": (2, 1, D(7), 0.5), None: (1, 1, 0, 1.0)}


def test_customer_satisfaction(rows, dates):
    reviews = rows("review_creation_date_key int, review_score int", (20180101, 5), (20180102, 5), (20180102, None), (None, 1))
    got = {(r.year_number, r.review_score): tuple(r)[4:] for r in marts.customer_satisfaction(reviews, dates).collect()}
    assert got == {(2018, 5): (2, 5.0), (2018, None): (1, None), (None, 1): (1, 1.0)}


def test_totals_agree_across_marts(warehouse):
    m1 = warehouse.sales_overview.agg(F.sum("order_count"), F.sum("item_count"), F.sum("gross_revenue")).first()
    assert m1[0] == warehouse.stg_orders.select("order_id").distinct().count()
    m2 = warehouse.sales_by_category.agg(F.sum("item_count"), F.sum("gross_revenue")).first()
    assert tuple(m1)[1:] == tuple(m2)
    assert warehouse.payment_analysis.agg(F.sum("payment_count")).first()[0] == warehouse.stg_payments.count()
    assert warehouse.customer_satisfaction.agg(F.sum("review_count")).first()[0] == warehouse.stg_reviews.count()
    assert warehouse.marketing_funnel.agg(F.sum("mql_count")).first()[0] == warehouse.stg_marketing_leads.count()


def test_year_selection_equals_a_filter_on_the_result(warehouse):
    for mart, years in (("sales_overview", [1996]), ("payment_analysis", [1996, 1999]), ("delivery_performance", [1997]),
                        ("customer_satisfaction", [2024]), ("marketing_funnel", [2024])):
        limited = warehouse.mart(mart, years=years)
        filtered = warehouse.table(mart).where(F.col("year_number").isin(years))
        assert sorted(map(str, limited.collect())) == sorted(map(str, filtered.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_selection_reads_only_its_files_and_no_mart_joins_the_orders(warehouse):
    assert "GreaterThanOrEqual(purchase_date_key,19960101)" in plan(warehouse.mart("sales_overview", years=[1996]))
    pruned = re.compile(r"PartitionFilters: \[[^]]*purchase_year#\d+ = 199\d|PartitionFilters: \[[^]]*purchase_year#\d+ IN \(")
    for years in ([1996], [1996, 1997]):
        assert pruned.search(plan(warehouse.mart("payment_analysis", years=years))), years
    for mart in ("sales_overview", "payment_analysis", "delivery_performance"):
        assert "order_key" not in plan(warehouse.mart(mart)), mart
    for fact in ("fact_orders", "fact_order_items", "fact_payments"):
        assert "purchase_year" not in warehouse.table(fact).columns
        limited = warehouse.whole(fact).where("purchase_year = 1997")
        assert pruned.search(plan(limited)), fact
        assert 0 < limited.count() < warehouse.table(fact).count()


def test_the_rollup_reads_each_fact_once(warehouse):
    days = marts.order_days(warehouse.rows("fact_orders"), warehouse.rows("fact_order_items"))
    assert plan(days).count("FileScan") == 2 and "Join" not in plan(days)


def test_sums_by_category_do_not_move_with_each_order(warehouse, setting):
    setting("spark.sql.adaptive.enabled", "false")
    moved = [x for x in re.split(r"(?=Exchange hashpartitioning)", plan(warehouse.table("sales_by_category"))) if re.match(r"[^\n]*product_category#\d+, order_id#", x)]
    assert moved and all("functions=[]" in x.split("\n")[1] for x in moved)
