"""Figures, rankings and detail pages drawn from the marts.

Group keys that are NULL are left out of break-downs but stay in totals. Weighted means are
plain aggregates. Rankings add the label as a tie-breaker, so their order is always the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.display import as_brl, as_count, as_fixed, as_percent
from marketloom.functions.timing import period_start

TOP = 15


def _sum0(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _amount(c: str) -> Column:
    return _sum0(c).cast("double")


def _ratio(part: Column, whole: Column, otherwise: float | None = 0.0) -> Column:
    """Division as double; `otherwise` where the whole is 0 or NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(otherwise).cast("double"))


def _by(df: DataFrame, key: str):
    return df.where(F.col(key).isNotNull()).groupBy(key)


def available_years(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("year_number").isNotNull()).select("year_number").distinct().orderBy("year_number")


def in_years(mart: DataFrame, years: list[int] | None) -> DataFrame:
    """No selection keeps everything, rows without a year included; a selection drops those."""
    return mart.where(F.col("year_number").isin(list(years))) if years else mart


def with_period(mart: DataFrame) -> DataFrame:
    return mart.withColumn("period", period_start("year_number", "month_number"))


def sales_kpis(sales: DataFrame) -> DataFrame:
    totals = sales.agg(
        _amount("gross_revenue").alias("total_revenue"),
        _sum0("order_count").alias("total_orders"),
        _sum0("item_count").alias("total_items"),
    )
    return totals.withColumn("avg_order_value", _ratio(F.col("total_revenue"), F.col("total_orders")))


def monthly_sales(sales: DataFrame) -> DataFrame:
    return _by(with_period(sales), "period").agg(
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("order_count").alias("order_count"),
        F.sum("item_count").alias("item_count"),
    )


def orders_by_status(sales: DataFrame) -> DataFrame:
    """Orders and share per status, fewest first. The window runs over one row per status."""
    counts = _by(sales, "order_status").agg(F.sum("order_count").alias("order_count"))
    share = _ratio(F.col("order_count"), F.sum("order_count").over(Window.partitionBy(F.lit(1))), None)
    return counts.withColumn("share", share).orderBy("order_count", "order_status")


def top_categories(categories: DataFrame, n: int = TOP) -> DataFrame:
    return (
        categories.select("product_category", "item_count", "order_count", "gross_revenue")
        .orderBy(F.desc("gross_revenue"), "product_category")
        .limit(n)
    )


def payment_kpis(payments: DataFrame) -> DataFrame:
    """Totals, mean payment and mean installments weighted by payments (missing ones count as 0)."""
    weighted = F.coalesce("payment_installments", F.lit(0)) * F.col("payment_count")
    totals = payments.agg(
        _amount("total_payment_value").alias("total_value"),
        _sum0("payment_count").alias("total_count"),
        F.sum(weighted).alias("installments"),
    )
    return totals.select(
        "total_value",
        "total_count",
        _ratio(F.col("total_value"), F.col("total_count")).alias("avg_payment"),
        _ratio(F.col("installments"), F.col("total_count")).alias("avg_installments"),
    )


def payments_by_type(payments: DataFrame) -> DataFrame:
    return (
        _by(payments, "payment_type")
        .agg(F.sum("total_payment_value").alias("total_payment_value"), F.sum("payment_count").alias("payment_count"))
        .orderBy(F.desc("total_payment_value"), "payment_type")
    )


def installment_distribution(payments: DataFrame) -> DataFrame:
    return (
        _by(payments, "payment_installments")
        .agg(F.sum("payment_count").alias("payment_count"))
        .orderBy("payment_installments")
    )


def satisfaction_kpis(reviews: DataFrame) -> DataFrame:
    """Reviews, mean score and shares of good (4, 5) and bad (1, 2) reviews.

    Reviews without a score weigh on the denominator only.
    """
    n = F.col("review_count")
    totals = reviews.agg(
        _sum0("review_count").alias("total_reviews"),
        F.sum(F.col("review_score") * n).alias("points"),
        F.sum(F.when(F.col("review_score").isin(4, 5), n)).alias("good"),
        F.sum(F.when(F.col("review_score").isin(1, 2), n)).alias("bad"),
    )
    whole = F.col("total_reviews")
    return totals.select(
        "total_reviews",
        _ratio(F.col("points"), whole).alias("weighted_score"),
        _ratio(F.col("good"), whole).alias("positive_share"),
        _ratio(F.col("bad"), whole).alias("negative_share"),
    )


def monthly_satisfaction(reviews: DataFrame) -> DataFrame:
    n = F.sum("review_count")
    points = _sum0(F.col("review_score") * F.col("review_count"))
    return _by(with_period(reviews), "period").agg(
        _ratio(points, n, None).alias("avg_score"), n.alias("review_count")
    )


def score_distribution(reviews: DataFrame) -> DataFrame:
    return _by(reviews, "review_score").agg(F.sum("review_count").alias("review_count")).orderBy("review_score")


def _weighted(c: str) -> Column:
    """Mean weighted by delivered orders, where a missing value counts as 0 with full weight."""
    return F.sum(F.coalesce(c, F.lit(0.0)) * F.col("delivered_orders"))


def delivery_kpis(delivery: DataFrame) -> DataFrame:
    whole = F.sum("delivered_orders")
    return delivery.agg(
        _sum0("delivered_orders").alias("total_delivered"),
        _ratio(_weighted("avg_days_purchase_to_delivery"), whole).alias("avg_delivery_days"),
        _ratio(_weighted("avg_days_vs_estimate"), whole).alias("avg_days_vs_estimate"),
        _ratio(_weighted("on_time_rate"), whole).alias("on_time_rate"),
    )


def monthly_delivery(delivery: DataFrame) -> DataFrame:
    whole = F.sum("delivered_orders")
    return _by(with_period(delivery), "period").agg(
        _ratio(_weighted("avg_days_purchase_to_delivery"), whole, None).alias("avg_days_purchase_to_delivery"),
        _ratio(_weighted("on_time_rate"), whole, None).alias("on_time_rate"),
    )


def on_time_by_status(delivery: DataFrame) -> DataFrame:
    return (
        _by(delivery, "order_status")
        .agg(_ratio(_weighted("on_time_rate"), F.sum("delivered_orders")).alias("on_time_rate"))
        .orderBy("on_time_rate", "order_status")
    )


def funnel_kpis(funnel: DataFrame) -> DataFrame:
    totals = funnel.agg(
        _sum0("mql_count").alias("total_leads"),
        _sum0("won_deal_count").alias("total_deals"),
        _amount("declared_monthly_revenue_sum").alias("revenue"),
    )
    return totals.withColumn("conversion", _ratio(F.col("total_deals"), F.col("total_leads")))


def funnel_by_origin(funnel: DataFrame, n: int = TOP) -> DataFrame:
    """Origins with most leads; conversion is NULL where there were none."""
    sums = _by(funnel, "marketing_origin").agg(
        F.sum("mql_count").alias("mql_count"),
        F.sum("won_deal_count").alias("won_deal_count"),
        F.sum("declared_monthly_revenue_sum").alias("declared_monthly_revenue_sum"),
    )
    conversion = _ratio(F.col("won_deal_count"), F.col("mql_count"), None)
    return (
        sums.withColumn("conversion_rate", conversion)
        .orderBy(F.desc("mql_count"), "marketing_origin")
        .limit(n)
    )


def conversion_ranking(funnel: DataFrame, n: int = TOP) -> DataFrame:
    """The same origins, best conversion first."""
    return funnel_by_origin(funnel, n).orderBy(F.desc_nulls_last("conversion_rate"), "marketing_origin")


# Columns of the detail pages and the column that orders them after year and month.
_PAGES = {
    "sales_overview": (["order_status"], ["order_count", "item_count", "gross_revenue"]),
    "payment_analysis": (["payment_type", "payment_installments"], ["payment_count", "total_payment_value"]),
    "customer_satisfaction": (["review_score"], ["review_count"]),
    "delivery_performance": (
        ["order_status"],
        ["delivered_orders", "avg_days_purchase_to_delivery", "avg_days_vs_estimate", "on_time_rate"],
    ),
    "marketing_funnel": (
        ["marketing_origin"],
        ["mql_count", "won_deal_count", "declared_monthly_revenue_sum", "conversion_rate"],
    ),
}


def detail_page(mart_name: str, mart: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Year-filtered rows of a mart in reading order, missing keys last."""
    keys, measures = _PAGES[mart_name]
    order = [F.asc_nulls_last(c) for c in ["year_number", "month_number", *keys]]
    return (
        in_years(mart, years)
        .select("year_number", "month_number", "month_name", *keys, *measures)
        .orderBy(*order)
    )


def sales_cards(sales: DataFrame) -> DataFrame:
    """Headline sales figures as display text."""
    return sales_kpis(sales).select(
        as_brl(F.col("total_revenue")).alias("revenue"),
        as_count(F.col("total_orders")).alias("orders"),
        as_count(F.col("total_items")).alias("items"),
        as_brl(F.col("avg_order_value")).alias("basket"),
    )


def payment_cards(payments: DataFrame) -> DataFrame:
    """Headline payment figures as display text."""
    return payment_kpis(payments).select(
        as_brl(F.col("total_value")).alias("value"),
        as_count(F.col("total_count")).alias("payments"),
        as_brl(F.col("avg_payment")).alias("mean_payment"),
        as_fixed(F.col("avg_installments"), 2).alias("mean_installments"),
    )


def satisfaction_cards(reviews: DataFrame) -> DataFrame:
    """Headline review figures as display text."""
    return satisfaction_kpis(reviews).select(
        as_count(F.col("total_reviews")).alias("reviews"),
        as_fixed(F.col("weighted_score"), 2, "/ 5").alias("mean_score"),
        as_percent(F.col("positive_share")).alias("good"),
        as_percent(F.col("negative_share")).alias("bad"),
    )


def delivery_cards(delivery: DataFrame) -> DataFrame:
    """Headline delivery figures as display text."""
    return delivery_kpis(delivery).select(
        as_count(F.col("total_delivered")).alias("delivered"),
        as_fixed(F.col("avg_delivery_days"), 1, "jours").alias("mean_delay"),
        as_fixed(F.col("avg_days_vs_estimate"), 1, "jours").alias("against_estimate"),
        as_percent(F.col("on_time_rate")).alias("on_time"),
    )


def funnel_cards(funnel: DataFrame) -> DataFrame:
    """Headline funnel figures as display text."""
    return funnel_kpis(funnel).select(
        as_count(F.col("total_leads")).alias("leads"),
        as_count(F.col("total_deals")).alias("deals"),
        as_percent(F.col("conversion")).alias("conversion"),
        as_brl(F.col("revenue")).alias("revenue"),
    )


def origin_table(funnel: DataFrame) -> DataFrame:
    """Top origins with conversion and revenue as display text."""
    return funnel_by_origin(funnel).withColumns(
        {
            "conversion_rate": as_percent(F.col("conversion_rate")),
            "declared_monthly_revenue_sum": as_brl(F.col("declared_monthly_revenue_sum")),
        }
    )
