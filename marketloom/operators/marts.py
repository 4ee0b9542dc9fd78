"""The six analytical marts.

Each mart first aggregates the fact on its integer keys and only then looks up the dimension
attributes, so the lookups touch a few thousand rows whatever the size of the fact. Lookups are
left joins: unresolved keys end up in a NULL group. Sums stay decimal and durations are summed
as exact decimals, so a result does not depend on the order in which partitions arrive.

Sales and deliveries come from one rollup by purchase day and status (`order_days`), a few thousand rows from which
every month, year selection and legacy form follows. It and the payments are grouped by the order's day, which
items and payments carry, so no mart joins a fact to the orders.

`years` limits a mart to calendar years by a range on the date key, and payments also by the year that their files are
split by, so that other years are not read; rows without a date then drop out, as with a filter on the result.
`null_sums` keeps the sum of nothing as NULL instead of 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.text import UNKNOWN
from marketloom.functions.timing import DAY, elapsed_seconds
from marketloom.operators.facts import ORDER_DAY, ORDER_STATUS, YEAR

MONTH = ["year_number", "month_number", "month_name"]


def _in_years(df: DataFrame, date_key: str, years: list[int] | None) -> DataFrame:
    if not years:
        return df
    ranges = [F.col(date_key).between(y * 10000 + 101, y * 10000 + 1231) for y in years]
    return df.where(reduce(Column.__or__, ranges))


def _total(c: Column | str, null_sums: bool) -> Column:
    total = F.sum(c).cast("decimal(38,2)")
    return total if null_sums else F.coalesce(total, F.lit(0).cast("decimal(38,2)"))


def _mean(total: str, n: str) -> Column:
    """Mean of a partial sum over a partial count as double, NULL when nothing was counted."""
    return F.try_divide(F.sum(total).cast("double"), F.sum(n).cast("double"))


def _with_month(df: DataFrame, date_key: str, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select(F.col("date_key").alias(date_key), *MONTH)
    return df.join(days, date_key, "left")


_SALES = ("orders", "items", "price", "freight", "revenue")
_DELIVERY = ("delivered", "taken", "taken_n", "late", "late_n", "punctual")


def order_days(fact_orders: DataFrame, fact_items: DataFrame) -> DataFrame:
    """Counts and sums by purchase day and status of the order: each fact is read and grouped once.

    fact_orders holds one row per order, so counting rows counts distinct orders. An order that was not
    delivered has no part in the delivery figures; an unknown punctuality counts as late.
    """
    by = ["purchase_date_key", "order_status_key"]
    delivered = F.col("order_delivered_customer_ts").isNotNull()
    taken = elapsed_seconds("order_purchase_ts", "order_delivered_customer_ts")
    late = elapsed_seconds("order_estimated_delivery_ts", "order_delivered_customer_ts")
    orders = fact_orders.groupBy(*by).agg(
        F.count("*").alias("orders"),
        F.count_if(delivered).alias("delivered"),
        F.sum(taken).alias("taken"),
        F.count(taken).alias("taken_n"),
        F.sum(late).alias("late"),
        F.count(late).alias("late_n"),
        F.count_if(delivered & F.col("is_delivered_on_time")).alias("punctual"),
    )
    items = (
        fact_items.where(F.col("order_key").isNotNull())
        .groupBy(F.col(ORDER_DAY).alias(by[0]), F.col(ORDER_STATUS).alias(by[1]))
        .agg(
            F.count("*").alias("items"),
            F.sum("item_price").alias("price"),
            F.sum("freight_value").alias("freight"),
            F.sum(F.col("item_price") + F.col("freight_value")).alias("revenue"),
        )
    )
    both = orders.unionByName(items, allowMissingColumns=True)
    return both.groupBy(*by).agg(*(F.sum(c).alias(c) for c in (*_SALES, *_DELIVERY)))


def _by_month_and_status(days: DataFrame, dim_date: DataFrame, dim_status: DataFrame):
    named = _with_month(days, "purchase_date_key", dim_date)
    statuses = dim_status.select("order_status_key", "order_status")
    return named.join(statuses, "order_status_key", "left").groupBy(*MONTH, "order_status")


def sales_overview(
    days: DataFrame,
    dim_date: DataFrame,
    dim_status: DataFrame,
    years: list[int] | None = None,
    null_sums: bool = False,
) -> DataFrame:
    """Monthly sales by order status, from `order_days`. A line without price or freight has no gross revenue."""
    return _by_month_and_status(_in_years(days, "purchase_date_key", years), dim_date, dim_status).agg(
        F.sum("orders").alias("order_count"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("item_count"),
        _total("price", null_sums).alias("gross_item_value"),
        _total("freight", null_sums).alias("gross_freight_value"),
        _total("revenue", null_sums).alias("gross_revenue"),
    )


def sales_by_category(fact_items: DataFrame, dim_product: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Sales of all times and statuses by category, English name first.

    Orders are counted in two steps, per (category, order) and then per category, so a category
    with a third of all lines is spread by its orders. The sums go by category at once, beside it: only the
    names of the orders move by (category, order), not three sums with each.
    """
    named = dim_product.select("product_key", "product_category_key").join(
        dim_category.select(
            "product_category_key",
            F.coalesce(
                F.nullif("product_category_name_english", F.lit("")), "product_category_name"
            ).alias("name"),
        ),
        "product_category_key",
        "left",
    )
    lines = fact_items.select("order_id", "product_key", "item_price", "freight_value").join(
        named.select("product_key", "name"), "product_key", "left"
    )
    lines = lines.withColumn("product_category", F.coalesce("name", F.lit(UNKNOWN)))
    sums = lines.groupBy("product_category").agg(
        F.count("*").alias("item_count"),
        _total("item_price", False).alias("gross_item_value"),
        _total("freight_value", False).alias("gross_freight_value"),
        _total(F.col("item_price") + F.col("freight_value"), False).alias("gross_revenue"),
    )
    orders = lines.select("product_category", "order_id").distinct().groupBy("product_category").agg(F.count("order_id").alias("order_count"))
    return sums.join(orders, "product_category").select(
        "product_category", "item_count", "order_count", "gross_item_value", "gross_freight_value", "gross_revenue"
    )


def payment_analysis(
    fact_payments: DataFrame,
    dim_date: DataFrame,
    dim_payment_type: DataFrame,
    years: list[int] | None = None,
    null_sums: bool = False,
) -> DataFrame:
    """Payments by purchase month of their order, type and number of installments."""
    paid = fact_payments.where(F.col(YEAR).isin(years)) if years else fact_payments
    by_key = paid.groupBy(F.col(ORDER_DAY).alias("purchase_date_key"), "payment_type_key", "payment_installments").agg(
        F.count("*").alias("payments"),
        F.sum("payment_value").alias("value"),
        F.count("payment_value").alias("valued"),
    )
    return (
        _with_month(by_key, "purchase_date_key", dim_date)
        .join(dim_payment_type.select("payment_type_key", "payment_type"), "payment_type_key", "left")
        .groupBy(*MONTH, "payment_type", "payment_installments")
        .agg(
            F.sum("payments").alias("payment_count"),
            _total("value", null_sums).alias("total_payment_value"),
            _mean("value", "valued").alias("avg_payment_value"),
        )
    )


def customer_satisfaction(fact_reviews: DataFrame, dim_date: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Reviews by month of creation and score."""
    by_key = (
        _in_years(fact_reviews.select("review_creation_date_key", "review_score"), "review_creation_date_key", years)
        .groupBy("review_creation_date_key", "review_score")
        .agg(F.count("*").alias("reviews"))
    )
    return (
        _with_month(by_key, "review_creation_date_key", dim_date)
        .groupBy(*MONTH, "review_score")
        .agg(F.sum("reviews").alias("review_count"), F.avg("review_score").alias("avg_review_score"))
    )


def delivery_performance(
    days: DataFrame,
    dim_date: DataFrame,
    dim_status: DataFrame,
    years: list[int] | None = None,
    on_time: bool = True,
) -> DataFrame:
    """Delivered orders by purchase month and status, from `order_days`; an unknown punctuality counts as late."""
    delivered = _in_years(days.where("delivered > 0"), "purchase_date_key", years)
    mean = lambda total, n: _mean(total, n) / F.lit(float(DAY))
    measures = [
        F.sum("delivered").alias("delivered_orders"),
        mean("taken", "taken_n").alias("avg_days_purchase_to_delivery"),
        mean("late", "late_n").alias("avg_days_vs_estimate"),
    ]
    if on_time:
        measures.append(_mean("punctual", "delivered").alias("on_time_rate"))
    return _by_month_and_status(delivered, dim_date, dim_status).agg(*measures)


def marketing_funnel(
    fact_leads: DataFrame,
    fact_deals: DataFrame,
    dim_date: DataFrame,
    dim_origin: DataFrame,
    years: list[int] | None = None,
    null_sums: bool = False,
    conversion: bool = True,
) -> DataFrame:
    """Leads, won deals and declared revenue by first-contact month and origin.

    Distinct leads and deals are counted by grouping once more on the lead id the join has
    already partitioned by, which costs no further shuffle.
    """
    leads = _in_years(
        fact_leads.select("mql_id", "first_contact_date_key", "marketing_origin_key"), "first_contact_date_key", years
    )
    deals = fact_deals.select("mql_id", F.lit(1).alias("won"), "declared_monthly_revenue")
    per_lead = (
        leads.join(deals, "mql_id", "left")
        .groupBy("mql_id", "first_contact_date_key", "marketing_origin_key")
        .agg(F.max("won").alias("won"), F.sum("declared_monthly_revenue").alias("revenue"))
    )
    by_key = per_lead.groupBy("first_contact_date_key", "marketing_origin_key").agg(
        F.count("mql_id").alias("leads"), F.count("won").alias("deals"), F.sum("revenue").alias("revenue")
    )
    measures = [
        F.sum("leads").alias("mql_count"),
        F.sum("deals").alias("won_deal_count"),
        _total("revenue", null_sums).alias("declared_monthly_revenue_sum"),
    ]
    if conversion:
        measures.append(F.coalesce(_mean("deals", "leads"), F.lit(0.0)).alias("conversion_rate"))
    return (
        _with_month(by_key, "first_contact_date_key", dim_date)
        .join(dim_origin.select("marketing_origin_key", F.col("origin_name").alias("marketing_origin")), "marketing_origin_key", "left")
        .groupBy(*MONTH, "marketing_origin")
        .agg(*measures)
    )
