"""Fact tables before key assignment, in two steps.

`resolve_*` adds the keys of the dimensions, `measure_*` derives dates, durations and flags from
the row alone. Only the first needs other tables, so whatever is shuffled or sampled in between
carries the source columns and keys, and the derived ones are computed afterwards.

Items and payments also carry the purchase day of their order, and items its status. These columns and the
purchase year are stored with the facts but hidden (`HIDDEN_COLUMNS`): sales and payments are grouped by
them without going back to the orders, and files are split by year.

Every lookup is a left join against a table that is unique on the joined column, so rows are
never lost or multiplied (a table that broke its key could multiply them: the runner's gate stops
before that, unless it was told to go on). Spark broadcasts a dimension when its files are small enough and
otherwise shuffles; adaptive execution then splits a hot key or the NULL group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.text import UNKNOWN, has_content
from marketloom.functions.timing import DAY, HOUR, date_key, elapsed


ORDER_DAY, ORDER_STATUS, YEAR = "order_purchase_date_key", "order_status_key", "purchase_year"
HIDDEN_COLUMNS = {
    "fact_orders": [YEAR],
    "fact_order_items": [ORDER_DAY, ORDER_STATUS, YEAR],
    "fact_payments": [ORDER_DAY, YEAR],
}


def _year_of(day: str) -> Column:
    return F.floor(F.col(day) / 10000).cast("int").alias(YEAR)


def _lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], keys: dict[str, str]) -> DataFrame:
    """Left join on `fact column -> dimension column`, adding `new name -> dimension key`."""
    right = dim.select(
        *[F.col(d).alias(f"__on_{i}") for i, d in enumerate(on.values())],
        *[F.col(k).alias(new) for new, k in keys.items()],
    )
    matches = [F.col(f) == F.col(f"__on_{i}") for i, f in enumerate(on)]
    condition = matches[0]
    for m in matches[1:]:
        condition = condition & m
    return df.join(right, condition, "left").drop(*[f"__on_{i}" for i in range(len(on))])


def resolve_marketing_leads(stg: DataFrame, dim_landing_page: DataFrame, dim_origin: DataFrame) -> DataFrame:
    out = _lookup(stg, dim_landing_page, {"landing_page_id": "landing_page_id"}, {"landing_page_key": "landing_page_key"})
    return _lookup(out, dim_origin, {"origin": "origin_name"}, {"marketing_origin_key": "marketing_origin_key"})


def measure_marketing_leads(df: DataFrame) -> DataFrame:
    return df.select(
        "mql_id",
        date_key("first_contact_date").alias("first_contact_date_key"),
        "landing_page_key",
        "marketing_origin_key",
        F.lit(1).alias("lead_count"),
    )


def resolve_closed_deals(
    stg: DataFrame,
    dim_seller: DataFrame,
    dim_sales_rep: DataFrame,
    dim_segment: DataFrame,
    dim_lead_type: DataFrame,
    dim_lead_profile: DataFrame,
) -> DataFrame:
    out = _lookup(stg, dim_seller, {"seller_id": "seller_id"}, {"seller_key": "seller_key"})
    for column, role in (("sdr_id", "SDR"), ("sr_id", "SR")):
        reps = dim_sales_rep.where(F.col("sales_role") == role)
        out = _lookup(out, reps, {column: "sales_rep_id"}, {f"{role.lower()}_sales_rep_key": "sales_rep_key"})
    for dim, column, key in (
        (dim_segment, "business_segment", "business_segment_key"),
        (dim_lead_type, "lead_type", "lead_type_key"),
        (dim_lead_profile, "lead_behaviour_profile", "lead_profile_key"),
    ):
        out = _lookup(out, dim, {column: column}, {key: key})
    return out


def measure_closed_deals(df: DataFrame) -> DataFrame:
    return df.select(
        "mql_id",
        "seller_key",
        date_key("won_ts").alias("won_date_key"),
        "sdr_sales_rep_key",
        "sr_sales_rep_key",
        "business_segment_key",
        "lead_type_key",
        "lead_profile_key",
        "has_company",
        "has_gtin",
        "average_stock",
        "business_type",
        "declared_product_catalog_size",
        "declared_monthly_revenue",
        F.col("seller_key").isNotNull().alias("is_active_seller"),
        F.lit(1).alias("deal_count"),
    )


def resolve_orders(stg: DataFrame, dim_customer: DataFrame, dim_status: DataFrame) -> DataFrame:
    """A missing status finds the `unknown` member; a blank one finds nothing and keeps a NULL key."""
    out = _lookup(stg, dim_customer, {"customer_id": "customer_id"}, {"customer_key": "customer_key"})
    out = out.withColumn("status_label", F.coalesce("order_status", F.lit(UNKNOWN)))
    out = _lookup(out, dim_status, {"status_label": "order_status"}, {"order_status_key": "order_status_key"})
    return out.drop("customer_id", "order_status", "status_label")


_ORDER_TIMES = {
    "purchase": "order_purchase_ts",
    "approved": "order_approved_ts",
    "delivered_carrier": "order_delivered_carrier_ts",
    "delivered_customer": "order_delivered_customer_ts",
    "estimated_delivery": "order_estimated_delivery_ts",
}


def measure_orders(df: DataFrame) -> DataFrame:
    """Durations count from the purchase; the delay is negative for an early delivery."""
    at = _ORDER_TIMES
    bought, delivered, promised = at["purchase"], at["delivered_customer"], at["estimated_delivery"]
    return df.select(
        "order_id",
        "customer_key",
        "order_status_key",
        *[date_key(c).alias(f"{role}_date_key") for role, c in at.items()],
        *at.values(),
        elapsed(bought, at["approved"], HOUR).alias("approval_delay_hours"),
        elapsed(bought, at["delivered_carrier"], DAY).alias("days_to_carrier"),
        elapsed(bought, delivered, DAY).alias("days_to_customer"),
        elapsed(bought, promised, DAY).alias("estimated_delivery_days"),
        elapsed(promised, delivered, DAY).alias("delivery_delay_days"),
        (F.col(delivered) <= F.col(promised)).alias("is_delivered_on_time"),
        F.col(delivered).isNotNull().alias("is_delivered"),
        F.lit(1).alias("order_count"),
        F.year(bought).alias(YEAR),
    )


def resolve_order_items(
    stg: DataFrame, fact_orders: DataFrame, dim_product: DataFrame, dim_seller: DataFrame
) -> DataFrame:
    order = {"order_key": "order_key", ORDER_DAY: "purchase_date_key", ORDER_STATUS: "order_status_key"}
    out = _lookup(stg, fact_orders, {"order_id": "order_id"}, order)
    out = _lookup(out, dim_product, {"product_id": "product_id"}, {"product_key": "product_key"})
    out = _lookup(out, dim_seller, {"seller_id": "seller_id"}, {"seller_key": "seller_key"})
    return out.drop("product_id", "seller_id")


def measure_order_items(df: DataFrame) -> DataFrame:
    nothing = F.lit(0).cast("decimal(12,2)")
    total = F.coalesce("price", nothing) + F.coalesce("freight_value", nothing)
    return df.select(
        "order_id",
        "order_item_id",
        "order_key",
        "product_key",
        "seller_key",
        date_key("shipping_limit_ts").alias("shipping_limit_date_key"),
        "shipping_limit_ts",
        F.col("price").alias("item_price"),
        "freight_value",
        total.cast("decimal(12,2)").alias("total_item_value"),
        F.lit(1).alias("item_count"),
        ORDER_DAY,
        ORDER_STATUS,
        _year_of(ORDER_DAY),
    )


def resolve_payments(stg: DataFrame, fact_orders: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    """As for order status, a blank payment type keeps a NULL key and a missing one is `unknown`."""
    order = {"order_key": "order_key", ORDER_DAY: "purchase_date_key"}
    out = _lookup(stg, fact_orders, {"order_id": "order_id"}, order)
    out = out.withColumn("type_label", F.coalesce("payment_type", F.lit(UNKNOWN)))
    return _lookup(out, dim_payment_type, {"type_label": "payment_type"}, {"payment_type_key": "payment_type_key"})


def measure_payments(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id",
        "payment_sequential",
        "order_key",
        "payment_type_key",
        "payment_installments",
        "payment_value",
        F.lit(1).alias("payment_count"),
        ORDER_DAY,
        _year_of(ORDER_DAY),
    )


def resolve_reviews(stg: DataFrame, fact_orders: DataFrame) -> DataFrame:
    return _lookup(stg, fact_orders, {"order_id": "order_id"}, {"order_key": "order_key"})


def measure_reviews(df: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return df.select(
        "review_id",
        "order_id",
        "order_key",
        date_key("review_creation_ts").alias("review_creation_date_key"),
        date_key("review_answer_ts").alias("review_answer_date_key"),
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_ts",
        "review_answer_ts",
        elapsed("review_creation_ts", "review_answer_ts", HOUR).alias("review_response_time_hours"),
        has_content("review_comment_title").alias("has_review_title"),
        has_content("review_comment_message").alias("has_review_message"),
        (score >= 4).alias("is_positive_review"),
        (score == 3).alias("is_neutral_review"),
        (score <= 2).alias("is_negative_review"),
        F.lit(1).alias("review_count"),
    )
