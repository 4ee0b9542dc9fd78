"""Validators for the declared keys and rules. Spark does not enforce them on write.

Every validator returns one row per rule with the number of offending rows or keys. Duplicates of all
tables are found in one shuffle of key hashes; references are looked up by bare keys within one scan of the
referring table; NULLs and value rules are plain aggregates, which a layer's own write can observe (`measures`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.quality import measure

# Declared keys, mandatory columns, value rules and references by table.
UNIQUE_KEYS = {
    "raw": {
        "customers": ["customer_id"],
        "marketing_qualified_leads": ["mql_id"],
        "closed_deals": ["mql_id"],
        "orders": ["order_id"],
        "order_items": ["order_id", "order_item_id"],
        "order_payments": ["order_id", "payment_sequential"],
        "products": ["product_id"],
        "sellers": ["seller_id"],
        "product_category_name_translation": ["product_category_name"],
    },
    "staging": {
        "stg_customers": ["customer_id"],
        "stg_sellers": ["seller_id"],
        "stg_product_categories": ["product_category_name"],
        "stg_products": ["product_id"],
        "stg_orders": ["order_id"],
        "stg_order_items": ["order_id", "order_item_id"],
        "stg_payments": ["order_id", "payment_sequential"],
        "stg_marketing_leads": ["mql_id"],
        "stg_closed_deals": ["mql_id"],
    },
    "dwh": {
        "dim_date": ["full_date"],
        "dim_state": ["state_code"],
        "dim_city": ["city_name", "state_key"],
        "dim_zip_prefix": ["zip_prefix"],
        "dim_customer": ["customer_id"],
        "dim_seller": ["seller_id"],
        "dim_product_category": ["product_category_name"],
        "dim_product": ["product_id"],
        "dim_order_status": ["order_status"],
        "dim_payment_type": ["payment_type"],
        "dim_marketing_origin": ["origin_name"],
        "dim_landing_page": ["landing_page_id"],
        "dim_business_segment": ["business_segment"],
        "dim_lead_type": ["lead_type"],
        "dim_lead_profile": ["lead_behaviour_profile"],
        "dim_sales_rep": ["sales_rep_id", "sales_role"],
        "fact_marketing_leads": ["mql_id"],
        "fact_closed_deals": ["mql_id"],
        "fact_orders": ["order_id"],
        "fact_order_items": ["order_id", "order_item_id"],
        "fact_payments": ["order_id", "payment_sequential"],
    },
}

# Keys that the warehouse gives itself.
OWN_KEYS = {
    "dim_date": ["date_key"],
    "dim_state": ["state_key"],
    "dim_city": ["city_key"],
    "dim_zip_prefix": ["zip_prefix_key"],
    "dim_customer": ["customer_key"],
    "dim_seller": ["seller_key"],
    "dim_product_category": ["product_category_key"],
    "dim_product": ["product_key"],
    "dim_order_status": ["order_status_key"],
    "dim_payment_type": ["payment_type_key"],
    "dim_marketing_origin": ["marketing_origin_key"],
    "dim_landing_page": ["landing_page_key"],
    "dim_business_segment": ["business_segment_key"],
    "dim_lead_type": ["lead_type_key"],
    "dim_lead_profile": ["lead_profile_key"],
    "dim_sales_rep": ["sales_rep_key"],
    "fact_marketing_leads": ["marketing_lead_key"],
    "fact_closed_deals": ["closed_deal_key"],
    "fact_orders": ["order_key"],
    "fact_order_items": ["order_item_key"],
    "fact_payments": ["payment_key"],
    "fact_reviews": ["review_key"],
}

NOT_NULL = {
    "staging": {
        "stg_customers": ["customer_id", "customer_unique_id"],
        "stg_sellers": ["seller_id"],
        "stg_product_categories": ["product_category_name"],
        "stg_products": ["product_id"],
        "stg_orders": ["order_id", "customer_id"],
        "stg_order_items": ["order_id", "order_item_id"],
        "stg_payments": ["order_id", "payment_sequential"],
        "stg_marketing_leads": ["mql_id"],
        "stg_closed_deals": ["mql_id"],
    },
    "dwh": {
        "dim_date": [
            "date_key", "full_date", "day_of_month", "day_of_week", "day_name", "week_of_year",
            "month_number", "month_name", "quarter_number", "year_number", "is_weekend",
        ],
        "dim_state": ["state_code"],
        "dim_city": ["city_name", "state_key"],
        "dim_zip_prefix": ["zip_prefix"],
        "dim_customer": ["customer_id", "customer_unique_id"],
        "dim_seller": ["seller_id"],
        "dim_product_category": ["product_category_name"],
        "dim_product": ["product_id"],
        "dim_order_status": ["order_status"],
        "dim_payment_type": ["payment_type"],
        "dim_marketing_origin": ["origin_name"],
        "dim_landing_page": ["landing_page_id"],
        "dim_business_segment": ["business_segment"],
        "dim_lead_type": ["lead_type"],
        "dim_lead_profile": ["lead_behaviour_profile"],
        "dim_sales_rep": ["sales_rep_id", "sales_role"],
        "fact_marketing_leads": ["mql_id", "lead_count"],
        "fact_closed_deals": ["mql_id", "is_active_seller", "deal_count"],
        "fact_orders": ["order_id", "is_delivered", "order_count"],
        "fact_order_items": ["order_id", "order_item_id", "item_count"],
        "fact_payments": ["order_id", "payment_sequential", "payment_count"],
        "fact_reviews": [
            "review_id", "order_id", "has_review_title", "has_review_message",
            "is_positive_review", "is_neutral_review", "is_negative_review", "review_count",
        ],
    },
}

# A primary key holds no NULL.
NOT_NULL["raw"] = UNIQUE_KEYS["raw"]

_PRODUCT_SIZES = [
    "product_photos_qty >= 0", "product_weight_g >= 0", "product_length_cm >= 0",
    "product_height_cm >= 0", "product_width_cm >= 0",
]
_DECLARED = ["declared_product_catalog_size >= 0", "declared_monthly_revenue >= 0"]
_ITEM = ["order_item_id > 0", "price >= 0", "freight_value >= 0"]
_PAYMENT = ["payment_sequential > 0", "payment_installments >= 0", "payment_value >= 0"]
_SCORE = ["review_score BETWEEN 1 AND 5"]

VALUE_RULES = {
    "raw": {
        "closed_deals": _DECLARED,
        "order_items": _ITEM,
        "order_payments": _PAYMENT,
        "order_reviews": _SCORE,
        "products": ["product_name_lenght >= 0", "product_description_lenght >= 0", *_PRODUCT_SIZES],
    },
    "staging": {
        "stg_products": ["product_name_length >= 0", "product_description_length >= 0", *_PRODUCT_SIZES],
        "stg_order_items": _ITEM,
        "stg_payments": _PAYMENT,
        "stg_reviews": _SCORE,
        "stg_closed_deals": _DECLARED,
    },
    "dwh": {
        "fact_closed_deals": [*_DECLARED, "deal_count > 0"],
        "fact_orders": ["order_count > 0"],
        "fact_order_items": ["item_price >= 0", "freight_value >= 0", "total_item_value >= 0", "item_count > 0"],
        "fact_payments": [*_PAYMENT, "payment_count > 0"],
        "fact_reviews": [*_SCORE, "review_count > 0"],
    },
}

# table -> {column: (referenced table, referenced column)}
_DAY = ("dim_date", "date_key")
_PLACE = {
    "zip_prefix_key": ("dim_zip_prefix", "zip_prefix_key"),
    "city_key": ("dim_city", "city_key"),
    "state_key": ("dim_state", "state_key"),
}
_ORDER = ("fact_orders", "order_key")
REFERENCES = {
    "dim_city": {"state_key": _PLACE["state_key"]},
    "dim_zip_prefix": {"city_key": _PLACE["city_key"], "state_key": _PLACE["state_key"]},
    "dim_customer": _PLACE,
    "dim_seller": _PLACE,
    "dim_product": {"product_category_key": ("dim_product_category", "product_category_key")},
    "fact_marketing_leads": {
        "first_contact_date_key": _DAY,
        "landing_page_key": ("dim_landing_page", "landing_page_key"),
        "marketing_origin_key": ("dim_marketing_origin", "marketing_origin_key"),
    },
    "fact_closed_deals": {
        "seller_key": ("dim_seller", "seller_key"),
        "won_date_key": _DAY,
        "sdr_sales_rep_key": ("dim_sales_rep", "sales_rep_key"),
        "sr_sales_rep_key": ("dim_sales_rep", "sales_rep_key"),
        "business_segment_key": ("dim_business_segment", "business_segment_key"),
        "lead_type_key": ("dim_lead_type", "lead_type_key"),
        "lead_profile_key": ("dim_lead_profile", "lead_profile_key"),
    },
    "fact_orders": {
        "customer_key": ("dim_customer", "customer_key"),
        "order_status_key": ("dim_order_status", "order_status_key"),
        "purchase_date_key": _DAY,
        "approved_date_key": _DAY,
        "delivered_carrier_date_key": _DAY,
        "delivered_customer_date_key": _DAY,
        "estimated_delivery_date_key": _DAY,
    },
    "fact_order_items": {
        "order_key": _ORDER,
        "product_key": ("dim_product", "product_key"),
        "seller_key": ("dim_seller", "seller_key"),
        "shipping_limit_date_key": _DAY,
    },
    "fact_payments": {"order_key": _ORDER, "payment_type_key": ("dim_payment_type", "payment_type_key")},
    "fact_reviews": {
        "order_key": _ORDER,
        "review_creation_date_key": _DAY,
        "review_answer_date_key": _DAY,
    },
}


def duplicate_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Rows (table_name, rule, violations): number of complete key values held by more than one row.

    A key is known by 128 bits of hash, so that the keys of all tables go through one narrow shuffle, combined
    before it; two keys out of 10**12 would be taken for one with a chance of some 10**-15.
    """
    rules = [(t, f"unique ({', '.join(columns)})") for t, columns in keys.items()]

    def hashed(number: int, table: str, columns: list[str]) -> DataFrame:
        return tables[table].dropna(subset=columns).select(
            F.lit(number).cast("short").alias("number"),
            F.xxhash64(*columns).alias("h1"),
            F.xxhash64(F.lit(number), *reversed(columns)).alias("h2"),
        )

    held = reduce(DataFrame.unionByName, [hashed(i, t, c) for i, (t, c) in enumerate(keys.items())])
    repeated = held.groupBy("number", "h1", "h2").count().where("count > 1").select("number", F.lit(1).alias("n"))
    # A zero for every rule keeps those without findings in the report.
    every = repeated.sparkSession.range(len(rules)).select(F.col("id").cast("short").alias("number"), F.lit(0).alias("n"))
    names = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(r).alias("rule")) for t, r in rules])
    totals = repeated.unionByName(every).groupBy("number").agg(F.sum("n").alias("violations"))
    named = totals.withColumn("name", names[F.col("number").cast("int")])
    return named.select("name.table_name", "name.rule", "violations")


def _named(table: str, rows: DataFrame) -> DataFrame:
    return rows.select(
        F.lit(table).alias("table_name"), F.col("name").alias("rule"), F.col("value").alias("violations")
    )


def _nulls(columns: list[str]) -> dict[str, Column]:
    return {f"{c} not null": F.count_if(F.col(c).isNull()) for c in columns}


def _broken(predicates: list[str]) -> dict[str, Column]:
    return {p: F.count_if(F.expr(f"NOT ({p})")) for p in predicates}


def measures(layer: str, table: str) -> dict[str, Column]:
    """Aggregates over a table of `layer` that count the rows breaking its NOT NULLs and value rules."""
    return _nulls(NOT_NULL[layer].get(table, [])) | _broken(VALUE_RULES[layer].get(table, []))


def null_violations(tables: dict[str, DataFrame], mandatory: dict[str, list[str]]) -> DataFrame:
    """Rows (table_name, rule, violations): NULLs in mandatory columns, one pass per table."""
    return reduce(DataFrame.unionByName, [_named(t, measure(tables[t], _nulls(c))) for t, c in mandatory.items()])


def rule_violations(tables: dict[str, DataFrame], rules: dict[str, list[str]]) -> DataFrame:
    """Rows (table_name, rule, violations): rows for which a rule is false; an unknown outcome passes."""
    return reduce(DataFrame.unionByName, [_named(t, measure(tables[t], _broken(p))) for t, p in rules.items()])


def orphans(
    tables: dict[str, DataFrame],
    references: dict[str, dict[str, tuple[str, str]]] = REFERENCES,
    rows: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows (table_name, rule, violations): rows whose non-NULL key has no partner; a NULL key needs none.

    Each referring table is read once, its keys only, and meets the keys of one target after the other: Spark
    broadcasts a small target within the scan, and only a large one moves rows of bare keys. The key of a target is unique.
    Referring columns are taken from `rows` where it has the table.
    """
    referring = {**tables, **(rows or {})}

    def lost(table: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
        used = referring[table].select(*(F.col(c).cast("bigint").alias(c) for c in columns))
        for i, (c, (target, key)) in enumerate(columns.items()):
            known = tables[target].select(F.col(key).cast("bigint").alias(f"__key_{i}"))
            used = used.join(known, F.col(c) == F.col(f"__key_{i}"), "left")
        missing = {f"{c} -> {t}": F.count_if(F.col(c).isNotNull() & F.col(f"__key_{i}").isNull()) for i, (c, (t, _)) in enumerate(columns.items())}
        return _named(table, measure(used, missing))

    return reduce(DataFrame.unionByName, [lost(t, c) for t, c in references.items()])


class ViolationError(RuntimeError):
    """A layer breaks a declared key or rule."""


def findings(
    layer: str,
    tables: dict[str, DataFrame],
    measured: dict[str, dict[str, int]] | None = None,
    rows: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows (table_name, rule, violations) of every declared rule of `layer` that is broken; references in dwh only.

    With `measured`, the counts that the layer's write observed, tables are read for their keys alone. `rows` are the
    tables without their surrogate keys, where reading those costs a lookup; only the targets of references need them.
    """
    plain = {**tables, **(rows or {})}
    parts = [duplicate_keys(plain, UNIQUE_KEYS[layer])]
    if measured is None:
        parts += [null_violations(plain, NOT_NULL[layer]), rule_violations(plain, VALUE_RULES[layer])]
    else:
        counted = [(t, r, n) for t, rules in measured.items() for r, n in rules.items() if n]
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(counted, "table_name string, rule string, violations bigint"))
    if layer == "dwh":
        parts += [duplicate_keys(tables, OWN_KEYS), orphans(tables, REFERENCES, plain)]
    return reduce(DataFrame.unionByName, parts).where("violations > 0")
