"""One registered query per operator, over the whole test tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from marketloom.functions import text as tx
from marketloom.operators import constraints as con
from marketloom.operators import insights as bi
from marketloom.operators import quality, staging
from marketloom.operators.surrogate import dense_key, numbered
from marketloom.plans.warehouse import DWH_TABLES, MARTS, STAGING_TABLES, Warehouse
from marketloom.session import new_work_folder
from marketloom.sources.csv_files import load_all_raw, read_csv
from marketloom.sources.layers import LayerStore, publish_catalog, publish_views
from marketloom.sources.sample import sample_raw
from marketloom.sources.schemas import RAW_TABLES
from marketloom.sources.sql_reads import read_scalar, read_sql, read_sql_or_empty

_open: dict[tuple[str, str], Warehouse] = {}
_opening = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over `sf_dir`, shared by all queries of one Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _opening:
        if key not in _open:
            _open[key] = Warehouse(spark, sample_raw(spark, sf_dir))
        return _open[key]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, the forms every engine prints alike."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, DecimalType):
            out[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, DateType):
            out[f.name] = F.col(f.name).cast("string")
    return df.withColumns(out) if out else df


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    """Doubles summed from doubles depend on the order of addition in their last bits."""
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.options(
        header="true",
        quote='"',
        escape='"',
        nullValue="",
        emptyValue='""',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
    ).csv(path)
    return path


def _csv_roundtrip(w: Warehouse) -> DataFrame:
    path = _write_csv(w.raw("order_reviews"), f"{new_work_folder(w.spark, 'csv')}/order_reviews.csv")
    return read_csv(w.spark, path, "order_reviews")


def _digest(name: str, df: DataFrame) -> DataFrame:
    """table_name with its rows, cells that are not NULL, and characters of its texts."""
    filled = reduce(Column.__add__, [F.count(F.col(c)) for c in df.columns])
    texts = [F.coalesce(F.sum(F.length(c)), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), filled.alias("n_filled"), reduce(Column.__add__, texts).alias("n_chars"))


def _all_sources(w: Warehouse) -> DataFrame:
    """The eleven sources written as files, loaded as the raw layer, and read from it."""
    folder = new_work_folder(w.spark, "csv")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda t: _write_csv(w.raw(t), f"{folder}/src_{t}.csv"), RAW_TABLES))
    store = LayerStore(w.spark, new_work_folder(w.spark, "layers"))
    load_all_raw(w.spark, folder, store, "src_{table}.csv")
    loaded = store.read_layer("raw", RAW_TABLES)
    return reduce(DataFrame.unionByName, [_digest(t, df) for t, df in loaded.items()])


def _all_staging(w: Warehouse) -> DataFrame:
    """The whole staging layer written as one run and read back."""
    store = LayerStore(w.spark, new_work_folder(w.spark, "layers"))
    store.write_layer("staging", w.staging_layer())
    return reduce(DataFrame.unionByName, [_digest(t, df) for t, df in store.read_layer("staging", STAGING_TABLES).items()])


def _all_published(w: Warehouse) -> DataFrame:
    """All marts as views, each read by its name."""
    publish_views({m: w.mart_table(m) for m in MARTS}, "marts")
    counted = [f"SELECT '{m}' AS mart, COUNT(*) AS n_rows, CAST(SUM({c}) AS BIGINT) AS total FROM marts_{m}" for m, c in _COUNTS.items()]
    return read_sql(w.spark, " UNION ALL ".join(counted))


def _by_catalog(w: Warehouse) -> DataFrame:
    """All marts stored as a layer and read by their catalog names in another session, after a second run has replaced the first."""
    folder, database = new_work_folder(w.spark, "catalog"), f"marts_{uuid.uuid4().hex}"
    store = LayerStore(w.spark, folder)
    for names in (MARTS[:2], MARTS):
        run = store.write_layer("marts", {m: w.mart_table(m) for m in names})
        publish_catalog(w.spark, run, names, database, f"{folder}/database")
    counted = [f"SELECT '{m}' AS mart, COUNT(*) AS n_rows, CAST(SUM({c}) AS BIGINT) AS total FROM {database}.{m}" for m, c in _COUNTS.items()]
    return w.spark.newSession().sql(" UNION ALL ".join(counted))


def _with_a_missing_mart(w: Warehouse) -> DataFrame:
    """Years of a mart that is there and of one that is not: the latter is an empty frame of the declared type."""
    publish_views({"sales_overview": w.mart_table("sales_overview")}, "marts")
    wanted = "year_number int, order_count bigint"
    read = lambda mart: read_sql_or_empty(w.spark, f"SELECT year_number, order_count FROM marts_{mart}", wanted)
    both = read("sales_overview").withColumn("mart", F.lit("sales_overview")).unionByName(read("returns").withColumn("mart", F.lit("returns")))
    return both.groupBy("mart", "year_number").agg(F.sum("order_count").alias("order_count"))


def _largest_order(w: Warehouse) -> DataFrame:
    """One value read from a published mart, and the rows that hold it."""
    publish_views({"sales_overview": w.mart_table("sales_overview")}, "marts")
    most = read_scalar(w.spark, "SELECT max(order_count) FROM marts_sales_overview WHERE order_status = :status", {"status": "delivered"})
    return w.mart_table("sales_overview").where((F.col("order_status") == "delivered") & (F.col("order_count") == most)).select("year_number", "month_number", "order_count")


def _broken_payment_keys(w: Warehouse) -> DataFrame:
    """Payments a third of which share one declared key: ranks are dense and each key's are consecutive."""
    paid = w.stg_payments
    hot = F.coalesce("payment_installments", F.lit(1)) % 3 == 0
    broken = numbered(paid.withColumns({"order_id": F.when(hot, "hot").otherwise(F.col("order_id")), "payment_sequential": F.when(hot, 1).otherwise(F.col("payment_sequential"))}))
    keyed = dense_key(broken, "payment_key", ["order_id", "payment_sequential"], f"{new_work_folder(w.spark, 'keys')}/payments")
    return keyed.groupBy(F.when(F.col("order_id") == "hot", "hot").otherwise("others").alias("kind")).agg(
        F.count("*").alias("n_rows"), F.count_distinct("payment_key").alias("n_keys"), F.min("payment_key").alias("low"), F.max("payment_key").alias("high")
    )


def _planted_orphans(w: Warehouse) -> DataFrame:
    """References after every target has lost some rows."""
    tables = _all_tables(w, DWH_TABLES)
    for target, column in _LOST.items():
        tables[target] = tables[target].where(F.col(column) % 7 != 3)
    return con.orphans(tables, rows=_all_rows(w, DWH_TABLES))


def _first_unmet(w: Warehouse) -> DataFrame:
    """The checks up to the first that is not met."""
    rows = quality.up_to_first_unmet(_check_tables(w), quality.CHECKS)
    return w.spark.createDataFrame([(r.position, r.check_name, r.value, r.passed) for r in rows], "position int, check_name string, value string, passed boolean")


#: A count of each mart, and the key of each target that loses the rows with rest 3 of 7.
_COUNTS = {
    "sales_overview": "order_count",
    "sales_by_category": "item_count",
    "payment_analysis": "payment_count",
    "customer_satisfaction": "review_count",
    "delivery_performance": "delivered_orders",
    "marketing_funnel": "mql_count",
}
_LOST = {t: k for targets in con.REFERENCES.values() for t, k in targets.values()}


def _layer_roundtrip(w: Warehouse) -> DataFrame:
    store = LayerStore(w.spark, new_work_folder(w.spark, "layers"))
    store.write_layer("staging", {"stg_closed_deals": w.stg_closed_deals})
    return store.read("staging", "stg_closed_deals")


def _published(w: Warehouse) -> DataFrame:
    publish_views({"customer_satisfaction": w.customer_satisfaction}, "marts")
    return read_sql(w.spark, "SELECT * FROM marts_customer_satisfaction")


def _parameterised(w: Warehouse) -> DataFrame:
    publish_views({"sales_overview": w.sales_overview}, "marts")
    return read_sql(
        w.spark,
        """SELECT order_status, sum(order_count) AS order_count FROM marts_sales_overview
           WHERE array_contains(:years, year_number) AND order_count >= :floor GROUP BY order_status""",
        {"years": F.array(F.lit(1996), F.lit(1998)), "floor": 10},
    )


def _all_tables(w: Warehouse, names: list[str]) -> dict[str, DataFrame]:
    w.prepare(names)
    return {n: w.table(n) for n in names}


def _all_rows(w: Warehouse, names: list[str]) -> dict[str, DataFrame]:
    w.prepare(names)
    return {n: w.rows(n) for n in names}


def _check_tables(w: Warehouse) -> dict[str, DataFrame]:
    names = list(dict.fromkeys(c.table for c in quality.CHECKS))
    facts = _all_rows(w, [n for n in names if n in DWH_TABLES])
    return {"orders": w.raw("orders"), **facts, **{n: w.mart_table(n) for n in names if n in MARTS}}


def _points(w: Warehouse) -> DataFrame:
    return staging.geolocation_points(w.raw("geolocation"))


def _ranked(df: DataFrame) -> DataFrame:
    """Number the rows of a ranking (fifteen at most), to make its order comparable."""
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("conversion_rate"), "marketing_origin"))
    return df.select(place.cast("bigint").alias("rank"), "marketing_origin", "conversion_rate")


_RAW_CLEANING = {
    "c1_zip": ("customers", ["customer_id"], {"zip": ("customer_zip_code_prefix", tx.zip_prefix)}),
    "c2_lower": ("orders", ["order_id"], {"status": ("order_status", tx.lower_text)}),
    "c3_upper": ("sellers", ["seller_id"], {"state": ("seller_state", tx.upper_code)}),
    "c4_unknown": ("products", ["product_id"], {"category": ("product_category_name", tx.blank_to_unknown)}),
    "c5_unknown_lower": ("marketing_qualified_leads", ["mql_id"], {"origin": ("origin", tx.blank_to_unknown_lower)}),
    "c6_null": ("closed_deals", ["mql_id"], {"seller": ("seller_id", tx.blank_to_null)}),
    "c7_bool": ("closed_deals", ["mql_id"], {"company": ("has_company", tx.yes_no), "gtin": ("has_gtin", tx.yes_no)}),
}


def _cleaning(w: Warehouse, table: str, keys: list[str], rules: dict) -> DataFrame:
    return w.raw(table).select(*keys, *[rule(column).alias(name) for name, (column, rule) in rules.items()])


_TABLES = {
    "t1_customers": "stg_customers",
    "t2_sellers": "stg_sellers",
    "t6_geolocation": "stg_geolocation",
    "t8_categories": "stg_product_categories",
    "t9_products": "stg_products",
    "t10_orders": "stg_orders",
    "t11_items": "stg_order_items",
    "t12_payments": "stg_payments",
    "t13_reviews": "stg_reviews",
    "t14_leads": "stg_marketing_leads",
    "t15_deals": "stg_closed_deals",
    "d1_dates": "date_bounds",
    "d4_date": "dim_date",
    "d5_state": "dim_state",
    "d6_city": "dim_city",
    "d7_zip": "dim_zip_prefix",
    "d8_customer": "dim_customer",
    "d9_seller": "dim_seller",
    "d10_category": "dim_product_category",
    "d11_product": "dim_product",
    "d12_status": "dim_order_status",
    "d13_payment_type": "dim_payment_type",
    "d14_origin": "dim_marketing_origin",
    "d15_landing_page": "dim_landing_page",
    "d16_segment": "dim_business_segment",
    "d17_lead_type": "dim_lead_type",
    "d18_lead_profile": "dim_lead_profile",
    "d19_sales_rep": "dim_sales_rep",
    "f1_leads": "fact_marketing_leads",
    "f2_deals": "fact_closed_deals",
    "f3_orders": "fact_orders",
    "f4_items": "fact_order_items",
    "f5_payments": "fact_payments",
    "f6_reviews": "fact_reviews",
    "m1_sales_overview": "sales_overview",
    "m2_sales_by_category": "sales_by_category",
    "m3_payment_analysis": "payment_analysis",
    "m4_customer_satisfaction": "customer_satisfaction",
    "m5_delivery_performance": "delivery_performance",
    "m6_marketing_funnel": "marketing_funnel",
}

_OTHERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "s2_csv_scan": _csv_roundtrip,
    "s5_layer_roundtrip": _layer_roundtrip,
    "s6_published_mart": _published,
    "s4_load_all": _all_sources,
    "s5_staging_layer": _all_staging,
    "s6_published_marts": _all_published,
    "s6_catalog_marts": _by_catalog,
    "s7_sql_read": _parameterised,
    "s8_scalar": _largest_order,
    "s9_missing_mart": _with_a_missing_mart,
    "t3_geo_clean": _points,
    "t4_centroid": lambda w: staging.zip_centroids(_points(w)),
    "t5_modal_city": lambda w: staging.modal_places(_points(w)),
    "t7_category_universe": lambda w: staging.category_universe(
        w.raw("products"), w.raw("product_category_name_translation")
    ),
    "d20_broken_keys": _broken_payment_keys,
    "d20_keys": lambda w: w.fact_orders.select("order_id", "order_key"),
    "m7_legacy_sales": lambda w: w.mart("sales_overview", null_sums=True),
    "m7_legacy_payments": lambda w: w.mart("payment_analysis", null_sums=True),
    "m7_legacy_delivery": lambda w: w.mart("delivery_performance", on_time=False),
    "m7_legacy_funnel": lambda w: w.mart("marketing_funnel", null_sums=True, conversion=False),
    "q_report": lambda w: quality.check_report(_check_tables(w)).select("check_name", "value", "passed"),
    "q13_duplicates": lambda w: con.duplicate_keys(_all_rows(w, DWH_TABLES), con.UNIQUE_KEYS["dwh"]),
    "q13_raw_duplicates": lambda w: con.duplicate_keys(
        {t: w.raw(t) for t in con.UNIQUE_KEYS["raw"]}, con.UNIQUE_KEYS["raw"]
    ),
    "q13_staging_duplicates": lambda w: con.duplicate_keys(
        _all_tables(w, STAGING_TABLES), con.UNIQUE_KEYS["staging"]
    ),
    "q13_gate": lambda w: con.findings("raw", {t: w.raw(t) for t in RAW_TABLES}).unionByName(
        con.findings("staging", _all_tables(w, STAGING_TABLES))
    ),
    "q14_nulls": lambda w: con.null_violations(
        _all_rows(w, STAGING_TABLES + DWH_TABLES), con.NOT_NULL["staging"] | con.NOT_NULL["dwh"]
    ),
    "q15_checks": lambda w: con.rule_violations(
        _all_rows(w, STAGING_TABLES + DWH_TABLES), con.VALUE_RULES["staging"] | con.VALUE_RULES["dwh"]
    ),
    "q15_raw_checks": lambda w: con.rule_violations(
        {t: w.raw(t) for t in con.VALUE_RULES["raw"]}, con.VALUE_RULES["raw"]
    ),
    "q13_own_keys": lambda w: con.duplicate_keys(_all_tables(w, DWH_TABLES), con.OWN_KEYS),
    "q16_planted": _planted_orphans,
    "q18_expectations": lambda w: quality.check_report(_check_tables(w)).select("check_name", "value", "passed", "expectation"),
    "q19_first_unmet": _first_unmet,
    "q16_orphans": lambda w: con.orphans(_all_tables(w, DWH_TABLES), rows=_all_rows(w, DWH_TABLES)),
    "q20_summary": lambda w: quality.summary(quality.check_report(_check_tables(w))),
    "b1_years": lambda w: bi.available_years(w.mart_table("sales_overview")),
    "b2_filtered_sales": lambda w: w.mart("sales_overview", years=[1996, 1997]),
    "b2_filtered_payments": lambda w: w.mart("payment_analysis", years=[1996, 1997]),
    "b3_periods": lambda w: bi.with_period(w.mart_table("sales_overview")).select("period", "order_status", "order_count"),
    "b4_sales_kpis": lambda w: _rounded(bi.sales_kpis(w.mart_table("sales_overview")), total_revenue=2, avg_order_value=6),
    "b5_monthly_sales": lambda w: bi.monthly_sales(w.mart_table("sales_overview")),
    "b6_status_share": lambda w: bi.orders_by_status(w.mart_table("sales_overview")),
    "b7_top_categories": lambda w: bi.top_categories(w.mart_table("sales_by_category")),
    "b8_payment_kpis": lambda w: _rounded(
        bi.payment_kpis(w.mart_table("payment_analysis")), total_value=2, avg_payment=6, avg_installments=6
    ),
    "b9_payments_by_type": lambda w: bi.payments_by_type(w.mart_table("payment_analysis")),
    "b10_installments": lambda w: bi.installment_distribution(w.mart_table("payment_analysis")),
    "b11_satisfaction_kpis": lambda w: bi.satisfaction_kpis(w.mart_table("customer_satisfaction")),
    "b12_monthly_score": lambda w: bi.monthly_satisfaction(w.mart_table("customer_satisfaction")),
    "b13_score_distribution": lambda w: bi.score_distribution(w.mart_table("customer_satisfaction")),
    "b14_delivery_kpis": lambda w: _rounded(
        bi.delivery_kpis(w.mart_table("delivery_performance")), avg_delivery_days=6, avg_days_vs_estimate=6, on_time_rate=6
    ),
    "b15_monthly_delivery": lambda w: _rounded(
        bi.monthly_delivery(w.mart_table("delivery_performance")), avg_days_purchase_to_delivery=6, on_time_rate=6
    ),
    "b16_on_time_by_status": lambda w: _rounded(bi.on_time_by_status(w.mart_table("delivery_performance")), on_time_rate=6),
    "b17_funnel_kpis": lambda w: bi.funnel_kpis(w.mart_table("marketing_funnel")),
    "b18_funnel_by_origin": lambda w: bi.funnel_by_origin(w.mart_table("marketing_funnel")),
    "b19_conversion_rank": lambda w: _ranked(bi.conversion_ranking(w.mart_table("marketing_funnel"))),
    "b20_sales_detail": lambda w: bi.detail_page("sales_overview", w.mart_table("sales_overview"), [1996, 1997]),
    "b20_payment_detail": lambda w: bi.detail_page("payment_analysis", w.mart_table("payment_analysis")),
    "b20_satisfaction_detail": lambda w: bi.detail_page("customer_satisfaction", w.mart_table("customer_satisfaction"), [2024]),
    "b20_delivery_detail": lambda w: bi.detail_page("delivery_performance", w.mart_table("delivery_performance")),
    "b20_marketing_detail": lambda w: bi.detail_page("marketing_funnel", w.mart_table("marketing_funnel")),
    "b21_formatted": lambda w: bi.origin_table(w.mart_table("marketing_funnel")),
    "b21_sales_cards": lambda w: bi.sales_cards(w.mart_table("sales_overview")),
    "b21_payment_cards": lambda w: bi.payment_cards(w.mart_table("payment_analysis")),
    "b21_satisfaction_cards": lambda w: bi.satisfaction_cards(w.mart_table("customer_satisfaction")),
    "b21_delivery_cards": lambda w: bi.delivery_cards(w.mart_table("delivery_performance")),
    "b21_marketing_cards": lambda w: bi.funnel_cards(w.mart_table("marketing_funnel")),
}

#: Years of the registered selections, and the figures that follow a selection (all but the ranking of categories).
SELECTED_YEARS = {"marketing_funnel": [2024], "customer_satisfaction": [2024]}
_BY_YEAR = [
    "b4_sales_kpis", "b5_monthly_sales", "b6_status_share", "b8_payment_kpis", "b9_payments_by_type", "b10_installments",
    "b11_satisfaction_kpis", "b12_monthly_score", "b13_score_distribution", "b14_delivery_kpis", "b15_monthly_delivery",
    "b16_on_time_by_status", "b17_funnel_kpis", "b18_funnel_by_origin", "b19_conversion_rank", "b21_formatted", "b21_sales_cards",
    "b21_payment_cards", "b21_satisfaction_cards", "b21_delivery_cards", "b21_marketing_cards",
]


class _Selection:
    """A warehouse whose stored marts are limited to the selected years."""

    def __init__(self, w: Warehouse):
        self._warehouse = w

    def mart_table(self, name: str) -> DataFrame:
        return bi.in_years(self._warehouse.mart_table(name), SELECTED_YEARS.get(name, [1996, 1997]))


_OTHERS |= {f"{q}_in_years": (lambda w, q=q: _OTHERS[q](_Selection(w))) for q in _BY_YEAR}


def _registered(build: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(build(warehouse(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    builders: dict[str, Callable[[Warehouse], DataFrame]] = {
        **{q: (lambda w, spec=spec: _cleaning(w, *spec)) for q, spec in _RAW_CLEANING.items()},
        **{q: (lambda w, t=t: w.table(t)) for q, t in _TABLES.items()},
        **_OTHERS,
    }
    return {name: _registered(build) for name, build in sorted(builders.items())}
