"""All tables of one warehouse, each built on first use from the tables it depends on."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import dimensions as dim
from marketloom.operators import facts, marts
from marketloom.operators import staging as stg
from marketloom.operators.surrogate import dense_key, keyed_rows, numbered, ranges, read_keyed, write_keyed
from marketloom.session import new_work_folder, release_shuffles
from marketloom.sources.declared import TABLES, conforming
from marketloom.sources.files import delete_folder

# staging table -> raw table
STAGING_SOURCES = {
    "stg_customers": "customers",
    "stg_sellers": "sellers",
    "stg_geolocation": "geolocation",
    "stg_product_categories": "product_category_name_translation",
    "stg_products": "products",
    "stg_orders": "orders",
    "stg_order_items": "order_items",
    "stg_payments": "order_payments",
    "stg_reviews": "order_reviews",
    "stg_marketing_leads": "marketing_qualified_leads",
    "stg_closed_deals": "closed_deals",
}
STAGING_TABLES = list(STAGING_SOURCES)

# table -> (surrogate key, columns whose order defines it)
KEYS = {
    "dim_state": ("state_key", ["state_code"]),
    "dim_city": ("city_key", ["city_name", "state_key"]),
    "dim_zip_prefix": ("zip_prefix_key", ["zip_prefix"]),
    "dim_customer": ("customer_key", ["customer_id"]),
    "dim_seller": ("seller_key", ["seller_id"]),
    "dim_product_category": ("product_category_key", ["product_category_name"]),
    "dim_product": ("product_key", ["product_id"]),
    "dim_order_status": ("order_status_key", ["order_status"]),
    "dim_payment_type": ("payment_type_key", ["payment_type"]),
    "dim_marketing_origin": ("marketing_origin_key", ["origin_name"]),
    "dim_landing_page": ("landing_page_key", ["landing_page_id"]),
    "dim_business_segment": ("business_segment_key", ["business_segment"]),
    "dim_lead_type": ("lead_type_key", ["lead_type"]),
    "dim_lead_profile": ("lead_profile_key", ["lead_behaviour_profile"]),
    "dim_sales_rep": ("sales_rep_key", ["sales_rep_id", "sales_role"]),
    "fact_marketing_leads": ("marketing_lead_key", ["mql_id"]),
    "fact_closed_deals": ("closed_deal_key", ["mql_id"]),
    "fact_orders": ("order_key", ["order_id"]),
    # Ties beyond the declared natural key are only needed when it is violated; what still ties is alike in all that is kept of an item.
    "fact_order_items": (
        "order_item_key",
        ["order_id", "order_item_id", "product_key", "seller_key", "shipping_limit_ts", "price", "freight_value"],
    ),
    "fact_payments": ("payment_key", ["order_id", "payment_sequential"]),
    "fact_reviews": (
        "review_key",
        ["review_id", "order_id", "review_creation_ts", "review_answer_ts", "review_score"],
    ),
}
# Row-by-row columns of the facts, derived after the rows are in key order.
MEASURES = {
    "fact_marketing_leads": facts.measure_marketing_leads,
    "fact_closed_deals": facts.measure_closed_deals,
    "fact_orders": facts.measure_orders,
    "fact_order_items": facts.measure_order_items,
    "fact_payments": facts.measure_payments,
    "fact_reviews": facts.measure_reviews,
}
DWH_TABLES = ["dim_date", *KEYS]
#: Facts that follow the orders in size -> staging table. Each is built in ranges of the first column of its order, as its lookups and
#: its sorting move whole rows up to four times: one range a number of rows, PARTS at most, as each reads the staging table once more.
IN_PARTS = {
    "fact_orders": "stg_orders",
    "fact_order_items": "stg_order_items",
    "fact_payments": "stg_payments",
    "fact_reviews": "stg_reviews",
}
ROWS_AT_ONCE, PARTS = 1_000_000, 8
#: Sums by purchase day and status that marts are drawn from; stored beside the facts.
ROLLUP = "order_days"

# Label dimension -> kind of its labels; all of them are keyed in one table.
LABEL_DIMENSIONS = {
    "dim_order_status": "order_status",
    "dim_payment_type": "payment_type",
    "dim_marketing_origin": "marketing_origin",
    "dim_landing_page": "landing_page",
    "dim_business_segment": "business_segment",
    "dim_lead_type": "lead_type",
    "dim_lead_profile": "lead_profile",
}

# Written tables that must exist before a table or mart is built; each group is independent
# enough to be written at the same time.
NEEDS = {
    "dim_date": ["harvest"],
    "labels": ["harvest"],
    **dict.fromkeys(LABEL_DIMENSIONS, ["labels"]),
    "dim_state": ["places"],
    "dim_city": ["dim_state"],
    "dim_zip_prefix": ["dim_city"],
    "dim_customer": ["dim_zip_prefix"],
    "dim_seller": ["dim_zip_prefix"],
    "dim_product": ["dim_product_category"],
    "fact_marketing_leads": ["dim_landing_page", "dim_marketing_origin"],
    "fact_closed_deals": [
        "dim_seller", "dim_sales_rep", "dim_business_segment", "dim_lead_type", "dim_lead_profile",
    ],
    "fact_orders": ["dim_customer", "dim_order_status"],
    "fact_order_items": ["fact_orders", "dim_product", "dim_seller"],
    "fact_payments": ["fact_orders", "dim_payment_type"],
    "fact_reviews": ["fact_orders"],
    "order_days": ["fact_order_items"],
    "sales_overview": ["order_days", "dim_date", "dim_order_status"],
    "sales_by_category": ["fact_order_items"],
    "payment_analysis": ["fact_payments", "dim_date"],
    "customer_satisfaction": ["fact_reviews", "dim_date"],
    "delivery_performance": ["order_days", "dim_date", "dim_order_status"],
    "marketing_funnel": ["fact_marketing_leads", "fact_closed_deals", "dim_date"],
}
MARTS = [
    "sales_overview",
    "sales_by_category",
    "payment_analysis",
    "customer_satisfaction",
    "delivery_performance",
    "marketing_funnel",
]


class Warehouse:
    """Lazily wired tables over a raw layer (or over ready staging / dwh tables).

    Staging tables and marts are plain plans. A table with a surrogate key is written once, in key order,
    when it is first asked for, and read from there afterwards: below `run_folder` under its own name if
    that is given (it then is the layer's table), else in the work folder. `observe` may attach metrics to a
    write, by table name.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame] | None = None,
        ready: dict[str, DataFrame] | None = None,
        ready_rows: dict[str, DataFrame] | None = None,
        work_folder: str | None = None,
        run_folder: str | None = None,
        observe: Callable[[str, DataFrame], DataFrame] | None = None,
    ):
        release_shuffles(spark)
        self.spark = spark
        self._raw = raw or {}
        self._tables: dict[str, DataFrame] = dict(ready or {})
        self._rows: dict[str, DataFrame] = dict(ready_rows or {})
        self._work_folder = work_folder
        self._run_folder = run_folder
        self._observe = observe or (lambda name, df: df)
        self._builders = self._wire()
        self._locks = {n: threading.Lock() for n in ["work folder", *self._builders, *[f"{m} table" for m in MARTS]]}

    @property
    def work_folder(self) -> str:
        with self._locks["work folder"]:
            if self._work_folder is None:
                self._work_folder = new_work_folder(self.spark, "warehouse")
        return self._work_folder

    def drop_work_files(self) -> None:
        """Delete the files written for keys; tables built here cannot be read afterwards."""
        if self._work_folder is not None:
            delete_folder(self.spark, self._work_folder)
            self._work_folder = None
        self._tables.clear()
        self._rows.clear()

    def raw(self, name: str) -> DataFrame:
        return self._raw[name]

    def table(self, name: str) -> DataFrame:
        """The table with its declared columns and types; anything else is an error."""
        own = self.whole(name).drop(*facts.HIDDEN_COLUMNS.get(name, []))
        return conforming(name, own) if name in TABLES else own

    def rows(self, name: str) -> DataFrame:
        """All stored columns of a table but its own key: what plans read that do not need that key, without its lookup."""
        whole = self.whole(name)
        return self._rows.get(name, whole)

    def whole(self, name: str) -> DataFrame:
        """The table with its hidden columns."""
        if name in self._tables:
            return self._tables[name]
        self.prepare(NEEDS.get(name, []))
        with self._locks[name]:
            if name not in self._tables:
                if name in IN_PARTS:
                    column = KEYS[name][1][0]
                    parts = ranges(self.table(IN_PARTS[name]), column, ROWS_AT_ONCE, PARTS)
                    self._tables[name] = self._keyed(name, [self._builders[name](part) for part in parts])
                else:
                    df = self._builders[name]()
                    self._tables[name] = self._keyed(name, df) if name in KEYS and name not in LABEL_DIMENSIONS else df
        return self._tables[name]

    def prepare(self, names: Iterable[str]) -> None:
        """Build several tables, independent ones as concurrent Spark jobs."""
        missing = [n for n in names if n not in self._tables]
        if len(missing) < 2:
            for n in missing:
                self.table(n)
            return
        with ThreadPoolExecutor(len(missing)) as pool:
            for built in [pool.submit(self.table, n) for n in missing]:
                built.result()

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith(("stg_", "dim_", "fact_")) or name in MARTS:
            return self.table(name)
        raise AttributeError(name)

    def mart(self, name: str, **options) -> DataFrame:
        """A mart, optionally with `years`, `null_sums` and the other switches of its builder."""
        self.prepare(NEEDS[name])
        return self._marts[name](**options)

    def mart_table(self, name: str) -> DataFrame:
        """The unrestricted mart, computed once and written: a few thousand rows for many figures."""
        stored = f"{name} table"
        with self._locks[stored]:
            if stored not in self._tables:
                self._tables[stored] = self._stored(f"mart_{name}", self.table(name))
        return self._tables[stored]

    def staging_layer(self) -> dict[str, Callable[[], DataFrame]]:
        return {t: (lambda t=t: self.table(t)) for t in STAGING_TABLES}

    def dwh_layer(self) -> dict[str, Callable[[], DataFrame]]:
        return {t: (lambda t=t: self.table(t)) for t in DWH_TABLES}

    def _keyed(self, name: str, df: DataFrame | list[DataFrame]) -> DataFrame:
        key, order = KEYS[name]
        hidden = facts.HIDDEN_COLUMNS.get(name, [])
        split = facts.YEAR if facts.YEAR in hidden else None
        path = self._new_path(name, True)
        schema = write_keyed(df, key, order, path, MEASURES.get(name), hidden, split, lambda d: self._observe(name, d))
        self._rows[name] = keyed_rows(self.spark, path, schema)
        return read_keyed(self.spark, path, key, schema, hidden=True)

    def _new_path(self, name: str, in_run: bool = False) -> str:
        """A path no earlier, possibly failed, attempt has written to: a run is dropped as a whole when it fails."""
        if in_run and self._run_folder:
            return f"{self._run_folder}/{name}"
        return f"{self.work_folder}/{name}-{uuid.uuid4().hex[:8]}"

    def _stored(self, name: str, df: DataFrame, in_run: bool = False) -> DataFrame:
        path = self._new_path(name, in_run)
        (self._observe(name, df) if in_run else df).write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def _label_dimension(self, name: str) -> DataFrame:
        key, (label,) = KEYS[name]
        mine = self.whole("labels").where(F.col("kind") == LABEL_DIMENSIONS[name])
        mine = mine.select(F.col("key").alias(key), F.col("label").alias(label))
        return self._stored(name, mine, True) if self._run_folder else mine

    def _wire(self) -> dict[str, Callable[[], DataFrame]]:
        r = self._raw
        w = self

        self._marts: dict[str, Callable[..., DataFrame]] = {
            "sales_overview": lambda **o: marts.sales_overview(
                w.whole(ROLLUP), w.dim_date, w.dim_order_status, **o
            ),
            "sales_by_category": lambda **o: marts.sales_by_category(
                w.rows("fact_order_items"), w.dim_product, w.dim_product_category, **o
            ),
            "payment_analysis": lambda **o: marts.payment_analysis(
                w.rows("fact_payments"), w.dim_date, w.dim_payment_type, **o
            ),
            "customer_satisfaction": lambda **o: marts.customer_satisfaction(w.rows("fact_reviews"), w.dim_date, **o),
            "delivery_performance": lambda **o: marts.delivery_performance(
                w.whole(ROLLUP), w.dim_date, w.dim_order_status, **o
            ),
            "marketing_funnel": lambda **o: marts.marketing_funnel(
                w.rows("fact_marketing_leads"), w.rows("fact_closed_deals"), w.dim_date, w.dim_marketing_origin, **o
            ),
        }
        # The builders of IN_PARTS take a filter that passes one range of the column that leads the fact's order.
        return {
            "stg_customers": lambda: stg.customers(r["customers"]),
            "stg_sellers": lambda: stg.sellers(r["sellers"]),
            "stg_geolocation": lambda: stg.geolocation(stg.geolocation_points(r["geolocation"])),
            "stg_product_categories": lambda: stg.product_categories(
                r["products"], r["product_category_name_translation"]
            ),
            "stg_products": lambda: stg.products(r["products"]),
            "stg_orders": lambda: stg.orders(r["orders"]),
            "stg_order_items": lambda: stg.order_items(r["order_items"]),
            "stg_payments": lambda: stg.payments(r["order_payments"]),
            "stg_reviews": lambda: stg.reviews(r["order_reviews"]),
            "stg_marketing_leads": lambda: stg.marketing_leads(r["marketing_qualified_leads"]),
            "stg_closed_deals": lambda: stg.closed_deals(r["closed_deals"]),
            "places": lambda: w._stored(
                "places", dim.place_candidates(w.stg_geolocation, w.stg_customers, w.stg_sellers)
            ),
            "harvest": lambda: w._stored("harvest", dim.harvest({t: w.table(t) for t in STAGING_TABLES})),
            "date_bounds": lambda: dim.date_bounds(w.whole("harvest")),
            "dim_date": lambda: w._stored("dim_date", dim.calendar(w.table("date_bounds")), True),
            "labels": lambda: w._stored(
                "label_keys",
                dim.label_keys(dense_key(dim.labels(w.whole("harvest")), "rank", ["kind", "label"], w._new_path("labels"))),
            ),
            "order_days": lambda: w._stored(
                "order_days", marts.order_days(w.rows("fact_orders"), w.rows("fact_order_items")), True
            ),
            "dim_state": lambda: dim.states(w.table("places")),
            "dim_city": lambda: dim.cities(w.table("places"), w.dim_state),
            "dim_zip_prefix": lambda: dim.zip_prefixes(w.table("places"), w.dim_state, w.dim_city),
            "dim_customer": lambda: dim.customers(numbered(w.stg_customers), w.dim_zip_prefix, w.dim_state, w.dim_city),
            "dim_seller": lambda: dim.sellers(numbered(w.stg_sellers), w.dim_zip_prefix, w.dim_state, w.dim_city),
            "dim_product_category": lambda: w.stg_product_categories,
            "dim_product": lambda: dim.products(numbered(w.stg_products), w.dim_product_category),
            **{d: (lambda d=d: w._label_dimension(d)) for d in LABEL_DIMENSIONS},
            "dim_sales_rep": lambda: dim.sales_reps(w.stg_closed_deals),
            "fact_marketing_leads": lambda: facts.resolve_marketing_leads(
                numbered(w.stg_marketing_leads), w.dim_landing_page, w.dim_marketing_origin
            ),
            "fact_closed_deals": lambda: facts.resolve_closed_deals(
                numbered(w.stg_closed_deals), w.dim_seller, w.dim_sales_rep, w.dim_business_segment,
                w.dim_lead_type, w.dim_lead_profile,
            ),
            "fact_orders": lambda part: facts.resolve_orders(numbered(part(w.stg_orders)), w.dim_customer, w.dim_order_status),
            "fact_order_items": lambda part: facts.resolve_order_items(
                numbered(part(w.stg_order_items), hashed=False), part(w.fact_orders), w.dim_product, w.dim_seller
            ),
            "fact_payments": lambda part: facts.resolve_payments(
                numbered(part(w.stg_payments)), part(w.fact_orders), w.dim_payment_type
            ),
            "fact_reviews": lambda part: facts.resolve_reviews(numbered(part(w.stg_reviews)), w.fact_orders),
            **{m: (lambda m=m: w._marts[m]()) for m in MARTS},
        }
