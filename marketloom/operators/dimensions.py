"""Dimension tables before key assignment, and lookups of keys already assigned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.text import label_or_unknown
from marketloom.functions.timing import date_key
from marketloom.operators.surrogate import ROW_HASH, ROW_NO

# Names of the Brazilian states by code.
STATE_NAMES = {
    "AC": "Acre",
    "AL": "Alagoas",
    "AP": "Amapá",
    "AM": "Amazonas",
    "BA": "Bahia",
    "CE": "Ceará",
    "DF": "Distrito Federal",
    "ES": "Espírito Santo",
    "GO": "Goiás",
    "MA": "Maranhão",
    "MT": "Mato Grosso",
    "MS": "Mato Grosso do Sul",
    "MG": "Minas Gerais",
    "PA": "Pará",
    "PB": "Paraíba",
    "PR": "Paraná",
    "PE": "Pernambuco",
    "PI": "Piauí",
    "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte",
    "RS": "Rio Grande do Sul",
    "RO": "Rondônia",
    "RR": "Roraima",
    "SC": "Santa Catarina",
    "SP": "São Paulo",
    "SE": "Sergipe",
    "TO": "Tocantins",
}

# Every staging column that a date key may point to.
DATED_COLUMNS = {
    "stg_marketing_leads": ["first_contact_date"],
    "stg_closed_deals": ["won_ts"],
    "stg_orders": [
        "order_purchase_ts",
        "order_approved_ts",
        "order_delivered_carrier_ts",
        "order_delivered_customer_ts",
        "order_estimated_delivery_ts",
    ],
    "stg_order_items": ["shipping_limit_ts"],
    "stg_reviews": ["review_creation_ts", "review_answer_ts"],
}


#: Kind of label -> staging table and column it is drawn from.
LABELS = {
    "order_status": ("stg_orders", "order_status"),
    "payment_type": ("stg_payments", "payment_type"),
    "marketing_origin": ("stg_marketing_leads", "origin"),
    "landing_page": ("stg_marketing_leads", "landing_page_id"),
    "business_segment": ("stg_closed_deals", "business_segment"),
    "lead_type": ("stg_closed_deals", "lead_type"),
    "lead_profile": ("stg_closed_deals", "lead_behaviour_profile"),
}


def harvest(staging: dict[str, DataFrame]) -> DataFrame:
    """kind, label, low, high: every label with the first and last day beside it, each staging table read once.

    Labels are put in rows and combined before the shuffle, so what moves follows the number of labels.
    A table without labels gives one row of days alone.
    """

    def found(table: str) -> DataFrame:
        days = [F.to_date(c) for c in DATED_COLUMNS.get(table, [])] or [F.lit(None).cast("date")]
        low, high = (f(*days) if len(days) > 1 else days[0] for f in (F.least, F.greatest))
        kinds = [(k, c) for k, (t, c) in LABELS.items() if t == table] or [(None, None)]
        label = lambda c: label_or_unknown(c) if c else F.lit(None).cast("string")
        entries = [F.struct(F.lit(k).cast("string").alias("kind"), label(c).alias("label")) for k, c in kinds]
        rows = staging[table].select(low.alias("low"), high.alias("high"), F.inline(F.array(*entries)))
        return rows.groupBy("kind", "label").agg(F.min("low").alias("low"), F.max("high").alias("high"))

    names = dict.fromkeys([*DATED_COLUMNS, *(t for t, _ in LABELS.values())])
    return reduce(DataFrame.unionByName, [found(t) for t in names])


def date_bounds(harvested: DataFrame) -> DataFrame:
    """First and last day over all dated columns."""
    return harvested.agg(F.min("low").alias("min_date"), F.max("high").alias("max_date"))


def labels(harvested: DataFrame) -> DataFrame:
    """Distinct (kind, label), with an `unknown` member for blanks and NULLs."""
    return harvested.where("kind is not null").select("kind", "label").distinct()


def label_keys(keyed: DataFrame) -> DataFrame:
    """kind, label and key = 1..n within each kind, from the rank of (kind, label) over all kinds."""
    first = keyed.groupBy(F.col("kind").alias("of")).agg(F.min("rank").alias("first"))
    return keyed.join(first, F.col("kind") == F.col("of")).select("kind", "label", (F.col("rank") - F.col("first") + 1).alias("key"))


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day between the bounds, both included, with its attributes; no rows without bounds."""
    d = F.col("full_date")
    return bounds.select(
        F.explode(F.sequence("min_date", "max_date", F.expr("interval 1 day"))).alias("full_date")
    ).select(
        date_key(d).alias("date_key"),
        d,
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def place_candidates(geolocation: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Distinct (zip, city, state) seen in each source, in order of trust.

    States, cities and zips are all drawn from this table, so each source is read once, and the
    number of rows follows the number of places, not the number of customers.
    """
    place = ["zip_prefix", "city_name", "state_code"]
    nowhere = F.lit(None).cast("decimal(10,7)")

    def seen(df: DataFrame, trust: int) -> DataFrame:
        return df.select(*place).distinct().select(
            *place, nowhere.alias("latitude"), nowhere.alias("longitude"), F.lit(trust).alias("trust")
        )

    located = geolocation.select(*place, "latitude", "longitude", F.lit(1).alias("trust"))
    return located.unionByName(seen(customers, 2)).unionByName(seen(sellers, 3))


def states(places: DataFrame) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in STATE_NAMES.items() for x in pair])
    return (
        places.where(F.col("state_code") != "")
        .select("state_code")
        .distinct()
        .select("state_code", names[F.col("state_code")].alias("state_name"))
    )


def cities(places: DataFrame, dim_state: DataFrame) -> DataFrame:
    return (
        places.where(F.col("city_name") != "")
        .select("city_name", "state_code")
        .distinct()
        .join(dim_state.select("state_code", "state_key"), "state_code")
        .select("city_name", "state_key")
    )


def _own(stg: DataFrame) -> list[str]:
    """Columns that only order rows."""
    return [c for c in stg.columns if c in (ROW_HASH, ROW_NO)]


def _with_place_keys(df: DataFrame, dim_state: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Resolve the row's own state code, then its city within that state; misses give NULL keys."""
    return df.join(dim_state.select("state_code", "state_key"), "state_code", "left").join(
        dim_city.select("city_name", "state_key", "city_key"), ["city_name", "state_key"], "left"
    )


def zip_prefixes(places: DataFrame, dim_state: DataFrame, dim_city: DataFrame) -> DataFrame:
    """One row per zip from its most trusted source, first city and state, missing ones last."""
    best = F.min(
        F.struct(
            "trust",
            F.col("city_name").isNull().alias("no_city"),
            "city_name",
            F.col("state_code").isNull().alias("no_state"),
            "state_code",
            "latitude",
            "longitude",
        )
    )
    chosen = (
        places.where(F.col("zip_prefix") != "")
        .groupBy("zip_prefix")
        .agg(best.alias("b"))
        .select("zip_prefix", "b.city_name", "b.state_code", "b.latitude", "b.longitude")
    )
    return _with_place_keys(chosen, dim_state, dim_city).select(
        "zip_prefix", "city_key", "state_key", "latitude", "longitude"
    )


def customers(
    stg: DataFrame, dim_zip: DataFrame, dim_state: DataFrame, dim_city: DataFrame
) -> DataFrame:
    """City and state come from the customer row, the zip only adds its own key."""
    return _with_place_keys(
        stg.join(dim_zip.select("zip_prefix", "zip_prefix_key"), "zip_prefix", "left"), dim_state, dim_city
    ).select("customer_id", "customer_unique_id", "zip_prefix_key", "city_key", "state_key", *_own(stg))


def sellers(stg: DataFrame, dim_zip: DataFrame, dim_state: DataFrame, dim_city: DataFrame) -> DataFrame:
    return _with_place_keys(
        stg.join(dim_zip.select("zip_prefix", "zip_prefix_key"), "zip_prefix", "left"), dim_state, dim_city
    ).select("seller_id", "zip_prefix_key", "city_key", "state_key", *_own(stg))


def products(stg: DataFrame, dim_category: DataFrame) -> DataFrame:
    measures = [c for c in stg.columns if c not in ("product_id", "product_category_name")]
    return stg.join(
        dim_category.select("product_category_name", "product_category_key"), "product_category_name", "left"
    ).select("product_id", "product_category_key", *measures)


def sales_reps(deals: DataFrame) -> DataFrame:
    """Distinct (id, role); the same id may hold both roles. One scan serves both roles."""
    roles = F.array(
        F.struct(F.col("sdr_id").alias("sales_rep_id"), F.lit("SDR").alias("sales_role")),
        F.struct(F.col("sr_id").alias("sales_rep_id"), F.lit("SR").alias("sales_role")),
    )
    return deals.select(F.inline(roles)).where(F.col("sales_rep_id") != "").distinct()
