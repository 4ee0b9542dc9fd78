"""Staging layer: cleaned, renamed, typed copies of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import text as tx

CENTROID = "decimal(10,7)"


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        tx.zip_prefix("customer_zip_code_prefix").alias("zip_prefix"),
        tx.lower_text("customer_city").alias("city_name"),
        tx.upper_code("customer_state").alias("state_code"),
    )


def sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        tx.zip_prefix("seller_zip_code_prefix").alias("zip_prefix"),
        tx.lower_text("seller_city").alias("city_name"),
        tx.upper_code("seller_state").alias("state_code"),
    )


def geolocation_points(raw: DataFrame) -> DataFrame:
    """Cleaned points with a zip prefix, many per zip."""
    return raw.where(F.col("geolocation_zip_code_prefix").isNotNull()).select(
        tx.zip_prefix("geolocation_zip_code_prefix").alias("zip_prefix"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
        tx.lower_text("geolocation_city").alias("city_name"),
        tx.upper_code("geolocation_state").alias("state_code"),
    )


def _points_per_place(points: DataFrame) -> DataFrame:
    """Partial sums per (zip, city, state): hash-combined in the scan tasks, however hot a zip is."""
    return points.groupBy("zip_prefix", "city_name", "state_code").agg(
        F.count("*").alias("points"),
        F.sum("latitude").alias("lat_sum"),
        F.count("latitude").alias("lat_n"),
        F.sum("longitude").alias("lng_sum"),
        F.count("longitude").alias("lng_n"),
    )


def _modal() -> Column:
    """The most frequent place; ties go to the first city, then state, missing ones last."""
    return F.min(
        F.struct(
            (-F.col("points")).alias("rank"),
            F.col("city_name").isNull().alias("no_city"),
            F.col("city_name"),
            F.col("state_code").isNull().alias("no_state"),
            F.col("state_code"),
        )
    )


def _mean(total: str, n: str) -> Column:
    """Mean from partial sums; NULL when nothing was counted."""
    return F.try_divide(F.sum(total), F.sum(n)).cast(CENTROID)


def zip_centroids(points: DataFrame) -> DataFrame:
    return _points_per_place(points).groupBy("zip_prefix").agg(
        _mean("lat_sum", "lat_n").alias("latitude"), _mean("lng_sum", "lng_n").alias("longitude")
    )


def modal_places(points: DataFrame) -> DataFrame:
    """Most frequent (city, state) of each zip."""
    return (
        _points_per_place(points)
        .groupBy("zip_prefix")
        .agg(_modal().alias("m"))
        .select("zip_prefix", "m.city_name", "m.state_code")
    )


def geolocation(points: DataFrame) -> DataFrame:
    """One row per zip: mean position and most frequent place, both from a single pass."""
    return (
        _points_per_place(points)
        .groupBy("zip_prefix")
        .agg(
            _mean("lat_sum", "lat_n").alias("latitude"),
            _mean("lng_sum", "lng_n").alias("longitude"),
            _modal().alias("m"),
        )
        .select("zip_prefix", "latitude", "longitude", "m.city_name", "m.state_code")
    )


def category_universe(products: DataFrame, translation: DataFrame) -> DataFrame:
    name = tx.blank_to_unknown("product_category_name").alias("product_category_name")
    return products.select(name).union(translation.select(name)).distinct()


def product_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Translated names. The lookup is on the name as delivered, so a padded name stays untranslated."""
    english = translation.select(
        F.col("product_category_name"), F.col("product_category_name_english").alias("english")
    )
    return (
        category_universe(products, translation)
        .join(english, "product_category_name", "left")
        .select(
            "product_category_name",
            F.coalesce("english", "product_category_name").alias("product_category_name_english"),
        )
    )


def products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        tx.blank_to_unknown("product_category_name").alias("product_category_name"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        tx.lower_text("order_status").alias("order_status"),
        F.col("order_purchase_timestamp").alias("order_purchase_ts"),
        F.col("order_approved_at").alias("order_approved_ts"),
        F.col("order_delivered_carrier_date").alias("order_delivered_carrier_ts"),
        F.col("order_delivered_customer_date").alias("order_delivered_customer_ts"),
        F.col("order_estimated_delivery_date").alias("order_estimated_delivery_ts"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("shipping_limit_date", "shipping_limit_ts")


def payments(raw: DataFrame) -> DataFrame:
    return raw.withColumn("payment_type", tx.lower_text("payment_type"))


def reviews(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(
        {"review_creation_date": "review_creation_ts", "review_answer_timestamp": "review_answer_ts"}
    )


def marketing_leads(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "landing_page_id": tx.blank_to_unknown("landing_page_id"),
            "origin": tx.blank_to_unknown_lower("origin"),
        }
    )


def closed_deals(raw: DataFrame) -> DataFrame:
    optional_ids = ["seller_id", "sdr_id", "sr_id"]
    categories = ["business_segment", "lead_type", "lead_behaviour_profile", "business_type"]
    return raw.withColumnRenamed("won_date", "won_ts").withColumns(
        {c: tx.blank_to_null(c) for c in optional_ids}
        | {c: tx.blank_to_unknown_lower(c) for c in categories}
        | {c: tx.yes_no(c) for c in ["has_company", "has_gtin"]}
        | {"average_stock": tx.blank_to_null(F.lower("average_stock"))}
    )
