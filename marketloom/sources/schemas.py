"""Declared schemas of the eleven source files. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column order is binding because files are matched by position, and the
# spelling (`lenght` included) is the source's own.
RAW_COLUMNS = {
    "customers": """
        customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string""",
    "geolocation": """
        geolocation_zip_code_prefix string, geolocation_lat decimal(10,7),
        geolocation_lng decimal(10,7), geolocation_city string, geolocation_state string""",
    "marketing_qualified_leads": """
        mql_id string, first_contact_date date, landing_page_id string, origin string""",
    "closed_deals": """
        mql_id string, seller_id string, sdr_id string, sr_id string, won_date timestamp_ntz,
        business_segment string, lead_type string, lead_behaviour_profile string,
        has_company string, has_gtin string, average_stock string, business_type string,
        declared_product_catalog_size decimal(14,2), declared_monthly_revenue decimal(14,2)""",
    "orders": """
        order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz""",
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)""",
    "order_payments": """
        order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value decimal(12,2)""",
    "order_reviews": """
        review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date timestamp_ntz,
        review_answer_timestamp timestamp_ntz""",
    "products": """
        product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g decimal(12,2),
        product_length_cm decimal(12,2), product_height_cm decimal(12,2),
        product_width_cm decimal(12,2)""",
    "sellers": """
        seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string""",
    "product_category_name_translation": """
        product_category_name string, product_category_name_english string""",
}

RAW_TABLES = list(RAW_COLUMNS)


def raw_schema(table: str) -> StructType:
    return StructType.fromDDL(RAW_COLUMNS[table])
