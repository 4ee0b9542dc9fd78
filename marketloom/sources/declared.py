"""Declared columns and types of the staging, dwh and mart tables; hidden columns are not part of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Columns, their order and types.
TABLES = {
    "stg_customers": """
        customer_id string, customer_unique_id string, zip_prefix string, city_name string, state_code string""",
    "stg_sellers": """
        seller_id string, zip_prefix string, city_name string, state_code string""",
    "stg_geolocation": """
        zip_prefix string, latitude decimal(10,7), longitude decimal(10,7), city_name string, state_code
        string""",
    "stg_product_categories": """
        product_category_name string, product_category_name_english string""",
    "stg_products": """
        product_id string, product_category_name string, product_name_length int, product_description_length
        int, product_photos_qty int, product_weight_g decimal(12,2), product_length_cm decimal(12,2),
        product_height_cm decimal(12,2), product_width_cm decimal(12,2)""",
    "stg_orders": """
        order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz,
        order_approved_ts timestamp_ntz, order_delivered_carrier_ts timestamp_ntz, order_delivered_customer_ts
        timestamp_ntz, order_estimated_delivery_ts timestamp_ntz""",
    "stg_order_items": """
        order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_ts
        timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)""",
    "stg_payments": """
        order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value
        decimal(12,2)""",
    "stg_reviews": """
        review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_ts timestamp_ntz, review_answer_ts timestamp_ntz""",
    "stg_marketing_leads": """
        mql_id string, first_contact_date date, landing_page_id string, origin string""",
    "stg_closed_deals": """
        mql_id string, seller_id string, sdr_id string, sr_id string, won_ts timestamp_ntz, business_segment
        string, lead_type string, lead_behaviour_profile string, has_company boolean, has_gtin boolean,
        average_stock string, business_type string, declared_product_catalog_size decimal(14,2),
        declared_monthly_revenue decimal(14,2)""",
    "dim_date": """
        date_key int, full_date date, day_of_month int, day_of_week int, day_name string, week_of_year int,
        month_number int, month_name string, quarter_number int, year_number int, is_weekend boolean""",
    "dim_state": """
        state_key bigint, state_code string, state_name string""",
    "dim_city": """
        city_key bigint, city_name string, state_key bigint""",
    "dim_zip_prefix": """
        zip_prefix_key bigint, zip_prefix string, city_key bigint, state_key bigint, latitude decimal(10,7),
        longitude decimal(10,7)""",
    "dim_customer": """
        customer_key bigint, customer_id string, customer_unique_id string, zip_prefix_key bigint, city_key
        bigint, state_key bigint""",
    "dim_seller": """
        seller_key bigint, seller_id string, zip_prefix_key bigint, city_key bigint, state_key bigint""",
    "dim_product_category": """
        product_category_key bigint, product_category_name string, product_category_name_english string""",
    "dim_product": """
        product_key bigint, product_id string, product_category_key bigint, product_name_length int,
        product_description_length int, product_photos_qty int, product_weight_g decimal(12,2),
        product_length_cm decimal(12,2), product_height_cm decimal(12,2), product_width_cm decimal(12,2)""",
    "dim_order_status": """
        order_status_key bigint, order_status string""",
    "dim_payment_type": """
        payment_type_key bigint, payment_type string""",
    "dim_marketing_origin": """
        marketing_origin_key bigint, origin_name string""",
    "dim_landing_page": """
        landing_page_key bigint, landing_page_id string""",
    "dim_business_segment": """
        business_segment_key bigint, business_segment string""",
    "dim_lead_type": """
        lead_type_key bigint, lead_type string""",
    "dim_lead_profile": """
        lead_profile_key bigint, lead_behaviour_profile string""",
    "dim_sales_rep": """
        sales_rep_key bigint, sales_rep_id string, sales_role string""",
    "fact_marketing_leads": """
        marketing_lead_key bigint, mql_id string, first_contact_date_key int, landing_page_key bigint,
        marketing_origin_key bigint, lead_count int""",
    "fact_closed_deals": """
        closed_deal_key bigint, mql_id string, seller_key bigint, won_date_key int, sdr_sales_rep_key bigint,
        sr_sales_rep_key bigint, business_segment_key bigint, lead_type_key bigint, lead_profile_key bigint,
        has_company boolean, has_gtin boolean, average_stock string, business_type string,
        declared_product_catalog_size decimal(14,2), declared_monthly_revenue decimal(14,2), is_active_seller
        boolean, deal_count int""",
    "fact_orders": """
        order_key bigint, order_id string, customer_key bigint, order_status_key bigint, purchase_date_key
        int, approved_date_key int, delivered_carrier_date_key int, delivered_customer_date_key int,
        estimated_delivery_date_key int, order_purchase_ts timestamp_ntz, order_approved_ts timestamp_ntz,
        order_delivered_carrier_ts timestamp_ntz, order_delivered_customer_ts timestamp_ntz,
        order_estimated_delivery_ts timestamp_ntz, approval_delay_hours decimal(12,2), days_to_carrier
        decimal(12,2), days_to_customer decimal(12,2), estimated_delivery_days decimal(12,2),
        delivery_delay_days decimal(12,2), is_delivered_on_time boolean, is_delivered boolean, order_count int""",
    "fact_order_items": """
        order_item_key bigint, order_id string, order_item_id int, order_key bigint, product_key bigint,
        seller_key bigint, shipping_limit_date_key int, shipping_limit_ts timestamp_ntz, item_price
        decimal(12,2), freight_value decimal(12,2), total_item_value decimal(12,2), item_count int""",
    "fact_payments": """
        payment_key bigint, order_id string, payment_sequential int, order_key bigint, payment_type_key
        bigint, payment_installments int, payment_value decimal(12,2), payment_count int""",
    "fact_reviews": """
        review_key bigint, review_id string, order_id string, order_key bigint, review_creation_date_key int,
        review_answer_date_key int, review_score int, review_comment_title string, review_comment_message
        string, review_creation_ts timestamp_ntz, review_answer_ts timestamp_ntz, review_response_time_hours
        decimal(12,2), has_review_title boolean, has_review_message boolean, is_positive_review boolean,
        is_neutral_review boolean, is_negative_review boolean, review_count int""",
    "sales_overview": """
        year_number int, month_number int, month_name string, order_status string, order_count bigint,
        item_count bigint, gross_item_value decimal(38,2), gross_freight_value decimal(38,2), gross_revenue
        decimal(38,2)""",
    "sales_by_category": """
        product_category string, item_count bigint, order_count bigint, gross_item_value decimal(38,2),
        gross_freight_value decimal(38,2), gross_revenue decimal(38,2)""",
    "payment_analysis": """
        year_number int, month_number int, month_name string, payment_type string, payment_installments int,
        payment_count bigint, total_payment_value decimal(38,2), avg_payment_value double""",
    "customer_satisfaction": """
        year_number int, month_number int, month_name string, review_score int, review_count bigint,
        avg_review_score double""",
    "delivery_performance": """
        year_number int, month_number int, month_name string, order_status string, delivered_orders bigint,
        avg_days_purchase_to_delivery double, avg_days_vs_estimate double, on_time_rate double""",
    "marketing_funnel": """
        year_number int, month_number int, month_name string, marketing_origin string, mql_count bigint,
        won_deal_count bigint, declared_monthly_revenue_sum decimal(38,2), conversion_rate double""",
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def conforming(table: str, df: DataFrame) -> DataFrame:
    """`df` if it has exactly the declared columns and types of `table`, else an error that names the differences."""
    want, have = [(f.name, f.dataType.simpleString()) for f in schema_of(table)], df.dtypes
    if want != have:
        raise TypeError(f"{table}: declared {sorted(set(want) - set(have))}, found {sorted(set(have) - set(want))}, or another order")
    return df
