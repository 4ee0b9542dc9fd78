"""The eleven raw tables derived from the order / line item / event test tables.

The rules are plain SQL that Spark and DuckDB read alike (`{orders}` and so on name the base
tables), so a check in another engine starts from the same rows. Modulus rules plant the
NULLs, blanks, ties, identical reviews, broken value rules and missing partners that the operators
have to handle; a missing partner is made by spoiling the id that refers to it. Line numbers are
used as they are, which leaves some duplicate (order, item) pairs for the key validator.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_PLACES = """
        concat(' ', substr(n_name, 1, 1), lower(substr(n_name, 2)), ' ')"""

# Lower-case state codes by nation, four of them not Brazilian, one missing.
_STATE = """
        CASE n_nationkey
            WHEN 0 THEN ' ac' WHEN 1 THEN 'al' WHEN 2 THEN 'ap ' WHEN 3 THEN 'am' WHEN 4 THEN 'ba'
            WHEN 5 THEN 'ce' WHEN 6 THEN 'df' WHEN 7 THEN 'es' WHEN 8 THEN 'go' WHEN 9 THEN 'ma'
            WHEN 10 THEN 'mt' WHEN 11 THEN 'ms' WHEN 12 THEN 'mg' WHEN 13 THEN 'pa' WHEN 14 THEN 'pb'
            WHEN 15 THEN 'pr' WHEN 16 THEN 'pe' WHEN 17 THEN 'rj' WHEN 18 THEN 'rs' WHEN 19 THEN 'sp'
            WHEN 20 THEN 'xa' WHEN 21 THEN 'xb' WHEN 22 THEN 'xc' WHEN 23 THEN '  '
        END"""

SAMPLE_SQL = {
    "customers": f"""
    SELECT
        CAST(c_custkey AS STRING) AS customer_id,
        CASE WHEN c_custkey % 131 <> 0 THEN c_name END AS customer_unique_id,
        CASE WHEN c_custkey % 29 = 0 THEN concat(CAST(10000 + c_custkey % 400 AS STRING), '-77')
             WHEN c_custkey % 113 <> 0 THEN concat(' ', CAST(c_custkey % 400 AS STRING)) END
            AS customer_zip_code_prefix,
        CASE WHEN c_custkey % 127 <> 0 THEN {_PLACES} END AS customer_city,
        {_STATE} AS customer_state
    FROM {{customer}} LEFT JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "sellers": f"""
    SELECT
        CAST(s_suppkey AS STRING) AS seller_id,
        CASE WHEN s_suppkey % 41 <> 0 THEN CAST(350 + s_suppkey % 120 AS STRING) END
            AS seller_zip_code_prefix,
        CASE WHEN s_suppkey % 43 <> 0 THEN {_PLACES} END AS seller_city,
        {_STATE} AS seller_state
    FROM {{supplier}} LEFT JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "geolocation": f"""
    SELECT
        CASE WHEN c_custkey % 109 <> 0 THEN CAST(c_custkey % 300 AS STRING) END
            AS geolocation_zip_code_prefix,
        CAST(CASE WHEN c_custkey % 31 <> 0 THEN -c_acctbal / 400 END AS DECIMAL(10,7)) AS geolocation_lat,
        CAST(-c_acctbal / 200 AS DECIMAL(10,7)) AS geolocation_lng,
        CASE WHEN c_custkey % 127 <> 0 THEN {_PLACES} END AS geolocation_city,
        {_STATE} AS geolocation_state
    FROM {{customer}} LEFT JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "products": """
    SELECT
        CAST(p_partkey AS STRING) AS product_id,
        CASE p_partkey % 50 WHEN 1 THEN '  ' WHEN 2 THEN NULL
            WHEN 3 THEN concat('Rare ', CAST(p_partkey % 17 AS STRING)) ELSE concat(' ', lower(p_type)) END
            AS product_category_name,
        CAST(length(p_name) AS INT) AS product_name_lenght,
        CAST(p_size * 10 AS INT) AS product_description_lenght,
        CASE WHEN p_partkey % 31 <> 0 THEN CAST(p_size % 6 AS INT) END AS product_photos_qty,
        CAST(CASE WHEN p_partkey % 61 = 0 THEN -p_size ELSE p_size * 125 END AS DECIMAL(12,2)) AS product_weight_g,
        CAST(p_size + 10 AS DECIMAL(12,2)) AS product_length_cm,
        CAST(p_size % 9 + 1 AS DECIMAL(12,2)) AS product_height_cm,
        CASE WHEN p_partkey % 29 <> 0 THEN CAST(p_size % 12 + 2 AS DECIMAL(12,2)) END AS product_width_cm
    FROM {part}""",
    "product_category_name_translation": """
    SELECT
        CASE WHEN p_type = 'LARGE' THEN ' large ' ELSE lower(p_type) END AS product_category_name,
        CASE WHEN p_type = 'SMALL' THEN '' ELSE concat('cat ', lower(p_type)) END
            AS product_category_name_english
    FROM (SELECT DISTINCT p_type FROM {part}) AS kinds
    UNION ALL
    SELECT 'garden', 'garden tools'""",
    "orders": """
    SELECT
        CAST(o_orderkey AS STRING) AS order_id,
        CASE WHEN o_orderkey % 83 = 0 THEN concat('gone-', CAST(o_custkey AS STRING))
             WHEN o_orderkey % 89 = 0 THEN NULL
             ELSE CAST(o_custkey AS STRING) END AS customer_id,
        CASE WHEN o_orderkey % 53 = 0 THEN '  '
             WHEN o_orderstatus = 'F' THEN ' Delivered '
             WHEN o_orderstatus = 'O' THEN 'SHIPPED' END AS order_status,
        o_orderdate AS order_purchase_timestamp,
        CASE WHEN o_orderkey % 59 <> 0
             THEN o_orderdate + (o_orderkey % 9973) * INTERVAL '1' SECOND END AS order_approved_at,
        o_orderdate + (1 + o_orderkey % 5) * INTERVAL '1' DAY AS order_delivered_carrier_date,
        CASE WHEN o_orderstatus = 'F'
             THEN o_orderdate + (259200 + (o_orderkey * 7919) % 1728000) * INTERVAL '1' SECOND END
            AS order_delivered_customer_date,
        CASE WHEN o_orderkey % 61 <> 0
             THEN o_orderdate + (10 + o_custkey % 8) * INTERVAL '1' DAY END AS order_estimated_delivery_date
    FROM {orders}""",
    "order_items": """
    SELECT
        CAST(l_orderkey AS STRING) AS order_id,
        l_linenumber AS order_item_id,
        CASE WHEN l_partkey % 97 = 0 THEN concat('gone-', CAST(l_partkey AS STRING))
             ELSE CAST(l_partkey AS STRING) END AS product_id,
        CASE WHEN l_suppkey % 37 = 0 THEN concat('gone-', CAST(l_suppkey AS STRING))
             ELSE CAST(l_suppkey AS STRING) END AS seller_id,
        l_shipdate AS shipping_limit_date,
        CAST(CASE WHEN l_partkey % 67 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN -l_extendedprice
                  ELSE l_extendedprice END AS DECIMAL(12,2)) AS price,
        CASE WHEN l_partkey % 107 = 0 THEN CAST(-l_quantity AS DECIMAL(12,2))
             WHEN l_partkey % 71 <> 0 THEN CAST(l_quantity AS DECIMAL(12,2)) END AS freight_value
    FROM {lineitem}""",
    "order_payments": """
    SELECT
        CASE WHEN o_orderkey % 101 = 0 THEN concat(CAST(o_orderkey AS STRING), '-missing')
             ELSE CAST(o_orderkey AS STRING) END AS order_id,
        1 AS payment_sequential,
        CASE o_orderpriority
            WHEN '1-URGENT' THEN ' Credit_Card ' WHEN '2-HIGH' THEN 'BOLETO' WHEN '3-MEDIUM' THEN 'Voucher'
            WHEN '4-NOT SPECIFIED' THEN 'debit_card'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN '   ' END END AS payment_type,
        CAST(CASE WHEN o_orderkey % 103 = 0 THEN -1 WHEN o_orderkey % 107 <> 0 THEN o_orderkey % 10 END AS INT)
            AS payment_installments,
        CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value
    FROM {orders}
    UNION ALL
    SELECT
        CAST(o_orderkey AS STRING), 2, 'voucher', 1, CAST(10 AS DECIMAL(12,2))
    FROM {orders}
    WHERE o_orderkey % 7 = 0""",
    "order_reviews": """
    SELECT
        CAST(event_id AS STRING) AS review_id,
        CASE WHEN event_id % 89 = 0 THEN concat('missing-', CAST(event_id AS STRING))
             ELSE CAST(event_id AS STRING) END AS order_id,
        CAST(CASE WHEN event_id % 97 = 0 THEN 6 WHEN event_id % 79 <> 0 THEN 1 + event_id % 5 END AS INT) AS review_score,
        CASE event_id % 3 WHEN 0 THEN '  ' WHEN 1 THEN event_type END AS review_comment_title,
        CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE props END AS review_comment_message,
        ts + (event_id % 365) * INTERVAL '1' DAY AS review_creation_date,
        CASE WHEN event_id % 41 <> 0
             THEN ts + (event_id % 365) * INTERVAL '1' DAY
                     + ((event_id % 72) * 3600 + event_id % 3571) * INTERVAL '1' SECOND END
            AS review_answer_timestamp
    FROM (SELECT * FROM {events} UNION ALL SELECT * FROM {events} WHERE event_id % 149 = 0) AS twice
    WHERE event_type <> 'signup'""",
    "marketing_qualified_leads": """
    SELECT
        CAST(event_id AS STRING) AS mql_id,
        CAST(ts + (event_id % 365) * INTERVAL '1' DAY AS DATE) AS first_contact_date,
        CASE WHEN event_id % 23 = 0 THEN '  ' ELSE concat(' Page ', CAST(user_id % 20 AS STRING)) END
            AS landing_page_id,
        CASE user_id % 7 WHEN 0 THEN ' Paid_Search ' WHEN 1 THEN 'organic_search' WHEN 2 THEN 'Social'
            WHEN 3 THEN 'email' WHEN 4 THEN '  ' WHEN 5 THEN NULL ELSE 'display' END AS origin
    FROM {events}
    WHERE event_type = 'signup'""",
    "closed_deals": """
    SELECT
        CAST(event_id AS STRING) AS mql_id,
        CASE WHEN event_id % 19 = 0 THEN '  ' ELSE concat(' ', CAST(event_id % 120 AS STRING)) END AS seller_id,
        CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id % 5 AS STRING) END AS sdr_id,
        CASE WHEN event_id % 17 = 0 THEN '  ' ELSE CAST(user_id % 3 AS STRING) END AS sr_id,
        ts + (event_id % 365 + event_id % 30) * INTERVAL '1' DAY AS won_date,
        CASE user_id % 6 WHEN 0 THEN 'Home_Decor' WHEN 1 THEN ' pet ' WHEN 2 THEN NULL WHEN 3 THEN ''
            WHEN 4 THEN 'car_accessories' ELSE 'Pet' END AS business_segment,
        CASE event_id % 5 WHEN 0 THEN 'Online_Big' WHEN 1 THEN 'online_medium ' WHEN 2 THEN 'Offline'
            WHEN 3 THEN ' ' ELSE NULL END AS lead_type,
        CASE user_id % 5 WHEN 0 THEN 'Cat' WHEN 1 THEN 'eagle' WHEN 2 THEN 'Wolf ' WHEN 3 THEN 'shark' END
            AS lead_behaviour_profile,
        CASE user_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN ' Sim ' WHEN 3 THEN 'nao'
            WHEN 4 THEN '0' WHEN 5 THEN '?' END AS has_company,
        CASE event_id % 7 WHEN 0 THEN 'YES' WHEN 1 THEN ' n' WHEN 2 THEN 'NÃO' WHEN 3 THEN 'y'
            WHEN 4 THEN 'false' WHEN 5 THEN 'maybe' END AS has_gtin,
        CASE user_id % 4 WHEN 0 THEN ' 5-20 ' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN '' END AS average_stock,
        CASE event_id % 4 WHEN 0 THEN 'Reseller' WHEN 1 THEN 'manufacturer' WHEN 2 THEN ' ' END AS business_type,
        CASE WHEN user_id % 3 <> 0 THEN CAST(user_id % 1000 AS DECIMAL(14,2)) END AS declared_product_catalog_size,
        CASE WHEN event_id % 4 <> 0
             THEN CAST(CASE WHEN event_id % 5 = 0 THEN -100 ELSE 100 END * value AS DECIMAL(14,2)) END AS declared_monthly_revenue
    FROM {events}
    WHERE event_type = 'signup' AND event_id % 9 = 0""",
}


def sample_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy frames of the raw layer over the Parquet tables in `sf_dir`; every row of a base table is kept."""
    base = {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in BASE_TABLES}
    return {
        name: spark.sql(text, **{t: base[t] for t in re.findall(r"\{(\w+)\}", text)})
        for name, text in SAMPLE_SQL.items()
    }
