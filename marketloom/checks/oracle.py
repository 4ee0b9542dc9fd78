"""Reference answers in DuckDB SQL.

Every answer starts from the raw rows of `sources.sample` and states the operator anew, mostly
along another path than the Spark code: marts come straight from staging rows by natural keys,
keys from ROW_NUMBER, rounding from integer arithmetic. Decimals are compared as DOUBLE.
"""

from __future__ import annotations

import re

from marketloom.operators import constraints as con
from marketloom.sources.sample import BASE_TABLES, SAMPLE_SQL

_HOUR_US = 3_600_000_000
_DAY_US = 86_400_000_000


def _gap(start: str, end: str) -> str:
    return f"(epoch_us({end}) - epoch_us({start}))"


def _elapsed(start: str, end: str, unit_us: int) -> str:
    """Two decimals, halves away from zero, on whole microseconds."""
    us = _gap(start, end)
    return f"(sign({us}) * ((abs({us}) * 200 + {unit_us}) // (2 * {unit_us})) / 100.0)"


def _mean7(column: str) -> str:
    """Mean of a decimal with seven places, rounded to seven places on integers."""
    total = f"SUM(CAST({column} * 10000000 AS HUGEINT))"
    n = f"COUNT({column})"
    return (
        f"CASE WHEN {n} > 0 THEN sign({total}) * ((abs({total}) * 2 + {n}) // (2 * {n})) / 10000000.0 END"
    )


def _key(order: str) -> str:
    terms = ", ".join(f"{c.strip()} ASC NULLS LAST" for c in order.split(","))
    return f"ROW_NUMBER() OVER (ORDER BY {terms})"


def _day(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


def _bool(column: str) -> str:
    def quoted(words: list[str]) -> str:
        return ", ".join(f"'{w}'" for w in words)

    word = f"trim(lower({column}))"
    return f"CASE WHEN {word} IN ({quoted(['true', '1', 'yes', 'y', 'sim'])}) THEN true WHEN {word} IN ({quoted(['false', '0', 'no', 'n', 'nao', 'não'])}) THEN false END"


def _unknown(expression: str) -> str:
    return f"CASE WHEN {expression} IS NULL OR {expression} = '' THEN 'unknown' ELSE {expression} END"


def _label(column: str) -> str:
    """What a left join to the label dimension finds: NULL for blank, unknown for missing."""
    return f"CASE WHEN {column} = '' THEN NULL WHEN {column} IS NULL THEN 'unknown' ELSE {column} END"


def _month(ts: str) -> str:
    return (
        f"CAST(year({ts}) AS INTEGER) AS year_number, CAST(month({ts}) AS INTEGER) AS month_number, "
        f"monthname({ts}) AS month_name"
    )


def _small_dim(stg: str, column: str, key: str, alias: str | None = None) -> str:
    name = alias or column
    return f"""SELECT {_key(name)} AS {key}, {name}
        FROM (SELECT DISTINCT {_unknown(column)} AS {name} FROM {stg}) AS v"""


_STATES = """('AC', 'Acre'), ('AL', 'Alagoas'), ('AP', 'Amapá'), ('AM', 'Amazonas'), ('BA', 'Bahia'), ('CE', 'Ceará'),
    ('DF', 'Distrito Federal'), ('ES', 'Espírito Santo'), ('GO', 'Goiás'), ('MA', 'Maranhão'), ('MT', 'Mato Grosso'),
    ('MS', 'Mato Grosso do Sul'), ('MG', 'Minas Gerais'), ('PA', 'Pará'), ('PB', 'Paraíba'), ('PR', 'Paraná'),
    ('PE', 'Pernambuco'), ('PI', 'Piauí'), ('RJ', 'Rio de Janeiro'), ('RN', 'Rio Grande do Norte'),
    ('RS', 'Rio Grande do Sul'), ('RO', 'Rondônia'), ('RR', 'Roraima'), ('SC', 'Santa Catarina'), ('SP', 'São Paulo'),
    ('SE', 'Sergipe'), ('TO', 'Tocantins')"""

_ZIP = "lpad(trim({0}), 5, '0') AS zip_prefix"

# Named relations, each using only base tables and earlier names.
RELATIONS: dict[str, str] = {
    f"raw_{name}": text.format(**{t: t for t in BASE_TABLES}) for name, text in SAMPLE_SQL.items()
}
RELATIONS |= {
    "stg_customers": f"""SELECT customer_id, customer_unique_id, {_ZIP.format('customer_zip_code_prefix')},
        lower(trim(customer_city)) AS city_name, upper(trim(customer_state)) AS state_code FROM raw_customers""",
    "stg_sellers": f"""SELECT seller_id, {_ZIP.format('seller_zip_code_prefix')},
        lower(trim(seller_city)) AS city_name, upper(trim(seller_state)) AS state_code FROM raw_sellers""",
    "geo_points": f"""SELECT {_ZIP.format('geolocation_zip_code_prefix')}, geolocation_lat AS latitude,
        geolocation_lng AS longitude, lower(trim(geolocation_city)) AS city_name,
        upper(trim(geolocation_state)) AS state_code
        FROM raw_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL""",
    "geo_centroid": f"""SELECT zip_prefix, {_mean7('latitude')} AS latitude, {_mean7('longitude')} AS longitude
        FROM geo_points GROUP BY zip_prefix""",
    "geo_modal": """SELECT zip_prefix, city_name, state_code FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY zip_prefix
                ORDER BY n DESC, city_name ASC NULLS LAST, state_code ASC NULLS LAST) AS place
            FROM (SELECT zip_prefix, city_name, state_code, COUNT(*) AS n FROM geo_points GROUP BY ALL) AS c
        ) AS r WHERE place = 1""",
    "stg_geolocation": """SELECT c.zip_prefix, latitude, longitude, city_name, state_code
        FROM geo_centroid AS c LEFT JOIN geo_modal AS m ON c.zip_prefix = m.zip_prefix""",
    "category_universe": f"""SELECT {_unknown('trim(product_category_name)')} AS product_category_name FROM raw_products
        UNION SELECT {_unknown('trim(product_category_name)')} FROM raw_product_category_name_translation""",
    "stg_product_categories": """SELECT u.product_category_name,
        COALESCE(t.product_category_name_english, u.product_category_name) AS product_category_name_english
        FROM category_universe AS u LEFT JOIN raw_product_category_name_translation AS t
        ON t.product_category_name = u.product_category_name""",
    "stg_products": f"""SELECT product_id, {_unknown('trim(product_category_name)')} AS product_category_name,
        product_name_lenght AS product_name_length, product_description_lenght AS product_description_length,
        product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM raw_products""",
    "stg_orders": """SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
        order_purchase_timestamp AS order_purchase_ts, order_approved_at AS order_approved_ts,
        order_delivered_carrier_date AS order_delivered_carrier_ts,
        order_delivered_customer_date AS order_delivered_customer_ts,
        order_estimated_delivery_date AS order_estimated_delivery_ts FROM raw_orders""",
    "stg_order_items": """SELECT order_id, order_item_id, product_id, seller_id,
        shipping_limit_date AS shipping_limit_ts, price, freight_value FROM raw_order_items""",
    "stg_payments": """SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
        payment_installments, payment_value FROM raw_order_payments""",
    "stg_reviews": """SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
        review_creation_date AS review_creation_ts, review_answer_timestamp AS review_answer_ts
        FROM raw_order_reviews""",
    "stg_marketing_leads": f"""SELECT mql_id, first_contact_date, {_unknown('trim(landing_page_id)')} AS landing_page_id,
        {_unknown('lower(trim(origin))')} AS origin FROM raw_marketing_qualified_leads""",
    "stg_closed_deals": f"""SELECT mql_id, nullif(trim(seller_id), '') AS seller_id, nullif(trim(sdr_id), '') AS sdr_id,
        nullif(trim(sr_id), '') AS sr_id, won_date AS won_ts,
        {_unknown('lower(trim(business_segment))')} AS business_segment,
        {_unknown('lower(trim(lead_type))')} AS lead_type,
        {_unknown('lower(trim(lead_behaviour_profile))')} AS lead_behaviour_profile,
        {_bool('has_company')} AS has_company, {_bool('has_gtin')} AS has_gtin,
        nullif(lower(trim(average_stock)), '') AS average_stock,
        {_unknown('lower(trim(business_type))')} AS business_type,
        declared_product_catalog_size, declared_monthly_revenue FROM raw_closed_deals""",
    "used_days": " UNION ".join(
        f"SELECT CAST({c} AS DATE) AS d FROM {t}"
        for t, cols in {
            "stg_marketing_leads": ["first_contact_date"],
            "stg_closed_deals": ["won_ts"],
            "stg_orders": [
                "order_purchase_ts", "order_approved_ts", "order_delivered_carrier_ts",
                "order_delivered_customer_ts", "order_estimated_delivery_ts",
            ],
            "stg_order_items": ["shipping_limit_ts"],
            "stg_reviews": ["review_creation_ts", "review_answer_ts"],
        }.items()
        for c in cols
    ),
    "date_bounds": "SELECT MIN(d) AS min_date, MAX(d) AS max_date FROM used_days",
    "dim_date": f"""SELECT {_day('d')} AS date_key, CAST(d AS DATE) AS full_date, CAST(day(d) AS INTEGER) AS day_of_month,
        CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, CAST(week(d) AS INTEGER) AS week_of_year,
        CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
        CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(year(d) AS INTEGER) AS year_number,
        isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT unnest(generate_series(CAST(min_date AS TIMESTAMP), CAST(max_date AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM date_bounds) AS s""",
    "dim_state": f"""SELECT {_key('c.state_code')} AS state_key, c.state_code, n.state_name FROM (
            SELECT state_code FROM stg_geolocation UNION SELECT state_code FROM stg_customers
            UNION SELECT state_code FROM stg_sellers) AS c
        LEFT JOIN (VALUES {_STATES}) AS n(state_code, state_name) ON n.state_code = c.state_code
        WHERE c.state_code IS NOT NULL AND c.state_code <> ''""",
    "dim_city": f"""SELECT {_key('city_name, state_key')} AS city_key, city_name, state_key FROM (
            SELECT DISTINCT c.city_name, s.state_key FROM (
                SELECT city_name, state_code FROM stg_geolocation UNION ALL
                SELECT city_name, state_code FROM stg_customers UNION ALL
                SELECT city_name, state_code FROM stg_sellers) AS c, dim_state AS s
            WHERE c.state_code = s.state_code AND c.city_name <> '') AS v""",
    "zip_choice": """SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY zip_prefix
                ORDER BY origin, city_name ASC NULLS LAST, state_code ASC NULLS LAST) AS place
            FROM (SELECT 1 AS origin, zip_prefix, city_name, state_code, latitude, longitude FROM stg_geolocation
                  UNION ALL SELECT 2, zip_prefix, city_name, state_code, NULL, NULL FROM stg_customers
                  UNION ALL SELECT 3, zip_prefix, city_name, state_code, NULL, NULL FROM stg_sellers) AS u
            WHERE zip_prefix IS NOT NULL AND zip_prefix <> '') AS r WHERE place = 1""",
    "dim_zip_prefix": f"""SELECT {_key('z.zip_prefix')} AS zip_prefix_key, z.zip_prefix, c.city_key, s.state_key,
        z.latitude, z.longitude FROM zip_choice AS z
        LEFT JOIN dim_state AS s ON s.state_code = z.state_code
        LEFT JOIN dim_city AS c ON c.city_name = z.city_name AND c.state_key = s.state_key""",
    "dim_customer": f"""SELECT {_key('p.customer_id')} AS customer_key, p.customer_id, p.customer_unique_id,
        z.zip_prefix_key, c.city_key, s.state_key FROM stg_customers AS p
        LEFT JOIN dim_zip_prefix AS z ON z.zip_prefix = p.zip_prefix
        LEFT JOIN dim_state AS s ON s.state_code = p.state_code
        LEFT JOIN dim_city AS c ON c.city_name = p.city_name AND c.state_key = s.state_key""",
    "dim_seller": f"""SELECT {_key('p.seller_id')} AS seller_key, p.seller_id, z.zip_prefix_key, c.city_key, s.state_key
        FROM stg_sellers AS p
        LEFT JOIN dim_zip_prefix AS z ON z.zip_prefix = p.zip_prefix
        LEFT JOIN dim_state AS s ON s.state_code = p.state_code
        LEFT JOIN dim_city AS c ON c.city_name = p.city_name AND c.state_key = s.state_key""",
    "dim_product_category": f"""SELECT {_key('product_category_name')} AS product_category_key, product_category_name,
        product_category_name_english FROM stg_product_categories""",
    "dim_product": f"""SELECT {_key('p.product_id')} AS product_key, p.product_id, c.product_category_key,
        p.product_name_length, p.product_description_length, p.product_photos_qty, p.product_weight_g,
        p.product_length_cm, p.product_height_cm, p.product_width_cm
        FROM stg_products AS p LEFT JOIN dim_product_category AS c ON c.product_category_name = p.product_category_name""",
    "dim_order_status": _small_dim("stg_orders", "order_status", "order_status_key"),
    "dim_payment_type": _small_dim("stg_payments", "payment_type", "payment_type_key"),
    "dim_marketing_origin": _small_dim("stg_marketing_leads", "origin", "marketing_origin_key", "origin_name"),
    "dim_landing_page": _small_dim("stg_marketing_leads", "landing_page_id", "landing_page_key"),
    "dim_business_segment": _small_dim("stg_closed_deals", "business_segment", "business_segment_key"),
    "dim_lead_type": _small_dim("stg_closed_deals", "lead_type", "lead_type_key"),
    "dim_lead_profile": _small_dim("stg_closed_deals", "lead_behaviour_profile", "lead_profile_key"),
    "dim_sales_rep": f"""SELECT {_key('sales_rep_id, sales_role')} AS sales_rep_key, sales_rep_id, sales_role FROM (
            SELECT sdr_id AS sales_rep_id, 'SDR' AS sales_role FROM stg_closed_deals WHERE sdr_id <> ''
            UNION SELECT sr_id, 'SR' FROM stg_closed_deals WHERE sr_id <> '') AS v""",
    "fact_marketing_leads": f"""SELECT {_key('l.mql_id')} AS marketing_lead_key, l.mql_id,
        {_day('l.first_contact_date')} AS first_contact_date_key, p.landing_page_key, o.marketing_origin_key,
        1 AS lead_count FROM stg_marketing_leads AS l
        LEFT JOIN dim_landing_page AS p USING (landing_page_id)
        LEFT JOIN dim_marketing_origin AS o ON o.origin_name = l.origin""",
    "fact_closed_deals": f"""SELECT {_key('d.mql_id')} AS closed_deal_key, d.mql_id, s.seller_key,
        {_day('d.won_ts')} AS won_date_key,
        (SELECT sales_rep_key FROM dim_sales_rep AS r WHERE r.sales_rep_id = d.sdr_id AND sales_role = 'SDR')
            AS sdr_sales_rep_key,
        (SELECT sales_rep_key FROM dim_sales_rep AS r WHERE r.sales_rep_id = d.sr_id AND sales_role = 'SR')
            AS sr_sales_rep_key,
        b.business_segment_key, t.lead_type_key, p.lead_profile_key, d.has_company, d.has_gtin, d.average_stock,
        d.business_type, d.declared_product_catalog_size, d.declared_monthly_revenue,
        s.seller_key IS NOT NULL AS is_active_seller, 1 AS deal_count FROM stg_closed_deals AS d
        LEFT JOIN dim_seller AS s USING (seller_id)
        LEFT JOIN dim_business_segment AS b USING (business_segment)
        LEFT JOIN dim_lead_type AS t USING (lead_type)
        LEFT JOIN dim_lead_profile AS p USING (lead_behaviour_profile)""",
    "fact_orders": f"""SELECT {_key('o.order_id')} AS order_key, o.order_id, c.customer_key, s.order_status_key,
        {_day('order_purchase_ts')} AS purchase_date_key, {_day('order_approved_ts')} AS approved_date_key,
        {_day('order_delivered_carrier_ts')} AS delivered_carrier_date_key,
        {_day('order_delivered_customer_ts')} AS delivered_customer_date_key,
        {_day('order_estimated_delivery_ts')} AS estimated_delivery_date_key,
        order_purchase_ts, order_approved_ts, order_delivered_carrier_ts, order_delivered_customer_ts,
        order_estimated_delivery_ts,
        {_elapsed('order_purchase_ts', 'order_approved_ts', _HOUR_US)} AS approval_delay_hours,
        {_elapsed('order_purchase_ts', 'order_delivered_carrier_ts', _DAY_US)} AS days_to_carrier,
        {_elapsed('order_purchase_ts', 'order_delivered_customer_ts', _DAY_US)} AS days_to_customer,
        {_elapsed('order_purchase_ts', 'order_estimated_delivery_ts', _DAY_US)} AS estimated_delivery_days,
        {_elapsed('order_estimated_delivery_ts', 'order_delivered_customer_ts', _DAY_US)} AS delivery_delay_days,
        CASE WHEN order_delivered_customer_ts IS NOT NULL AND order_estimated_delivery_ts IS NOT NULL
             THEN NOT (order_delivered_customer_ts > order_estimated_delivery_ts) END AS is_delivered_on_time,
        order_delivered_customer_ts IS NOT NULL AS is_delivered, 1 AS order_count
        FROM stg_orders AS o LEFT JOIN dim_customer AS c USING (customer_id)
        LEFT JOIN dim_order_status AS s ON s.order_status = {_label('o.order_status')}""",
    "fact_order_items": f"""SELECT
        {_key('i.order_id, i.order_item_id, p.product_key, s.seller_key, i.shipping_limit_ts, i.price, i.freight_value')}
            AS order_item_key,
        i.order_id, i.order_item_id, o.order_key, p.product_key, s.seller_key,
        {_day('shipping_limit_ts')} AS shipping_limit_date_key, i.shipping_limit_ts, i.price AS item_price,
        i.freight_value,
        CASE WHEN i.price IS NULL THEN 0 ELSE i.price END + CASE WHEN i.freight_value IS NULL THEN 0 ELSE i.freight_value END
            AS total_item_value,
        1 AS item_count FROM stg_order_items AS i
        LEFT JOIN fact_orders AS o ON o.order_id = i.order_id
        LEFT JOIN dim_product AS p ON p.product_id = i.product_id
        LEFT JOIN dim_seller AS s ON s.seller_id = i.seller_id""",
    "fact_payments": f"""SELECT {_key('p.order_id, p.payment_sequential')} AS payment_key, p.order_id,
        p.payment_sequential, o.order_key, t.payment_type_key, p.payment_installments, p.payment_value, 1 AS payment_count
        FROM stg_payments AS p LEFT JOIN fact_orders AS o ON o.order_id = p.order_id
        LEFT JOIN dim_payment_type AS t ON t.payment_type = {_label('p.payment_type')}""",
    "fact_reviews": f"""SELECT
        {_key('r.review_id, r.order_id, r.review_creation_ts, r.review_answer_ts, r.review_score')} AS review_key,
        r.review_id, r.order_id, o.order_key, {_day('review_creation_ts')} AS review_creation_date_key,
        {_day('review_answer_ts')} AS review_answer_date_key, r.review_score, r.review_comment_title,
        r.review_comment_message, r.review_creation_ts, r.review_answer_ts,
        {_elapsed('review_creation_ts', 'review_answer_ts', _HOUR_US)} AS review_response_time_hours,
        COALESCE(trim(review_comment_title) <> '', false) AS has_review_title,
        COALESCE(trim(review_comment_message) <> '', false) AS has_review_message,
        review_score >= 4 AS is_positive_review, review_score = 3 AS is_neutral_review,
        review_score <= 2 AS is_negative_review, 1 AS review_count
        FROM stg_reviews AS r LEFT JOIN fact_orders AS o ON o.order_id = r.order_id""",
    "sales_sums": f"""SELECT {_month('o.order_purchase_ts')}, {_label('o.order_status')} AS order_status,
        COUNT(DISTINCT o.order_id) AS order_count, COUNT(i.order_id) AS item_count,
        CAST(SUM(i.price) AS DOUBLE) AS gross_item_value, CAST(SUM(i.freight_value) AS DOUBLE) AS gross_freight_value,
        CAST(SUM(i.price + i.freight_value) AS DOUBLE) AS gross_revenue
        FROM stg_orders AS o LEFT JOIN stg_order_items AS i ON i.order_id = o.order_id GROUP BY ALL""",
    "sales_overview": """SELECT * REPLACE (COALESCE(gross_item_value, 0.0) AS gross_item_value,
        COALESCE(gross_freight_value, 0.0) AS gross_freight_value, COALESCE(gross_revenue, 0.0) AS gross_revenue)
        FROM sales_sums""",
    "sales_by_category": """SELECT CASE WHEN c.product_category_name_english <> '' THEN c.product_category_name_english
            WHEN c.product_category_name IS NOT NULL THEN c.product_category_name ELSE 'unknown' END AS product_category,
        COUNT(*) AS item_count, COUNT(DISTINCT i.order_id) AS order_count,
        COALESCE(CAST(SUM(i.price) AS DOUBLE), 0.0) AS gross_item_value,
        COALESCE(CAST(SUM(i.freight_value) AS DOUBLE), 0.0) AS gross_freight_value,
        COALESCE(CAST(SUM(i.price + i.freight_value) AS DOUBLE), 0.0) AS gross_revenue
        FROM stg_order_items AS i LEFT JOIN stg_products AS p ON p.product_id = i.product_id
        LEFT JOIN stg_product_categories AS c ON c.product_category_name = p.product_category_name GROUP BY 1""",
    "payment_sums": f"""SELECT {_month('o.order_purchase_ts')}, {_label('p.payment_type')} AS payment_type,
        p.payment_installments, COUNT(*) AS payment_count, CAST(SUM(p.payment_value) AS DOUBLE) AS total_payment_value,
        CAST(SUM(p.payment_value) AS DOUBLE) / COUNT(p.payment_value) AS avg_payment_value
        FROM stg_payments AS p LEFT JOIN stg_orders AS o ON o.order_id = p.order_id GROUP BY ALL""",
    "payment_analysis": """SELECT * REPLACE (COALESCE(total_payment_value, 0.0) AS total_payment_value)
        FROM payment_sums""",
    "customer_satisfaction": f"""SELECT {_month('review_creation_ts')}, review_score, COUNT(*) AS review_count,
        AVG(review_score) AS avg_review_score FROM stg_reviews GROUP BY ALL""",
    "delivery_performance": f"""SELECT {_month('order_purchase_ts')}, {_label('order_status')} AS order_status,
        COUNT(*) AS delivered_orders,
        CAST(SUM({_gap('order_purchase_ts', 'order_delivered_customer_ts')}) AS DOUBLE) / 1000000.0
            / COUNT(order_purchase_ts) / 86400.0 AS avg_days_purchase_to_delivery,
        CAST(SUM({_gap('order_estimated_delivery_ts', 'order_delivered_customer_ts')}) AS DOUBLE) / 1000000.0
            / COUNT(order_estimated_delivery_ts) / 86400.0 AS avg_days_vs_estimate,
        CAST(COUNT(*) FILTER (WHERE order_delivered_customer_ts <= order_estimated_delivery_ts) AS DOUBLE) / COUNT(*)
            AS on_time_rate
        FROM stg_orders WHERE order_delivered_customer_ts IS NOT NULL GROUP BY ALL""",
    "funnel_sums": f"""SELECT {_month('l.first_contact_date')}, l.origin AS marketing_origin,
        COUNT(DISTINCT l.mql_id) AS mql_count, COUNT(DISTINCT d.mql_id) AS won_deal_count,
        CAST(SUM(d.declared_monthly_revenue) AS DOUBLE) AS declared_monthly_revenue_sum,
        CAST(COUNT(DISTINCT d.mql_id) AS DOUBLE) / COUNT(DISTINCT l.mql_id) AS conversion_rate
        FROM stg_marketing_leads AS l LEFT JOIN stg_closed_deals AS d ON d.mql_id = l.mql_id GROUP BY ALL""",
    "marketing_funnel": """SELECT * REPLACE (COALESCE(declared_monthly_revenue_sum, 0.0) AS declared_monthly_revenue_sum)
        FROM funnel_sums""",
}


def with_relations(body: str) -> str:
    """Prefix a statement with exactly the relations it needs, in definition order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        for word in set(re.findall(r"\b\w+\b", todo.pop())):
            if word in RELATIONS and word not in needed:
                needed.add(word)
                todo.append(RELATIONS[word])
    parts = [f"{n} AS (\n    {RELATIONS[n]}\n)" for n in RELATIONS if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _all(relation: str, doubles: str = "", texts: str = "") -> str:
    swaps = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    swaps += [f"CAST({c} AS VARCHAR) AS {c}" for c in texts.split()]
    return f"SELECT *{' REPLACE (' + ', '.join(swaps) + ')' if swaps else ''} FROM {relation}"


def _sum_by(relation: str, key: str, sums: str) -> str:
    """Break-down by a non-NULL key; counts stay whole numbers, amounts stay DOUBLE."""
    cols = ", ".join(
        f"ROUND(SUM({c}), 2) AS {c}" if c.startswith(("gross", "total", "declared")) else f"CAST(SUM({c}) AS BIGINT) AS {c}"
        for c in sums.split()
    )
    return f"SELECT {key}, {cols} FROM {relation} WHERE {key} IS NOT NULL GROUP BY {key}"


def _periods(relation: str) -> str:
    return (
        f"(SELECT *, CASE WHEN year_number IS NOT NULL THEN "
        f"CAST(make_date(year_number, month_number, 1) AS VARCHAR) END AS period FROM {relation}) AS p"
    )


_W = "SUM(COALESCE({0}, 0) * delivered_orders) / SUM(delivered_orders)"
_TOP_ORIGINS = """(SELECT marketing_origin, CAST(SUM(mql_count) AS BIGINT) AS mql_count,
    CAST(SUM(won_deal_count) AS BIGINT) AS won_deal_count,
    ROUND(SUM(declared_monthly_revenue_sum), 2) AS declared_monthly_revenue_sum,
    CAST(SUM(won_deal_count) AS DOUBLE) / nullif(SUM(mql_count), 0) AS conversion_rate
    FROM marketing_funnel WHERE marketing_origin IS NOT NULL GROUP BY 1
    ORDER BY mql_count DESC, marketing_origin LIMIT 15) AS t"""


def _spaced(number: str) -> str:
    return f"replace({number}, ',', ' ')"


def _check(name: str, value: str, wants_rows: bool) -> str:
    missing = "0 reviews outside 1..5" if name.endswith("1_5") else f"0 missing {name.split('_missing_')[-1]}"
    return (
        f"SELECT '{name}' AS check_name, CAST(v AS VARCHAR) AS value, v {'> 0' if wants_rows else '= 0'} AS passed, "
        f"'{'> 0 rows' if wants_rows else missing}' AS expectation FROM (SELECT {value}) AS c(v)"
    )


def _where(table: str, condition: str) -> str:
    return f"(SELECT COUNT(*) FROM {table} WHERE {condition})"


_CHECKS = [
    _check("raw_orders_loaded", _where("raw_orders", "true"), True),
    _check("dwh_fact_orders_loaded", _where("fact_orders", "true"), True),
    *[
        _check(f"{t}_missing_{k}", _where(t, f"{k} IS NULL"), False)
        for t, k in [
            ("fact_order_items", "order_key"),
            ("fact_order_items", "product_key"),
            ("fact_order_items", "seller_key"),
            ("fact_payments", "order_key"),
            ("fact_reviews", "order_key"),
        ]
    ],
    _check("reviews_outside_1_5", _where("fact_reviews", "review_score < 1 OR review_score > 5"), False),
    *[
        _check(f"marts_{m}_loaded", _where(m, "true"), True)
        for m in ["sales_overview", "payment_analysis", "customer_satisfaction", "sales_by_category"]
    ],
]
_REPORT = " UNION ALL ".join(_CHECKS)


def _rule(table: str, rule: str, count: str) -> str:
    quoted = rule.replace("'", "''")
    return f"SELECT '{table}' AS table_name, '{quoted}' AS rule, CAST(({count}) AS BIGINT) AS violations"


def _duplicates(keys: dict[str, list[str]], prefix: str = "") -> str:
    return " UNION ALL ".join(
        _rule(
            t,
            f"unique ({', '.join(cols)})",
            f"SELECT COUNT(*) FROM (SELECT 1 FROM {prefix}{t} WHERE "
            + " AND ".join(f"{c} IS NOT NULL" for c in cols)
            + f" GROUP BY {', '.join(cols)} HAVING COUNT(*) > 1) AS d",
        )
        for t, cols in keys.items()
    )


def _nulls(mandatory: dict[str, list[str]], prefix: str = "") -> str:
    return " UNION ALL ".join(
        _rule(t, f"{c} not null", f"SELECT COUNT(*) - COUNT({c}) FROM {prefix}{t}") for t, cols in mandatory.items() for c in cols
    )


def _broken(rules: dict[str, list[str]], prefix: str = "") -> str:
    return " UNION ALL ".join(
        _rule(t, p, f"SELECT COUNT(*) FROM {prefix}{t} WHERE NOT ({p})") for t, ps in rules.items() for p in ps
    )


def _orphans(planted: bool = False) -> str:
    """With `planted`, every target has lost the keys with rest 3 of 7."""
    return " UNION ALL ".join(
        _rule(
            t,
            f"{c} -> {target}",
            f"SELECT COUNT(*) FROM {t} AS f WHERE f.{c} IS NOT NULL AND f.{c} NOT IN (SELECT {k} FROM {target}"
            f"{f' WHERE {k} % 7 <> 3' if planted else ''})",
        )
        for t, cols in con.REFERENCES.items()
        for c, (target, k) in cols.items()
    )


# Columns of the raw and staging tables, texts first.
_RAW_COLUMNS = {
    "customers": ("customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state", ""),
    "geolocation": ("geolocation_zip_code_prefix geolocation_city geolocation_state", "geolocation_lat geolocation_lng"),
    "marketing_qualified_leads": ("mql_id landing_page_id origin", "first_contact_date"),
    "closed_deals": (
        "mql_id seller_id sdr_id sr_id business_segment lead_type lead_behaviour_profile has_company has_gtin average_stock business_type",
        "won_date declared_product_catalog_size declared_monthly_revenue",
    ),
    "orders": (
        "order_id customer_id order_status",
        "order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    ),
    "order_items": ("order_id product_id seller_id", "order_item_id shipping_limit_date price freight_value"),
    "order_payments": ("order_id payment_type", "payment_sequential payment_installments payment_value"),
    "order_reviews": ("review_id order_id review_comment_title review_comment_message", "review_score review_creation_date review_answer_timestamp"),
    "products": (
        "product_id product_category_name",
        "product_name_lenght product_description_lenght product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    ),
    "sellers": ("seller_id seller_zip_code_prefix seller_city seller_state", ""),
    "product_category_name_translation": ("product_category_name product_category_name_english", ""),
}
_STAGING_COLUMNS = {
    "stg_customers": ("customer_id customer_unique_id zip_prefix city_name state_code", ""),
    "stg_sellers": ("seller_id zip_prefix city_name state_code", ""),
    "stg_geolocation": ("zip_prefix city_name state_code", "latitude longitude"),
    "stg_product_categories": ("product_category_name product_category_name_english", ""),
    "stg_products": (
        "product_id product_category_name",
        "product_name_length product_description_length product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    ),
    "stg_orders": (
        "order_id customer_id order_status",
        "order_purchase_ts order_approved_ts order_delivered_carrier_ts order_delivered_customer_ts order_estimated_delivery_ts",
    ),
    "stg_order_items": ("order_id product_id seller_id", "order_item_id shipping_limit_ts price freight_value"),
    "stg_payments": ("order_id payment_type", "payment_sequential payment_installments payment_value"),
    "stg_reviews": ("review_id order_id review_comment_title review_comment_message", "review_score review_creation_ts review_answer_ts"),
    "stg_marketing_leads": ("mql_id landing_page_id origin", "first_contact_date"),
    "stg_closed_deals": (
        "mql_id seller_id sdr_id sr_id business_segment lead_type lead_behaviour_profile average_stock business_type",
        "won_ts has_company has_gtin declared_product_catalog_size declared_monthly_revenue",
    ),
}


def _digests(tables: dict[str, tuple[str, tuple[str, str]]]) -> str:
    def one(relation: str, name: str, texts: str, others: str) -> str:
        filled = " + ".join(f"COUNT({c})" for c in [*texts.split(), *others.split()])
        chars = " + ".join(f"COALESCE(SUM(length({c})), 0)" for c in texts.split())
        return f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows, {filled} AS n_filled, CAST({chars} AS BIGINT) AS n_chars FROM {relation}"

    return " UNION ALL ".join(one(r, name, *columns) for r, (name, columns) in tables.items())


_SIZES = "product_weight_g product_length_cm product_height_cm product_width_cm"
_DEAL = "declared_product_catalog_size declared_monthly_revenue"

BODIES: dict[str, str] = {
    "s2_csv_scan": _all("raw_order_reviews"),
    "s5_layer_roundtrip": _all("stg_closed_deals", _DEAL),
    "s6_published_mart": _all("customer_satisfaction"),
    "s7_sql_read": """SELECT order_status, CAST(SUM(order_count) AS BIGINT) AS order_count FROM sales_overview
        WHERE year_number IN (1996, 1998) AND order_count >= 10 GROUP BY order_status""",
    "s4_load_all": _digests({f"raw_{t}": (t, cols) for t, cols in _RAW_COLUMNS.items()}),
    "s5_staging_layer": _digests({t: (t, cols) for t, cols in _STAGING_COLUMNS.items()}),
    "s6_published_marts": " UNION ALL ".join(
        f"SELECT '{m}' AS mart, COUNT(*) AS n_rows, CAST(SUM({c}) AS BIGINT) AS total FROM {m}"
        for m, c in [
            ("sales_overview", "order_count"), ("sales_by_category", "item_count"), ("payment_analysis", "payment_count"),
            ("customer_satisfaction", "review_count"), ("delivery_performance", "delivered_orders"), ("marketing_funnel", "mql_count"),
        ]
    ),
    "s6_catalog_marts": " UNION ALL ".join(
        f"SELECT '{m}' AS mart, COUNT(*) AS n_rows, CAST(SUM({c}) AS BIGINT) AS total FROM {m}"
        for m, c in [
            ("sales_overview", "order_count"), ("sales_by_category", "item_count"), ("payment_analysis", "payment_count"),
            ("customer_satisfaction", "review_count"), ("delivery_performance", "delivered_orders"), ("marketing_funnel", "mql_count"),
        ]
    ),
    "s8_scalar": """SELECT year_number, month_number, order_count FROM sales_overview WHERE order_status = 'delivered'
        AND order_count = (SELECT MAX(order_count) FROM sales_overview WHERE order_status = 'delivered')""",
    "s9_missing_mart": """SELECT 'sales_overview' AS mart, year_number, CAST(SUM(order_count) AS BIGINT) AS order_count
        FROM sales_overview GROUP BY year_number""",
    "d20_broken_keys": """SELECT CASE WHEN order_id = 'hot' THEN 'hot' ELSE 'others' END AS kind, COUNT(*) AS n_rows,
        COUNT(DISTINCT k) AS n_keys, MIN(k) AS low, MAX(k) AS high FROM (
            SELECT order_id, ROW_NUMBER() OVER (ORDER BY order_id, payment_sequential) AS k FROM (
                SELECT CASE WHEN hot THEN 'hot' ELSE order_id END AS order_id,
                    CASE WHEN hot THEN 1 ELSE payment_sequential END AS payment_sequential
                FROM (SELECT *, COALESCE(payment_installments, 1) % 3 = 0 AS hot FROM stg_payments) AS p) AS b) AS n GROUP BY 1""",
    "c1_zip": "SELECT customer_id, lpad(trim(customer_zip_code_prefix), 5, '0') AS zip FROM raw_customers",
    "c2_lower": "SELECT order_id, trim(lower(order_status)) AS status FROM raw_orders",
    "c3_upper": "SELECT seller_id, trim(upper(seller_state)) AS state FROM raw_sellers",
    "c4_unknown": f"SELECT product_id, {_unknown('trim(product_category_name)')} AS category FROM raw_products",
    "c5_unknown_lower": f"SELECT mql_id, {_unknown('trim(lower(origin))')} AS origin FROM raw_marketing_qualified_leads",
    "c6_null": "SELECT mql_id, CASE WHEN trim(seller_id) <> '' THEN trim(seller_id) END AS seller FROM raw_closed_deals",
    "c7_bool": f"SELECT mql_id, {_bool('has_company')} AS company, {_bool('has_gtin')} AS gtin FROM raw_closed_deals",
    "t1_customers": _all("stg_customers"),
    "t2_sellers": _all("stg_sellers"),
    "t3_geo_clean": _all("geo_points", "latitude longitude"),
    "t4_centroid": _all("geo_centroid"),
    "t5_modal_city": _all("geo_modal"),
    "t6_geolocation": _all("stg_geolocation"),
    "t7_category_universe": _all("category_universe"),
    "t8_categories": _all("stg_product_categories"),
    "t9_products": _all("stg_products", _SIZES),
    "t10_orders": _all("stg_orders"),
    "t11_items": _all("stg_order_items", "price freight_value"),
    "t12_payments": _all("stg_payments", "payment_value"),
    "t13_reviews": _all("stg_reviews"),
    "t14_leads": _all("stg_marketing_leads", texts="first_contact_date"),
    "t15_deals": _all("stg_closed_deals", _DEAL),
    "d1_dates": _all("date_bounds", texts="min_date max_date"),
    "d4_date": _all("dim_date", texts="full_date"),
    "d5_state": _all("dim_state"),
    "d6_city": _all("dim_city"),
    "d7_zip": _all("dim_zip_prefix", "latitude longitude"),
    "d8_customer": _all("dim_customer"),
    "d9_seller": _all("dim_seller"),
    "d10_category": _all("dim_product_category"),
    "d11_product": _all("dim_product", _SIZES),
    "d12_status": _all("dim_order_status"),
    "d13_payment_type": _all("dim_payment_type"),
    "d14_origin": _all("dim_marketing_origin"),
    "d15_landing_page": _all("dim_landing_page"),
    "d16_segment": _all("dim_business_segment"),
    "d17_lead_type": _all("dim_lead_type"),
    "d18_lead_profile": _all("dim_lead_profile"),
    "d19_sales_rep": _all("dim_sales_rep"),
    "d20_keys": f"SELECT order_id, {_key('order_id')} AS order_key FROM stg_orders",
    "f1_leads": _all("fact_marketing_leads"),
    "f2_deals": _all("fact_closed_deals", _DEAL),
    "f3_orders": _all("fact_orders"),
    "f4_items": _all("fact_order_items", "item_price freight_value total_item_value"),
    "f5_payments": _all("fact_payments", "payment_value"),
    "f6_reviews": _all("fact_reviews"),
    "m1_sales_overview": _all("sales_overview"),
    "m2_sales_by_category": _all("sales_by_category"),
    "m3_payment_analysis": _all("payment_analysis"),
    "m4_customer_satisfaction": _all("customer_satisfaction"),
    "m5_delivery_performance": _all("delivery_performance"),
    "m6_marketing_funnel": _all("marketing_funnel"),
    "m7_legacy_sales": _all("sales_sums"),
    "m7_legacy_payments": _all("payment_sums"),
    "m7_legacy_delivery": "SELECT * EXCLUDE (on_time_rate) FROM delivery_performance",
    "m7_legacy_funnel": "SELECT * EXCLUDE (conversion_rate) FROM funnel_sums",
    "q_report": f"SELECT check_name, value, passed FROM ({_REPORT}) AS r",
    "q18_expectations": _REPORT,
    "q19_first_unmet": f"""SELECT CAST(position AS INTEGER) AS position, check_name, value, passed FROM (
            SELECT *, COALESCE(SUM(CASE WHEN passed THEN 0 ELSE 1 END) OVER (ORDER BY position
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unmet_before
            FROM ({" UNION ALL ".join(f"SELECT {i} AS position, * FROM ({c}) AS c" for i, c in enumerate(_CHECKS, 1))}) AS r) AS s
        WHERE unmet_before = 0""",
    "q16_planted": _orphans(True),
    "q13_duplicates": _duplicates(con.UNIQUE_KEYS["dwh"]),
    "q13_own_keys": _duplicates(con.OWN_KEYS),
    "q13_raw_duplicates": _duplicates(con.UNIQUE_KEYS["raw"], "raw_"),
    "q13_staging_duplicates": _duplicates(con.UNIQUE_KEYS["staging"]),
    "q13_gate": f"""SELECT * FROM ({_duplicates(con.UNIQUE_KEYS["raw"], "raw_")}
        UNION ALL {_duplicates(con.UNIQUE_KEYS["staging"])}
        UNION ALL {_nulls(con.UNIQUE_KEYS["raw"], "raw_")} UNION ALL {_nulls(con.NOT_NULL["staging"])}
        UNION ALL {_broken(con.VALUE_RULES["raw"], "raw_")} UNION ALL {_broken(con.VALUE_RULES["staging"])}) AS g
        WHERE violations > 0""",
    "q14_nulls": _nulls(con.NOT_NULL["staging"] | con.NOT_NULL["dwh"]),
    "q15_checks": _broken(con.VALUE_RULES["staging"] | con.VALUE_RULES["dwh"]),
    "q15_raw_checks": _broken(con.VALUE_RULES["raw"], "raw_"),
    "q16_orphans": _orphans(),
    "q20_summary": f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE passed) AS passed,
        COUNT(*) FILTER (WHERE NOT passed) AS failed FROM ({_REPORT}) AS r""",
    "b1_years": "SELECT DISTINCT year_number FROM sales_overview WHERE year_number IS NOT NULL",
    "b2_filtered_sales": "SELECT * FROM sales_overview WHERE year_number = 1996 OR year_number = 1997",
    "b2_filtered_payments": "SELECT * FROM payment_analysis WHERE year_number = 1996 OR year_number = 1997",
    "b3_periods": f"SELECT period, order_status, order_count FROM {_periods('sales_overview')}",
    "b4_sales_kpis": """SELECT ROUND(SUM(gross_revenue), 2) AS total_revenue, CAST(SUM(order_count) AS BIGINT) AS total_orders,
        CAST(SUM(item_count) AS BIGINT) AS total_items,
        ROUND(SUM(gross_revenue) / SUM(order_count), 6) AS avg_order_value FROM sales_overview""",
    "b5_monthly_sales": _sum_by(_periods("sales_overview"), "period", "gross_revenue order_count item_count"),
    "b6_status_share": """SELECT order_status, CAST(SUM(order_count) AS BIGINT) AS order_count,
        CAST(SUM(order_count) AS DOUBLE)
            / (SELECT SUM(order_count) FROM sales_overview WHERE order_status IS NOT NULL) AS share
        FROM sales_overview WHERE order_status IS NOT NULL GROUP BY order_status""",
    "b7_top_categories": """SELECT product_category, item_count, order_count, gross_revenue FROM sales_by_category
        ORDER BY gross_revenue DESC, product_category LIMIT 15""",
    "b8_payment_kpis": """SELECT ROUND(SUM(total_payment_value), 2) AS total_value,
        CAST(SUM(payment_count) AS BIGINT) AS total_count,
        ROUND(SUM(total_payment_value) / SUM(payment_count), 6) AS avg_payment,
        ROUND(CAST(SUM(COALESCE(payment_installments, 0) * payment_count) AS DOUBLE) / SUM(payment_count), 6)
            AS avg_installments FROM payment_analysis""",
    "b9_payments_by_type": _sum_by("payment_analysis", "payment_type", "total_payment_value payment_count"),
    "b10_installments": _sum_by("payment_analysis", "payment_installments", "payment_count"),
    "b11_satisfaction_kpis": """SELECT CAST(SUM(review_count) AS BIGINT) AS total_reviews,
        CAST(SUM(review_score * review_count) AS DOUBLE) / SUM(review_count) AS weighted_score,
        CAST(SUM(review_count) FILTER (WHERE review_score IN (4, 5)) AS DOUBLE) / SUM(review_count) AS positive_share,
        CAST(SUM(review_count) FILTER (WHERE review_score IN (1, 2)) AS DOUBLE) / SUM(review_count) AS negative_share
        FROM customer_satisfaction""",
    "b12_monthly_score": f"""SELECT period,
        CAST(SUM(review_score * review_count) AS DOUBLE) / SUM(review_count) AS avg_score,
        CAST(SUM(review_count) AS BIGINT) AS review_count
        FROM {_periods('customer_satisfaction')} WHERE period IS NOT NULL GROUP BY period""",
    "b13_score_distribution": _sum_by("customer_satisfaction", "review_score", "review_count"),
    "b14_delivery_kpis": f"""SELECT CAST(SUM(delivered_orders) AS BIGINT) AS total_delivered,
        ROUND({_W.format('avg_days_purchase_to_delivery')}, 6) AS avg_delivery_days,
        ROUND({_W.format('avg_days_vs_estimate')}, 6) AS avg_days_vs_estimate,
        ROUND({_W.format('on_time_rate')}, 6) AS on_time_rate FROM delivery_performance""",
    "b15_monthly_delivery": f"""SELECT period,
        ROUND({_W.format('avg_days_purchase_to_delivery')}, 6) AS avg_days_purchase_to_delivery,
        ROUND({_W.format('on_time_rate')}, 6) AS on_time_rate
        FROM {_periods('delivery_performance')} WHERE period IS NOT NULL GROUP BY period""",
    "b16_on_time_by_status": f"""SELECT order_status, ROUND({_W.format('on_time_rate')}, 6) AS on_time_rate
        FROM delivery_performance WHERE order_status IS NOT NULL GROUP BY order_status""",
    "b17_funnel_kpis": """SELECT CAST(SUM(mql_count) AS BIGINT) AS total_leads, CAST(SUM(won_deal_count) AS BIGINT) AS total_deals,
        ROUND(SUM(declared_monthly_revenue_sum), 2) AS revenue,
        CAST(SUM(won_deal_count) AS DOUBLE) / SUM(mql_count) AS conversion FROM marketing_funnel""",
    "b18_funnel_by_origin": f"SELECT * FROM {_TOP_ORIGINS}",
    "b19_conversion_rank": f"""SELECT ROW_NUMBER() OVER (ORDER BY conversion_rate DESC NULLS LAST, marketing_origin) AS rank,
        marketing_origin, conversion_rate FROM {_TOP_ORIGINS}""",
    "b20_sales_detail": """SELECT year_number, month_number, month_name, order_status, order_count, item_count,
        gross_revenue FROM sales_overview WHERE year_number IN (1996, 1997)""",
    "b20_payment_detail": """SELECT year_number, month_number, month_name, payment_type, payment_installments,
        payment_count, total_payment_value FROM payment_analysis""",
    "b20_satisfaction_detail": """SELECT year_number, month_number, month_name, review_score, review_count
        FROM customer_satisfaction WHERE year_number IN (2024)""",
    "b20_delivery_detail": """SELECT year_number, month_number, month_name, order_status, delivered_orders,
        avg_days_purchase_to_delivery, avg_days_vs_estimate, on_time_rate FROM delivery_performance""",
    "b20_marketing_detail": """SELECT year_number, month_number, month_name, marketing_origin, mql_count, won_deal_count,
        declared_monthly_revenue_sum, conversion_rate FROM marketing_funnel""",
    "b21_formatted": f"""SELECT marketing_origin, mql_count, won_deal_count,
        concat(format('{{:.1f}}', COALESCE(conversion_rate, 0.0) * 100), ' %') AS conversion_rate,
        concat('R$ ', {_spaced("format('{:,.0f}', COALESCE(declared_monthly_revenue_sum, 0.0))")})
            AS declared_monthly_revenue_sum FROM {_TOP_ORIGINS}""",
    "b21_sales_cards": f"""SELECT concat('R$ ', {_spaced("format('{:,.0f}', SUM(gross_revenue))")}) AS revenue,
        {_spaced("format('{:,}', CAST(SUM(order_count) AS BIGINT))")} AS orders,
        {_spaced("format('{:,}', CAST(SUM(item_count) AS BIGINT))")} AS items,
        concat('R$ ', {_spaced("format('{:,.0f}', SUM(gross_revenue) / SUM(order_count))")}) AS basket
        FROM sales_overview""",
    "b21_payment_cards": f"""SELECT concat('R$ ', {_spaced("format('{:,.0f}', SUM(total_payment_value))")}) AS value,
        {_spaced("format('{:,}', CAST(SUM(payment_count) AS BIGINT))")} AS payments,
        concat('R$ ', {_spaced("format('{:,.0f}', SUM(total_payment_value) / SUM(payment_count))")}) AS mean_payment,
        format('{{:.2f}}', CAST(SUM(COALESCE(payment_installments, 0) * payment_count) AS DOUBLE) / SUM(payment_count))
            AS mean_installments FROM payment_analysis""",
    "b21_satisfaction_cards": f"""SELECT {_spaced("format('{:,}', CAST(SUM(review_count) AS BIGINT))")} AS reviews,
        concat(format('{{:.2f}}', CAST(SUM(review_score * review_count) AS DOUBLE) / SUM(review_count)), ' / 5') AS mean_score,
        concat(format('{{:.1f}}', 100 * CAST(SUM(review_count) FILTER (WHERE review_score IN (4, 5)) AS DOUBLE) / SUM(review_count)), ' %') AS good,
        concat(format('{{:.1f}}', 100 * CAST(SUM(review_count) FILTER (WHERE review_score IN (1, 2)) AS DOUBLE) / SUM(review_count)), ' %') AS bad
        FROM customer_satisfaction""",
    "b21_delivery_cards": f"""SELECT {_spaced("format('{:,}', CAST(SUM(delivered_orders) AS BIGINT))")} AS delivered,
        concat(format('{{:.1f}}', {_W.format('avg_days_purchase_to_delivery')}), ' jours') AS mean_delay,
        concat(format('{{:.1f}}', {_W.format('avg_days_vs_estimate')}), ' jours') AS against_estimate,
        concat(format('{{:.1f}}', 100 * {_W.format('on_time_rate')}), ' %') AS on_time FROM delivery_performance""",
    "b21_marketing_cards": f"""SELECT {_spaced("format('{:,}', CAST(SUM(mql_count) AS BIGINT))")} AS leads,
        {_spaced("format('{:,}', CAST(SUM(won_deal_count) AS BIGINT))")} AS deals,
        concat(format('{{:.1f}}', 100 * CAST(SUM(won_deal_count) AS DOUBLE) / SUM(mql_count)), ' %') AS conversion,
        concat('R$ ', {_spaced("format('{:,.0f}', SUM(declared_monthly_revenue_sum))")}) AS revenue FROM marketing_funnel""",
}

_SELECTED = {
    "sales_overview": "(1996, 1997)", "payment_analysis": "(1996, 1997)", "delivery_performance": "(1996, 1997)",
    "customer_satisfaction": "(2024)", "marketing_funnel": "(2024)",
}
RELATIONS |= {f"{m}_in_years": f"SELECT * FROM {m} WHERE year_number IN {years}" for m, years in _SELECTED.items()}
_FOLLOWING = """b4_sales_kpis b5_monthly_sales b6_status_share b8_payment_kpis b9_payments_by_type b10_installments
    b11_satisfaction_kpis b12_monthly_score b13_score_distribution b14_delivery_kpis b15_monthly_delivery
    b16_on_time_by_status b17_funnel_kpis b18_funnel_by_origin b19_conversion_rank b21_formatted b21_sales_cards
    b21_payment_cards b21_satisfaction_cards b21_delivery_cards b21_marketing_cards""".split()
BODIES |= {f"{q}_in_years": re.sub(rf"\b({'|'.join(_SELECTED)})\b", r"\1_in_years", BODIES[q]) for q in _FOLLOWING}


def oracle_sql() -> dict[str, str]:
    return {name: with_relations(body) for name, body in BODIES.items()}
