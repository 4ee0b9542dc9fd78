import datetime as dt
from decimal import Decimal

from marketloom.operators import facts

T = dt.datetime(2018, 1, 1)


def closed_deals(*tables):
    return facts.measure_closed_deals(facts.resolve_closed_deals(*tables))


def orders(*tables):
    return facts.measure_orders(facts.resolve_orders(*tables))


def order_items(*tables):
    return facts.measure_order_items(facts.resolve_order_items(*tables))


def reviews(*tables):
    return facts.measure_reviews(facts.resolve_reviews(*tables))


ORDERS = """order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz,
    order_approved_ts timestamp_ntz, order_delivered_carrier_ts timestamp_ntz,
    order_delivered_customer_ts timestamp_ntz, order_estimated_delivery_ts timestamp_ntz"""


def days(n, **more):
    return T + dt.timedelta(days=n, **more)


def build_orders(rows):
    stg = rows(
        ORDERS,
        ("equal", "c1", "delivered", T, None, None, days(5), days(5)),
        ("late", "c1", None, T, None, None, days(6), days(5)),
        ("early", "gone", "", T, None, None, days(4), days(5, hours=12)),
        ("no promise", None, "new", T, None, None, days(4), None),
        ("open", "c1", "delivered", None, None, None, None, days(5)),
    )
    customers = rows("customer_key bigint, customer_id string", (11, "c1"))
    statuses = rows("order_status_key bigint, order_status string", (1, "delivered"), (2, "unknown"))
    return {r.order_id: r for r in orders(stg, customers, statuses).collect()}


def test_order_flags(rows):
    got = build_orders(rows)
    assert {k: r.is_delivered_on_time for k, r in got.items()} == {
        "equal": True, "late": False, "early": True, "no promise": None, "open": None
    }
    assert {k for k, r in got.items() if r.is_delivered} == {"equal", "late", "early", "no promise"}


def test_order_keys_keep_the_blank_status_unresolved(rows):
    got = build_orders(rows)
    assert {k: r.order_status_key for k, r in got.items()} == {
        "equal": 1, "late": 2, "early": None, "no promise": None, "open": 1
    }
    assert (got["early"].customer_key, got["equal"].customer_key, got["no promise"].customer_key) == (None, 11, None)
    assert (got["equal"].purchase_date_key, got["open"].purchase_date_key) == (20180101, None)


def test_order_durations(rows):
    got = build_orders(rows)
    assert got["early"].delivery_delay_days == Decimal("-1.50")
    assert got["late"].days_to_customer == Decimal("6.00")
    assert got["no promise"].estimated_delivery_days is None


def test_items_total_and_unresolved_keys(rows):
    stg = rows(
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_ts timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)",
        ("o", 1, "p", "s", T, Decimal(10), None),
        ("x", 1, None, "s", None, None, None),
    )
    got = {r.order_id: r for r in order_items(
        stg, rows("order_key bigint, order_id string, purchase_date_key int, order_status_key bigint", (1, "o", 20180101, 5)), rows("product_key bigint, product_id string", (2, "p")),
        rows("seller_key bigint, seller_id string", (3, "s"))).collect()}
    assert (got["o"].total_item_value, got["o"].order_key, got["o"].product_key) == (Decimal(10), 1, 2)
    assert (got["x"].total_item_value, got["x"].order_key, got["x"].product_key, got["x"].seller_key) == (0, None, None, 3)
    hidden = facts.HIDDEN_COLUMNS["fact_order_items"]
    assert [got["o"][c] for c in hidden] == [20180101, 5, 2018] and [got["x"][c] for c in hidden] == [None] * 3


def test_review_flags(rows):
    stg = rows(
        "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, review_creation_ts timestamp_ntz, review_answer_ts timestamp_ntz",
        *[(str(i), "o", i, " " if i == 1 else "t", None if i == 2 else "m", T, days(0, minutes=i * 20)) for i in range(1, 6)],
    )
    got = [tuple(r) for r in reviews(stg, rows("order_key bigint, order_id string", (1, "o"))).orderBy("review_score")
           .select("is_positive_review", "is_neutral_review", "is_negative_review", "has_review_title", "has_review_message", "review_response_time_hours").collect()]
    assert [g[:3] for g in got] == [(False, False, True)] * 2 + [(False, True, False)] + [(True, False, False)] * 2
    assert [g[3] for g in got] == [False, True, True, True, True]
    assert [g[4] for g in got] == [True, False, True, True, True]
    assert [str(g[5]) for g in got] == ["0.33", "0.67", "1.00", "1.33", "1.67"]


def test_deal_roles_use_their_own_rep_rows(rows):
    stg = rows(
        "mql_id string, seller_id string, sdr_id string, sr_id string, won_ts timestamp_ntz, business_segment string, lead_type string, lead_behaviour_profile string, has_company boolean, has_gtin boolean, average_stock string, business_type string, declared_product_catalog_size decimal(14,2), declared_monthly_revenue decimal(14,2)",
        ("m1", "s", "7", "7", T, "a", "b", "c", None, None, None, "t", None, None),
        ("m2", None, "8", None, T, "a", "b", "zz", None, None, None, "t", None, None),
    )
    got = {r.mql_id: r for r in closed_deals(
        stg, rows("seller_key bigint, seller_id string", (1, "s")),
        rows("sales_rep_key bigint, sales_rep_id string, sales_role string", (1, "7", "SDR"), (2, "7", "SR"), (3, "8", "SR")),
        rows("business_segment_key bigint, business_segment string", (1, "a")),
        rows("lead_type_key bigint, lead_type string", (1, "b")),
        rows("lead_profile_key bigint, lead_behaviour_profile string", (1, "c"))).collect()}
    assert (got["m1"].sdr_sales_rep_key, got["m1"].sr_sales_rep_key, got["m1"].is_active_seller) == (1, 2, True)
    assert (got["m2"].sdr_sales_rep_key, got["m2"].sr_sales_rep_key, got["m2"].is_active_seller) == (None, None, False)
    assert got["m2"].lead_profile_key is None
