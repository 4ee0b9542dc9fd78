from decimal import Decimal

from marketloom.operators import staging

GEO = """geolocation_zip_code_prefix string, geolocation_lat decimal(10,7), geolocation_lng decimal(10,7),
    geolocation_city string, geolocation_state string"""


def d(x):
    return None if x is None else Decimal(x)


def test_modal_place_breaks_ties_by_city_with_missing_last(rows):
    raw = rows(GEO, *[("1", None, None, c, "SP") for c in ["b", "b", "a", "a", None, None]],
               ("2", None, None, None, "RJ"), ("2", None, None, None, "RJ"), ("2", None, None, "z", "RJ"),
               ("3", None, None, "c", None), ("3", None, None, "c", "AC"), (None, None, None, "q", "AC"))
    got = {r.zip_prefix: (r.city_name, r.state_code) for r in staging.modal_places(staging.geolocation_points(raw)).collect()}
    assert got == {"00001": ("a", "SP"), "00002": (None, "RJ"), "00003": ("c", "AC")}


def test_centroid_skips_nulls_and_rounds_to_seven_places(rows):
    raw = rows(GEO, ("1", d("1.0000000"), None, "a", "SP"), ("1", d("1.0000001"), None, "b", "SP"),
               ("1", None, None, "b", "SP"), ("2", d("-2.5"), d("4"), "a", "SP"))
    points = staging.geolocation_points(raw)
    got = {r.zip_prefix: (r.latitude, r.longitude) for r in staging.zip_centroids(points).collect()}
    assert got == {"00001": (d("1.0000001"), None), "00002": (d("-2.5000000"), d("4.0000000"))}
    both = {r.zip_prefix: tuple(r)[1:] for r in staging.geolocation(points).collect()}
    assert both["00001"] == (d("1.0000001"), None, "b", "SP")


def test_categories_fall_back_only_when_the_translation_is_missing(rows):
    products = rows("product_category_name string", (" toys ",), ("",), (None,), ("pet",), ("big",))
    translation = rows(
        "product_category_name string, product_category_name_english string",
        ("toys", "Toys!"), ("pet", ""), (" big ", "Large"), ("garden", None),
    )
    got = {r[0]: r[1] for r in staging.product_categories(products, translation).collect()}
    assert got == {"toys": "Toys!", "unknown": "unknown", "pet": "", "big": "big", "garden": "garden"}


def test_geolocation_reads_its_source_once(rows):
    plan = staging.geolocation(staging.geolocation_points(rows(GEO, ("1", d("1"), d("2"), "a", "SP"))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") == 1 and "Window" not in text and "Join" not in text


def test_products_get_correct_spelling_and_deals_get_booleans(warehouse):
    assert "product_name_length" in warehouse.stg_products.columns
    assert not [c for c in warehouse.stg_products.columns if "lenght" in c]
    types = dict(warehouse.stg_closed_deals.dtypes)
    assert types["has_company"] == types["has_gtin"] == "boolean"
    assert types["won_ts"] == "timestamp_ntz"
