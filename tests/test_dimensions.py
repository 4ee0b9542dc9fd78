import datetime as dt
from decimal import Decimal

from marketloom.operators import dimensions as dim

PLACE = "zip_prefix string, city_name string, state_code string"


def test_calendar_attributes_and_gaps(rows):
    bounds = rows("min_date date, max_date date", (dt.date(2015, 12, 30), dt.date(2016, 3, 1)))
    days = {r.full_date: r for r in dim.calendar(bounds).collect()}
    assert sorted(days) == [dt.date(2015, 12, 30) + dt.timedelta(i) for i in range(63)]
    new_year = days[dt.date(2016, 1, 1)]
    assert tuple(new_year) == (20160101, dt.date(2016, 1, 1), 1, 5, "Friday", 53, 1, "January", 1, 2016, False)
    for day, r in days.items():
        assert (r.day_of_week, r.week_of_year) == (day.isoweekday(), day.isocalendar()[1])
        assert (r.day_name, r.month_name) == (day.strftime("%A"), day.strftime("%B"))
        assert r.is_weekend == (day.isoweekday() >= 6)


def test_no_dates_no_calendar(rows):
    assert dim.calendar(rows("min_date date, max_date date", (None, None))).count() == 0


def test_zip_comes_from_the_most_trusted_source(rows):
    geo = rows(PLACE + ", latitude decimal(10,7), longitude decimal(10,7)", ("00001", "z", None, Decimal(1), Decimal(2)))
    customers = rows(PLACE, ("00001", "a", "SP"), ("00002", "b", "SP"), ("00002", "a", "SP"), ("00002", None, "AC"),
                     (None, "x", "RJ"), ("00004", None, None))
    sellers = rows(PLACE, ("00002", "A0", "SP"), ("00003", "q", "XX"), ("00004", "s", "SP"))
    places = dim.place_candidates(geo, customers, sellers)
    states = rows("state_key bigint, state_code string", (1, "AC"), (2, "SP"), (3, "XX"))
    cities = rows("city_key bigint, city_name string, state_key bigint", (1, "a", 2), (2, "q", 3), (3, "z", 2))
    got = {r.zip_prefix: tuple(r)[1:] for r in dim.zip_prefixes(places, states, cities).collect()}
    assert got == {
        "00001": (None, None, Decimal(1), Decimal(2)),
        "00002": (1, 2, None, None),
        "00003": (2, 3, None, None),
        "00004": (None, None, None, None),
    }


def test_states_and_cities(rows):
    geo = rows(PLACE + ", latitude decimal(10,7), longitude decimal(10,7)", ("1", "a", "SP", None, None))
    places = dim.place_candidates(geo, rows(PLACE, ("2", "a", "RJ"), ("2", "", "RJ"), ("3", "b", "")), rows(PLACE, ("4", "c", "XX"), ("4", "c", None)))
    assert {tuple(r) for r in dim.states(places).collect()} == {("SP", "São Paulo"), ("RJ", "Rio de Janeiro"), ("XX", None)}
    states = rows("state_key bigint, state_code string", (1, "RJ"), (2, "SP"), (3, "XX"))
    assert {tuple(r) for r in dim.cities(places, states).collect()} == {("a", 2), ("a", 1), ("c", 3)}
    assert len(dim.STATE_NAMES) == 27


def test_customer_place_is_its_own_not_that_of_its_zip(rows):
    stg = rows("customer_id string, customer_unique_id string, " + PLACE, ("c1", "u1", "00001", "b", "RJ"), ("c2", "u2", None, "b", "SP"))
    zips = rows("zip_prefix_key bigint, zip_prefix string", (7, "00001"))
    states = rows("state_key bigint, state_code string", (1, "RJ"), (2, "SP"))
    cities = rows("city_key bigint, city_name string, state_key bigint", (1, "b", 1))
    got = {tuple(r) for r in dim.customers(stg, zips, states, cities).collect()}
    assert got == {("c1", "u1", 7, 1, 1), ("c2", "u2", None, None, 2)}


def test_labels_and_sales_reps(rows):
    empty = {t: rows(", ".join(dict.fromkeys([f"{c} {'date' if c == 'first_contact_date' else 'timestamp_ntz'}" for c in dim.DATED_COLUMNS.get(t, [])] + [f"{c} string" for n, c in dim.LABELS.values() if n == t]))) for t in {*dim.DATED_COLUMNS, *(n for n, _ in dim.LABELS.values())}}
    day = dt.datetime(2018, 1, 5, 10)
    orders = rows(empty["stg_orders"]._jdf.schema().toDDL(), *[(None, day + dt.timedelta(days=i), None, None, None, s) for i, s in enumerate(("a", "", None, "a"))])
    found = dim.harvest({**empty, "stg_orders": orders})
    assert tuple(dim.date_bounds(found).first()) == (day.date(), dt.date(2018, 1, 8))
    assert {tuple(r) for r in dim.labels(found).collect()} == {("order_status", "a"), ("order_status", "unknown")}
    ranked = rows("rank bigint, kind string, label string", (1, "k", "a"), (2, "k", "b"), (3, "l", "a"))
    assert {tuple(r) for r in dim.label_keys(ranked).collect()} == {("k", "a", 1), ("k", "b", 2), ("l", "a", 1)}
    assert tuple(dim.date_bounds(dim.harvest(empty)).first()) == (None, None)
    deals = rows("sdr_id string, sr_id string", ("1", "1"), ("1", None), ("", "2"))
    assert {tuple(r) for r in dim.sales_reps(deals).collect()} == {("1", "SDR"), ("1", "SR"), ("2", "SR")}
