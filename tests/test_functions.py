import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.functions import display, text, timing


def apply(rows, rule, *values):
    df = rows("i int, v string", *enumerate(values))
    return [r.x for r in df.select("i", rule("v").alias("x")).orderBy("i").collect()]


def test_zip_prefix_pads_cuts_and_keeps_null(rows):
    assert apply(rows, text.zip_prefix, " 123 ", "", "1234567", None) == ["00123", "00000", "12345", None]


def test_only_spaces_are_trimmed(rows):
    assert apply(rows, text.lower_text, " A\t", "  ", None) == ["a\t", "", None]
    assert apply(rows, text.upper_code, " sp ", None) == ["SP", None]


def test_blank_rules(rows):
    assert apply(rows, text.blank_to_unknown, " Toys ", "  ", None) == ["Toys", "unknown", "unknown"]
    assert apply(rows, text.blank_to_unknown_lower, " Paid_Search ", "  ", None) == ["paid_search", "unknown", "unknown"]
    assert apply(rows, text.blank_to_null, " x ", " ", "", None) == ["x", None, None, None]
    assert apply(rows, text.label_or_unknown, "a", "", " ", None) == ["a", "unknown", " ", "unknown"]
    assert apply(rows, text.has_content, "a", "", "  ", None) == [True, False, False, False]


def test_yes_no_is_three_valued(rows):
    assert apply(rows, text.yes_no, " Sim ", "NÃO", "0", "maybe", "", None) == [True, False, False, None, None, None]
    for word in text.TRUE_WORDS:
        assert apply(rows, text.yes_no, word.upper()) == [True]
    for word in text.FALSE_WORDS:
        assert apply(rows, text.yes_no, word.upper()) == [False]


T0 = dt.datetime(2018, 1, 1)


@pytest.mark.parametrize(
    ("end", "hours"),
    [
        (T0 + dt.timedelta(days=1, hours=1, minutes=30, seconds=18), "25.51"),  # 25.505
        (T0 - dt.timedelta(days=1, hours=1, minutes=30, seconds=18), "-25.51"),
        (T0 + dt.timedelta(seconds=17, microseconds=999999), "0.00"),  # just below 0.005
        (T0 + dt.timedelta(seconds=18), "0.01"),
        (T0, "0.00"),
        (None, None),
    ],
)
def test_elapsed_rounds_half_away_from_zero(rows, end, hours):
    df = rows("a timestamp_ntz, b timestamp_ntz", (T0, end))
    got = df.select(timing.elapsed("a", "b", timing.HOUR).alias("h")).first().h
    assert got == (None if hours is None else Decimal(hours))


def test_elapsed_ignores_the_session_time_zone(rows, setting):
    # Clocks in Sao Paulo were put forward on 2018-11-04; zone-free timestamps do not care.
    setting("spark.sql.session.timeZone", "America/Sao_Paulo")
    df = rows("a timestamp_ntz, b timestamp_ntz", (dt.datetime(2018, 11, 3), dt.datetime(2018, 11, 5)))
    r = df.select(timing.elapsed("a", "b", timing.HOUR).alias("h"), timing.date_key("a").alias("k")).first()
    assert (r.h, r.k) == (Decimal("48.00"), 20181103)


def test_date_key_and_period(rows):
    df = rows("d date, y int, m int", (dt.date(2016, 2, 29), 2016, 2), (None, None, 3))
    got = df.select(timing.date_key("d").alias("k"), timing.period_start("y", "m").alias("p")).collect()
    assert [(r.k, r.p) for r in got] == [(20160229, dt.date(2016, 2, 1)), (None, None)]


VALUES = [0.0, 0.5, 1.5, 2.5, 999.5, 1234567.49, -1234.5, 0.12345, 12.25, None]


@pytest.mark.parametrize("v", VALUES)
def test_display_matches_python_formatting(rows, v):
    r = (
        rows("v double", (v,))
        .select(
            display.as_brl(F.col("v")).alias("brl"),
            display.as_percent(F.col("v")).alias("pct"),
            display.as_count(F.col("v")).alias("n"),
        )
        .first()
    )
    x = v or 0.0
    assert r.brl == f"R$ {x:,.0f}".replace(",", " ")
    assert r.pct == f"{x * 100:.1f} %"
    assert r.n == f"{int(x):,}".replace(",", " ")


def test_elapsed_agrees_with_exact_decimal_arithmetic(spark):
    from decimal import ROUND_HALF_UP
    from random import Random

    draw = Random(11)
    ties = [(2 * k + 1) * step for k in range(-20, 20) for step in (18_000_000, 432_000_000)]  # x.xx5 hours / days
    micros = ties + [t + d for t in ties for d in (-1, 1)] + [draw.randint(-(10**13), 10**13) for _ in range(500)]
    data = [(m, T0, T0 + dt.timedelta(microseconds=m)) for m in micros]
    df = spark.createDataFrame(data, "m bigint, a timestamp_ntz, b timestamp_ntz")
    got = df.select("m", timing.elapsed("a", "b", timing.HOUR).alias("h"), timing.elapsed("a", "b", timing.DAY).alias("d"))
    cent = Decimal("0.01")
    for r in got.collect():
        # ROUND_HALF_UP of decimal is half away from zero.
        assert r.h == (Decimal(r.m) / 3_600_000_000).quantize(cent, ROUND_HALF_UP)
        assert r.d == (Decimal(r.m) / 86_400_000_000).quantize(cent, ROUND_HALF_UP)
