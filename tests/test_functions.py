"""Bands, index, calendar and numeric helpers at their edges."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airseries.functions import bands, calendar, numeric
from airseries.functions.naming import slug


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def values(df, c):
    return [r[0] for r in df.select(c).collect()]


# Worked values: bounds belong to the band below, and the index is not monotone.
INDEX = [
    (0.0, "Good", 0.0),
    (12.0, "Good", 50.04),
    (25.0, "Moderate", 77.69),
    (35.4, "Moderate", 99.842),
    (55.4, "Unhealthy for Sensitive Groups", 150.0),
    (150.4, "Unhealthy", 249.75),
    (150.5, "Very Unhealthy", 200.05),
    (250.4, "Very Unhealthy", 250.0),
    (300.0, "Hazardous", 319.84),
]


def test_bands_and_index(spark):
    df = column(spark, [v for v, _, _ in INDEX])
    assert values(df, bands.band("x")) == [b for _, b, _ in INDEX]
    assert values(df, bands.piecewise("x")) == pytest.approx([i for _, _, i in INDEX])


def test_missing_has_no_band(spark):
    df = column(spark, [None, math.nan])
    assert values(df, bands.band("x")) == [None, None]
    assert values(df, bands.piecewise("x")) == [None, None]


def test_integer_input(spark):
    df = column(spark, [12, 13, None], "int")
    assert values(df, bands.band("x")) == ["Good", "Moderate", None]
    assert values(df, bands.piecewise("x"))[:2] == pytest.approx([50.04, 52.13])


def test_breakpoint_index_is_continuous(spark):
    joints = [12.0, 35.4, 55.4, 150.4, 250.4]
    df = column(spark, [j + d for j in joints for d in (0.0, 1e-9)])
    got = values(df, bands.piecewise("x", bands.EPA_INDEX))
    assert got == pytest.approx([v for j in (50, 100, 150, 200, 300) for v in (j, j)], abs=1e-6)


def test_index_cap(spark):
    df = column(spark, [1000.0])
    assert values(df, bands.piecewise("x", cap=500)) == [500.0]


def test_other_tables(spark):
    df = column(spark, [12.0, 35.4, 55.4, 150.4, 200.4])
    assert values(df, bands.band("x", bands.FIVE_BANDS)) == [b for _, b in bands.FIVE_BANDS]
    assert values(df, bands.piecewise("x", bands.FIVE_BAND_INDEX))[-1] == pytest.approx(233.0)
    coarse = bands.band("x", bands.COARSE_BANDS)
    assert values(df, bands.encode_labels(coarse, bands.COARSE_CODES)) == [0.0, 0.0, 1.0, 2.0, 2.0]


def test_groups_and_codes(spark):
    df = column(spark, ["GK", "CB", "CM", "RF", "XX", None], "string")
    role = bands.group_values("x", bands.PLAYER_ROLES)
    assert values(df, role) == ["GK", "DEF", "MID", "OFF", None, None]
    assert values(df, bands.encode_labels(role, bands.ROLE_CODES)) == [0, 1, 2, 3, None, None]


def test_timestamp_parts(spark):
    rows = [(2012, 2, 29, 5), (2013, 2, 29, 5), (2010, 1, 1, 23), (2010, 1, 1, 24), (None, 1, 1, 0)]
    df = spark.createDataFrame(rows, "y int, m int, d int, h int")
    built = calendar.assemble_timestamp("y", "m", "d", "h")
    assert [str(v) if v else None for v in values(df, built)] == [
        "2012-02-29 05:00:00", None, "2010-01-01 23:00:00", None, None,
    ]
    parsed = calendar.parse_timestamp("y", "m", "d", "h").cast("timestamp_ntz")
    assert values(df.limit(3), parsed) == values(df.limit(3), built)


def test_calendar(spark):
    # 2010-01-01 is a Friday in ISO week 53; 2010-01-02 a Saturday.
    df = spark.sql(
        "SELECT CAST(t AS timestamp_ntz) t FROM VALUES ('2010-01-01 08:00:00'),"
        " ('2010-01-02 18:00:00'), ('2010-11-30 19:00:00') AS v(t)"
    )
    named = calendar.calendar_columns("t")
    rows = [tuple(r) for r in df.select(*[c.alias(n) for n, c in named.items()]).collect()]
    assert list(named) == [
        "day_of_week", "day_of_month", "week_of_year", "season",
        "is_weekend", "is_rush_hour", "is_business_hours",
    ]
    assert rows == [
        (6, 1, 53, "Winter", 0, 1, 1),
        (7, 2, 53, "Winter", 1, 1, 0),
        (3, 30, 48, "Fall", 0, 1, 0),
    ]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(6.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "n double, d double")
    assert values(df, numeric.safe_ratio("n", "d", 1.0)) == [3.0, 1.0, 1.0, None]


def test_slug():
    assert slug("Unhealthy for Sensitive Groups") == "unhealthy_sensitive"
    assert slug("Very Unhealthy") == "very_unhealthy"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(0, 600), min_size=1, max_size=20))
def test_band_matches_first_bound(spark, xs):
    got = values(column(spark, xs), bands.band("x"))
    want = [next(b for u, b in bands.PM25_BANDS if u is None or x <= u) for x in xs]
    assert got == want
    assert values(column(spark, xs).select(F.col("x").alias("x")), F.col("x")) == xs
