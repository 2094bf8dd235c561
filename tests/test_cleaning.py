"""Filters, imputation, profiles, column maintenance, sources and sinks."""

import datetime
import math
from decimal import Decimal
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.operators import clean, columns, profile
from airseries.operators.quantiles import quantiles, quantiles_of
from airseries.session import scale_settings, stage, stage_path
from airseries.sources import readers, sinks


@pytest.fixture()
def gaps(spark):
    rows = [(1, 1.0, "a"), (2, None, "b"), (3, math.nan, "b"), (4, 5.0, None), (5, 3.0, "a")]
    return spark.createDataFrame(rows, "id long, x double, s string")


def test_drop_missing_takes_nan(gaps):
    assert {r.id for r in clean.drop_missing(gaps, "x").collect()} == {1, 4, 5}
    assert {r.id for r in clean.drop_missing(gaps, "x", "s").collect()} == {1, 5}


def test_impute_keeps_mean(gaps):
    got = {r.id: r.x for r in clean.impute_mean(gaps, ["x"]).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 3.0, 4: 5.0, 5: 3.0}


def test_impute_integers_and_empty(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    out = clean.impute_mean(df, ["n"])
    assert out.schema["n"].dataType == T.DoubleType()
    assert sorted(r.n for r in out.collect()) == [1.0, 1.5, 2.0]
    nulls = spark.createDataFrame([(None,), (None,)], "n double")
    assert [r.n for r in clean.impute_mean(nulls, ["n"]).collect()] == [None, None]


def test_impute_plan_has_no_join(gaps):
    plan = clean.impute_mean(gaps, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_mode_ignores_null_and_breaks_ties(spark, gaps):
    assert tuple(clean.mode_of(gaps, "s").first()) == ("a", 2)
    df = spark.createDataFrame([(None,), (None,), ("z",), ("b",)], "s string")
    assert tuple(clean.mode_of(df, "s").first()) == ("b", 1)
    assert sorted(r.s for r in clean.fill_mode(df, "s").collect()) == ["b", "b", "b", "z"]


def test_dedup_keeps_lowest(spark):
    rows = [("a", 1, 7, None), ("a", 1, 3, "x"), ("b", 1, 9, "y"), (None, 1, 2, "n")]
    df = spark.createDataFrame(rows, "`k.1` string, t int, id long, v string")
    got = clean.dedup(df, ["k.1", "t"], "id")
    assert got.columns == df.columns
    assert {tuple(r) for r in got.collect()} == {rows[1], rows[2], rows[3]}


def test_census(spark, gaps):
    assert tuple(profile.null_census(gaps).first()) == (0, 2, 1)
    report = [tuple(r) for r in profile.null_report(gaps).collect()]
    assert report == [("x", 2, 40.0), ("s", 1, 20.0)]
    assert profile.null_report(gaps.filter("id = 1")).count() == 0


def test_profiles_on_empty_table(gaps):
    empty = gaps.filter("id < 0")
    assert tuple(profile.null_census(empty).first()) == (0, 0, 0)
    assert profile.outlier_report(empty, "x").first()["outlier_percentage"] is None
    assert profile.retention(empty, F.lit(True)).first()["percent_kept"] is None
    assert clean.mode_of(empty, "s").count() == 0


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(1, 100), 10_000]], "x double")
    row = profile.outlier_report(df, "x").first()
    assert (row.q1, row.median, row.q3) == (25.0, 50.0, 75.0)
    assert (row.lower, row.upper, row.outliers, row.total) == (-125.0, 225.0, 1, 100)
    assert [r.x for r in profile.flag_outliers(df, "x").filter("is_outlier").collect()] == [10000.0]


def brute_quantiles(values, shares):
    kept = sorted(v for v in values if v is not None and v == v)
    return [kept[max(1, math.ceil(round(p * len(kept), 9))) - 1] for p in shares]


SHARES = [0.0, 0.01, 0.25, 0.5, 0.8, 0.99, 1.0]


@pytest.mark.parametrize(
    "kind,values",
    [
        ("double", [1.5, None, math.nan, 2.5]),
        ("double", [float(i % 7) for i in range(200)] + [1e6]),
        ("double", [3.0] * 150 + [i / 3 for i in range(60)]),
        ("double", [math.inf, -math.inf, -math.inf, 1.0, 2.0, -1e308, 1e308] + [i * 0.1 for i in range(50)]),
        ("double", [-0.0, 0.0, 5e-324, 1e-310] * 10),
        ("float", [i * 0.25 for i in range(77)]),
        ("int", list(range(500)) + [None]),
        ("long", [2**63 - 1, -(2**63), 0] + [2**60 + i for i in range(90)]),
        ("long", [7]),
    ],
)
def test_exact_quantiles(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"`a.b` {kind}").repartition(3)
    want = brute_quantiles(values, SHARES)
    assert quantiles(df, "a.b", SHARES) == want
    assert quantiles(df, "a.b", SHARES, buckets=4) == want


def test_exact_quantiles_of_time(spark):
    base = datetime.datetime(2024, 3, 30)
    times = [base + datetime.timedelta(microseconds=7919**2 * i) for i in range(300)] + [base] * 100
    for kind in ("timestamp_ntz", "timestamp", "date"):
        df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").select(F.col("t").cast(kind))
        want = brute_quantiles([r.t for r in df.collect()], [0.1, 0.8])
        for found in (quantiles(df, "t", [0.1, 0.8]), quantiles(df, "t", [0.1, 0.8], 16)):
            assert [str(w) for w in want] == found


def test_exact_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,), (math.nan,)], "x double")
    assert quantiles(df, "x", [0.5]) == [None]


@pytest.mark.parametrize("kind,first,step", [
    ("decimal(38,4)", "12345678901234567000", "1"),
    ("decimal(38,20)", "0.00000000000000000001", "0.00000000000000000001"),
    ("decimal(10,2)", "-3.00", "0.01"),
])
def test_exact_quantiles_of_decimals(spark, kind, first, step):
    values = [Decimal(first) + i * Decimal(step) for i in range(500)] + [Decimal(first)] * 100
    df = spark.createDataFrame([(str(v),) for v in values], "x string").select(F.col("x").cast(kind))
    want = brute_quantiles(values, SHARES)
    assert quantiles(df, "x", SHARES) == want
    assert quantiles(df, "x", SHARES, buckets=4) == want


def test_quantiles_of_several_columns(spark):
    rows = [(float(i % 13), i, None if i % 3 else i * 7) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b int, c long").repartition(4)
    got = quantiles_of(df, {"a": SHARES, "b": [0.5], "c": [0.25, 0.75]}, buckets=8)
    assert got["a"] == brute_quantiles([r[0] for r in rows], SHARES)
    assert got["b"] == brute_quantiles([r[1] for r in rows], [0.5])
    assert got["c"] == brute_quantiles([r[2] for r in rows], [0.25, 0.75])


def test_approx_quantiles(spark):
    df = spark.range(1000).select((F.col("id") * 1.0).alias("x"))
    got = profile.approx_quantiles(df, "x", [0.25, 0.75])
    assert got == pytest.approx([250, 750], abs=11)


def test_typed_summary_equals_describe(spark, gaps):
    df = clean.drop_missing(gaps, "x")
    typed = profile.summary_numeric(df, ["x"]).first()
    text = {r.summary: float(r.x) for r in df.select("x").summary().collect()}
    assert typed["count"] == text["count"]
    for ours, theirs in (("mean", "mean"), ("stddev", "stddev"), ("min", "min"), ("p50", "50%")):
        assert typed[ours] == pytest.approx(text[theirs])


def test_correlations_order(spark):
    df = spark.createDataFrame([(1.0, 3.0, 1.0), (2.0, 2.0, 5.0), (3.0, 1.0, 2.0)], "y double, a double, b double")
    rows = profile.correlations(df, "y", ["b", "a", "absent"]).collect()
    assert [r.feature for r in rows] == ["a", "b"] and rows[0].correlation == pytest.approx(-1.0)


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`pm2.5` int, `Ball Control` int, BP int")
    assert columns.sanitize_columns(df).columns == ["pm2_5", "Ball Control", "BP"]
    assert "Ball_Control" in columns.rename_present(df, columns.PLAYER_RENAMES).columns
    got = columns.select_present(df, ["BP", "nope", "pm2.5"], ["BP"])
    assert got.columns == ["BP", "pm2.5"]
    with pytest.raises(ValueError):
        columns.select_present(df, ["BP"], ["label"])
    assert columns.drop_present(df, "BP", "nope").columns == ["pm2.5", "Ball Control"]


def test_csv_missing_values(spark, tmp_path):
    header = "No,year,month,day,hour,pm2.5,DEWP,TEMP,PRES,cbwd,Iws,Is,Ir"
    text = f"{header}\n1,2010,1,1,0,NA,-21,-11,1021,NW,1.79,0,0\n2,2010,1,1,1,129,NaN,-12,1020,NA,4.92,0,0\n"
    path = tmp_path / "readings.csv"
    path.write_text(text)
    first, second = readers.read_readings_csv(spark, str(path)).orderBy("No").collect()
    assert first["pm2.5"] is None and first["DEWP"] == -21.0
    assert second["DEWP"] is None and second["cbwd"] is None and second["pm2.5"] == 129.0


def test_json_filters(spark, tmp_path):
    lines = [
        '{"location":"a","country":"ES","parameter":"pm25","value":1.5,"date":{"utc":"2024-01-02T00:00:00"}}',
        '{"location":"b","country":"PT","parameter":"pm25","value":2.5,"date":{"utc":"2024-01-02T00:00:00"}}',
        '{"location":"c","country":"ES","parameter":"o3","value":3.5,"date":{"utc":"2023-12-31T00:00:00"}}',
    ]
    path = tmp_path / "m.json"
    path.write_text("\n".join(lines))
    got = readers.read_measurements_json(spark, str(path), "ES", ["pm25", "o3"], "2024-01-01")
    assert [r.location for r in got.collect()] == ["a"]


def test_json_times_and_limit(spark, tmp_path):
    texts = ["2024-01-10T01:00:00Z", "2024-01-10T01:00:00+00:00", "2024-01-10T02:00:00+01:00", "2024-01-10T01:00:00"]
    path = tmp_path / "t.json"
    path.write_text("\n".join('{"location":"%d","date":{"utc":"%s"}}' % (i, t) for i, t in enumerate(texts)))
    rows = readers.read_measurements_json(spark, str(path)).collect()
    assert {r.date.utc for r in rows} == {datetime.datetime(2024, 1, 10, 1)} and len(rows) == 4
    kept = readers.read_measurements_json(spark, str(path), date_from="2024-01-10 01:00:00", limit=2)
    assert [r.location for r in kept.collect()] == ["0", "1"]
    path.write_text('{"location":"x","date":{"utc":"soon"}}')
    with pytest.raises(Exception, match="not a time"):
        readers.read_measurements_json(spark, str(path)).collect()


def test_malformed_csv_cell_stops_the_read(spark, tmp_path):
    names = ",".join(f.name for f in readers.READINGS_SCHEMA)
    path = tmp_path / "bad.csv"
    path.write_text(names + "\n1,2010,1,1,0,many,-21,-11,1021,NW,1.79,0,0\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_readings_csv(spark, str(path)).collect()
    loose = readers.read_readings_csv(spark, str(path), malformed="PERMISSIVE").first()
    assert loose["pm2.5"] is None and loose["DEWP"] == -21.0


def test_literal_tables(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    assert readers.literal_rows(spark, [("x", 1.0)], schema).schema == schema
    assert readers.literal_rows(spark, [("x", 1.0)], ["p", "q"]).columns == ["p", "q"]
    assert [tuple(r) for r in readers.literal_dicts(spark, [{"a": "x"}], schema).collect()] == [("x", None)]
    pdf = pd.DataFrame({"v": [1.0, math.nan]})
    assert [r.v for r in readers.from_pandas(spark, pdf).collect()] == [1.0, None]


def test_city_profile(spark):
    rows = [
        ("Madrid", 45.2), ("Barcelona", 38.9), ("Valencia", 52.1), ("Sevilla", 41.5), ("Madrid", 48.7),
    ]
    df = readers.literal_rows(spark, rows, ["ciudad", "aqi"])
    got = df.groupBy("ciudad").agg(F.avg("aqi").alias("a"), F.max("aqi").alias("m")).orderBy(F.desc("a"))
    assert [r.ciudad for r in got.collect()] == ["Valencia", "Madrid", "Sevilla", "Barcelona"]
    assert got.filter("ciudad = 'Madrid'").first().m == 48.7


def test_checked_table(spark, gaps):
    name = "db_" + uuid.uuid4().hex
    before = spark.catalog.currentDatabase()
    sinks.use_database(spark, name, stage_path(spark, "db"))
    try:
        saved = sinks.write_checked(gaps, "t")
        assert saved.count() == 5
        again = sinks.write_checked(gaps.filter("id < 3"), "t")
        assert again.count() == 2
        assert [r.tableName for r in sinks.list_tables(spark, name).collect()] == ["t"]
        assert readers.preview(spark, f"{name}.t", 1).count() == 1
        assert tuple(sinks.table_report(spark, f"{name}.t").first()) == ("t", 2, 3)
        assert name in {r.namespace for r in sinks.list_databases(spark).collect()}
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_stage_prunes_columns(spark, gaps):
    staged = stage(gaps, "test")
    assert staged.schema == gaps.schema and staged.count() == 5
    plan = staged.select("id").filter("id > 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,3)" in plan


def test_scale_settings():
    small, large = scale_settings(1 << 20), scale_settings(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    # Two bytes shuffled per byte read, one GiB per task.
    assert int(large["spark.sql.shuffle.partitions"]) == 200 * 1024 + 1
