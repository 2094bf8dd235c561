"""Row frames, time ranges, splits and samples against plain windows and brute force."""

import datetime
import math
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from airseries.operators import sampling
from airseries.operators.ordering import PART, TILE, sorted_tiles, tile_count, tile_list, with_row_index
from airseries.operators.temporal import (
    RowFrame,
    difference,
    lag,
    range_mean,
    rolling_mean,
    with_row_frames,
)
from airseries.plans.readings import (
    FEATURE_TABLE,
    FEATURES,
    build_features,
    category_columns,
    prepare,
)
from airseries.sources.readers import READINGS_SCHEMA

T0 = datetime.datetime(2024, 1, 1)


def series(spark, n, seed=0, hot=0.34):
    """Rows with ties in time, a hot station and a hot time stamp."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        station = 0 if rng.random() < hot else rng.randrange(1, 6)
        minutes = 600 if rng.random() < hot else rng.randrange(0, 3000)
        value = None if rng.random() < 0.1 else round(rng.uniform(0, 400), 2)
        rows.append((i, station, T0 + datetime.timedelta(minutes=minutes), value))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, station long, ts timestamp_ntz, v double").repartition(5)


def as_set(df, *names):
    return {tuple(None if x is None else (round(x, 7) if isinstance(x, float) else x) for x in r)
            for r in df.select(*names).collect()}


FRAMES = {
    "m1": rolling_mean("v", 1),
    "m5": rolling_mean("v", 5),
    "p3": rolling_mean("v", 3, shift=1),
    "l1": lag("v", 1),
    "l7": lag("v", 7),
    "d2": difference("v", 2),
    "c1": difference("v", 1, shift=1),
}


def plain(df, by):
    w = (Window.partitionBy(*by) if by else Window).orderBy("ts", "id")
    return df.withColumns({n: f.build(w) for n, f in FRAMES.items()})


@pytest.mark.parametrize("by", [(), ("station",)])
@pytest.mark.parametrize("rows_per_tile", [1, 8, 13, 100_000])
def test_tiles_equal_one_partition(spark, by, rows_per_tile):
    df = series(spark, 400)
    got = with_row_frames(df, FRAMES, ["ts", "id"], by, rows_per_tile)
    assert got.columns == [*df.columns, *FRAMES]
    assert as_set(got, "id", *FRAMES) == as_set(plain(df, by), "id", *FRAMES)
    assert got.count() == 400


def test_one_hot_series(spark):
    df = series(spark, 200).withColumn("station", F.when(F.col("id") < 190, 1).otherwise(2))
    got = with_row_frames(df, FRAMES, ["ts", "id"], ["station"], rows_per_tile=16)
    assert as_set(got, "id", *FRAMES) == as_set(plain(df, ["station"]), "id", *FRAMES)


def test_tiles_follow_the_rows():
    assert tile_count(0, 8) == 8 and tile_count(10**6, 8, 10**5) == 10 and tile_count(1001, 1, 1000) == 2


def test_small_tiles_share_sort_partitions(spark):
    """Many small tiles cost no task each: there are no more sort partitions than shuffle partitions."""
    df = series(spark, 400)
    tiles = sorted_tiles(df, ["ts", "id"], 3)
    found = sorted((r[0], r[1]) for r in tiles.groupBy(TILE).count().collect())
    assert tiles.select(PART).distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(found) >= 400 / 3 and max(n for _, n in found) <= 3
    assert [(t.number, t.size) for t in tile_list(tiles, 3)] == found


def test_no_single_partition(spark):
    df = series(spark, 300)
    got = with_row_frames(df, FRAMES, ["ts", "id"])
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The frames inside the tiles read them where they lie; only the rows at the edges of tiles move.
    assert plan.count("Window [") == 2
    assert "hashpartitioning(_edge" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange SinglePartition" not in plan


def test_empty_and_one_row(spark):
    df = series(spark, 1)
    assert with_row_frames(df, FRAMES, ["ts", "id"]).count() == 1
    empty = df.filter("id < 0")
    assert with_row_frames(empty, FRAMES, ["ts", "id"]).count() == 0
    assert with_row_frames(empty, FRAMES, ["ts", "id"], ["station"]).count() == 0
    assert with_row_frames(df, {}, ["ts", "id"]) is df


def test_row_index(spark):
    df = series(spark, 500)
    got = with_row_index(df, ["station", "ts", "id"], "i").orderBy("i").collect()
    assert [r.i for r in got] == list(range(500))
    assert [(r.station, r.ts, r.id) for r in got] == sorted((r.station, r.ts, r.id) for r in got)


@settings(max_examples=6, deadline=None)
@given(st.integers(1, 60), st.integers(1, 9), st.integers(0, 10_000))
def test_lag_twice(spark, n, k, seed):
    df = series(spark, n, seed)
    once = with_row_frames(df, {"a": lag("v", k)}, ["ts", "id"], rows_per_tile=7)
    twice = with_row_frames(once, {"b": lag("a", k)}, ["ts", "id"], rows_per_tile=5)
    direct = with_row_frames(df, {"b": lag("v", 2 * k)}, ["ts", "id"], rows_per_tile=11)
    assert as_set(twice, "id", "b") == as_set(direct, "id", "b")


def test_own_frame(spark):
    df = series(spark, 120)
    top = RowFrame(3, lambda w: F.max("v").over(w.rowsBetween(-3, 0)))
    got = with_row_frames(df, {"top": top}, ["ts", "id"], rows_per_tile=10)
    w = Window.orderBy("ts", "id").rowsBetween(-3, 0)
    assert as_set(got, "id", "top") == as_set(df.withColumn("top", F.max("v").over(w)), "id", "top")


def brute_range(rows, hours, keyed):
    out = {}
    for r in rows:
        near = [
            x.v for x in rows
            if (not keyed or x.station == r.station)
            and r.ts - datetime.timedelta(hours=hours) <= x.ts <= r.ts and x.v is not None
        ]
        out[r.id] = sum(near) / len(near) if near else None
    return out


@pytest.mark.parametrize("by", [(), ("station",)])
def test_time_range(spark, by):
    df = series(spark, 300, seed=3)
    got = range_mean(df, "v", 3, "ts", "id", by, "m")
    want = brute_range(df.collect(), 3, bool(by))
    have = {r.id: r.m for r in got.collect()}
    assert have.keys() == want.keys()
    assert all(have[i] == pytest.approx(want[i]) for i in want if want[i] is not None)
    assert all(have[i] is None for i in want if want[i] is None)


@pytest.mark.parametrize("by", [(), ("s",)])
def test_time_range_keeps_every_magnitude(spark, by):
    at = datetime.datetime(2024, 1, 1)
    values = [1e-10, 3e-10, math.nan, 2.0, 1e20, math.inf, 5e-324, -1e300, 1e300, None, 0.0]
    rows = [(i, "a", at + datetime.timedelta(hours=2 * i), v) for i, v in enumerate(values)]
    # Frames of one row hold its own value to the last digit, whatever the others are.
    df = spark.createDataFrame(rows, "id long, s string, ts timestamp_ntz, v double")
    got = {r.id: r.m for r in range_mean(df, "v", 1, "ts", "id", by, "m").collect()}
    want = [None if v is None or not math.isfinite(v) else v for v in values]
    assert [got[i] for i in range(len(values))] == want
    wide = {r.id: r.m for r in range_mean(df, "v", 3, "ts", "id", by, "m").collect()}
    assert wide[1] == pytest.approx(2e-10, rel=1e-15) and wide[2] == 3e-10
    assert wide[8] == 0.0 and wide[4] == pytest.approx(5e19, rel=1e-15)
    none = df.withColumn("v", F.lit(None).cast("double"))
    assert {r.m for r in range_mean(none, "v", 3, "ts", "id", by, "m").collect()} == {None}


def test_splits(spark):
    df = series(spark, 205)
    rows = sampling.positional_split(df, ["ts", "id"], 0.8).collect()
    assert len(rows) == 205 and sum(r.split == "train" for r in rows) == 164
    last = max((r.ts, r.id) for r in rows if r.split == "train")
    assert last < min((r.ts, r.id) for r in rows if r.split == "test")

    lazy = sampling.temporal_split(df, "ts", 0.8)
    cut = sampling.time_cut(df, "ts", 0.8)
    given_cut = sampling.temporal_split(df, "ts", 0.8, cut=cut)
    assert as_set(lazy, "id", "split") == as_set(given_cut, "id", "split")
    times = sorted(r.ts for r in df.collect())
    assert cut == str(times[164 - 1])


def test_cut_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    series(spark, 100).write.parquet(path)
    df = spark.read.parquet(path)
    train, test = sampling.cut_frames(df, "ts", sampling.time_cut(df, "ts"))
    assert "LessThan(ts" in train._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in test._jdf.queryExecution().executedPlan().toString()
    assert train.count() + test.count() == 100


def test_hash_sample_does_not_depend_on_layout(spark):
    df = spark.range(20_000)
    one = {r.id for r in sampling.hash_sample(df.coalesce(1), "id", 0.1).collect()}
    many = {r.id for r in sampling.hash_sample(df.repartition(7), "id", 0.1).collect()}
    assert one == many and 1900 < len(one) < 2100
    huge = spark.range(2**62, 2**62 + 5)
    assert sampling.hash_split(huge, "id").count() == 5
    parts = sampling.hash_split(df, "id", 0.8).groupBy("split").count().collect()
    assert sum(r["count"] for r in parts) == 20_000
    assert {r.split for r in parts} == {"train", "test"}


def test_builtin_samples(spark):
    df = spark.range(5000)
    assert 300 < sampling.bernoulli_sample(df, 0.1, 42).count() < 700
    train, test = sampling.random_split(df)
    assert train.count() + test.count() == 5000
    assert train.intersect(test).count() == 0


def raw(spark, n=60):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        t = T0 + datetime.timedelta(hours=i)
        pm = None if i % 9 == 4 else rng.uniform(0, 300)
        rows.append((i, t.year, t.month, t.day, t.hour, pm, rng.uniform(-20, 20), float(i % 5 - 2) or None,
                     1000.0 + i, rng.choice(["NE", "NW", "SE", None]), 1.0, 0.0, 2.0))
    return spark.createDataFrame(rows, READINGS_SCHEMA)


def test_feature_table(spark):
    clean = prepare(raw(spark))
    table = build_features(clean)
    assert table.columns == FEATURE_TABLE and len(FEATURE_TABLE) == 48 and len(FEATURES) == 44
    rows = table.collect()
    assert len(rows) == clean.count() - 24
    for r in rows:
        assert r.pm25_diff_1h + r.pm25_lag_1h == pytest.approx(r.pm2_5)
        assert r.wind_NE + r.wind_NW + r.wind_SE + r.wind_cv == 1
        assert r.season_Winter + r.season_Spring + r.season_Summer + r.season_Fall == 1
    assert not any(v is None for r in rows for v in r)


def test_causal_features_do_not_see_the_target(spark):
    df = raw(spark)
    changed = df.withColumn("pm2.5", F.when(F.col("No") == 59, 9999.0).otherwise(F.col("`pm2.5`")))
    one, two = (
        build_features(prepare(d), causal=True, keep=["No"]).filter("No = 59").first() for d in (df, changed)
    )
    for name in FEATURES:
        assert one[name] == pytest.approx(two[name]), name
    usual, seen = (
        build_features(prepare(d), keep=["No"]).filter("No = 59").first() for d in (df, changed)
    )
    assert usual.pm25_rolling_3h != seen.pm25_rolling_3h


def test_features_by_series(spark):
    df = raw(spark).withColumn("station", F.col("No") % 2)
    both = build_features(prepare(df), by=["station"], keep=["No"])
    alone = build_features(prepare(df).filter("station = 1"), keep=["No"])
    got = both.filter("station = 1")
    cols = ["No", "pm25_rolling_24h", "pm25_lag_24h", "temp_deviation"]
    assert as_set(got, *cols) == as_set(alone, *cols) and got.count() > 0


def test_category_columns(spark):
    out = category_columns(prepare(raw(spark)))
    names = [c for c in out.columns if c.startswith("aqi_") and c != "aqi_category"]
    assert names == [
        "aqi_good", "aqi_moderate", "aqi_unhealthy_sensitive", "aqi_unhealthy",
        "aqi_very_unhealthy", "aqi_hazardous",
    ]
    assert all(sum(r[n] for n in names) == 1 for r in out.collect())


def test_dropped_stages_leave_nothing(spark):
    from airseries.checks.sources import table_report
    from airseries.session import drop_stages, stage_root

    table_report(spark, "/root/testdata/sf0.001").collect()
    home = f"{stage_root(spark)}/airseries/{spark.sparkContext.applicationId}".removeprefix("file:")
    assert os.path.isdir(home)
    drop_stages(spark)
    assert not os.path.exists(home)
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("db_")]
