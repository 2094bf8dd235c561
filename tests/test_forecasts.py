"""Look-ahead frames, folds, horizons, quantile lines and error cubes against brute force."""

import datetime
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from airseries.operators import folds, metrics, temporal
from airseries.operators.ordering import Tile
from airseries.operators.quantile_regression import quantile_regression

T0 = datetime.datetime(2024, 1, 1)


def series(spark, n, seed=0):
    """Rows with ties in time, a hot time stamp, a hot station and gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        minutes = 600 if rng.random() < 0.3 else rng.randrange(3000)
        value = None if rng.random() < 0.1 else round(rng.uniform(0, 400), 2)
        rows.append((i, 0 if rng.random() < 0.34 else rng.randrange(1, 6), T0 + datetime.timedelta(minutes=minutes), value))
    return spark.createDataFrame(rows, "id long, station long, ts timestamp_ntz, v double").repartition(5)


FRAMES = {
    "a1": temporal.lead("v", 1),
    "a9": temporal.lead("v", 9),
    "l2": temporal.lag("v", 2),
    "c3": temporal.centred("v", 3),
    "m4": temporal.rolling_mean("v", 4),
}


@pytest.mark.parametrize("by", [[], ["station"]])
@pytest.mark.parametrize("rows_per_tile", [3, 40, 1000])
def test_frames_ahead_equal_one_window(spark, by, rows_per_tile):
    # Tiles of three rows are shorter than the frames, so a frame spans several of them.
    df = series(spark, 300)
    got = temporal.with_row_frames(df, FRAMES, ["ts", "id"], by, rows_per_tile)
    window = Window.partitionBy(*by).orderBy("ts", "id")
    want = df.withColumns({n: f.build(window) for n, f in FRAMES.items()})
    names = ["id", *FRAMES]

    def rows(d):
        return sorted(tuple(round(x, 7) if isinstance(x, float) else x for x in r) for r in d.select(*names).collect())

    assert str(rows(got)) == str(rows(want))


@given(st.lists(st.integers(1, 6), min_size=2, max_size=12), st.integers(0, 8), st.integers(0, 8))
@settings(max_examples=200, deadline=None)
def test_edges_cover_every_row_once_with_its_whole_frame(sizes, back, ahead):
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    total = sum(sizes)
    made = temporal._edges([Tile(i * 3, s, n) for i, (s, n) in enumerate(zip(starts, sizes))], back, ahead)
    owned, held = [], {}
    for (_, start, first, last, groups), size in zip(made, sizes):
        inside = list(range(first, last + 1))
        for row in inside:
            assert start <= max(0, row - back) and min(total - 1, row + ahead) < start + size
        owned += inside
        for edge, a, b, lo, hi in groups:
            held.setdefault((edge, a, b), set()).update(r for r in range(start, start + size) if lo <= r <= hi)
    for (_, a, b), rows in held.items():
        owned += list(range(a, b + 1))
        assert set(range(max(0, a - back), min(total, b + ahead + 1))) <= rows
    assert sorted(owned) == list(range(total))


def test_frames_ahead_move_edge_rows_only(spark):
    df = temporal.with_row_frames(series(spark, 400), {"a": temporal.lead("v", 2)}, ["ts", "id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # One exchange by edge group; the tiles themselves are read where they lie.
    assert plan.count("hashpartitioning(_edge") == 1 and "hashpartitioning(_tile" not in plan


@pytest.mark.parametrize("window,gap", [(None, 0), (2, 0), (1, 3600)])
def test_no_fold_trains_on_rows_after_its_cut(spark, window, gap):
    df = series(spark, 400, 3)
    rows = [(r.id, r.ts) for r in df.collect()]
    made = folds.time_folds(df, "ts", 5, window, gap)
    tested = {}
    parts = folds.in_folds(df, "ts", made).collect()
    for fold in made:
        cut = datetime.datetime.fromisoformat(fold.cut)
        train = {r.id for r in parts if r.fold == fold.number and r.role == "train"}
        test = {r.id for r in parts if r.fold == fold.number and r.role == "test"}
        start = datetime.datetime.fromisoformat(fold.start) if fold.start else datetime.datetime.min
        assert train == {i for i, t in rows if start <= t < cut - datetime.timedelta(seconds=gap)}
        assert test and not train & test
        for i in test:
            assert tested.setdefault(i, fold.number) == fold.number
        a, b = folds.fold_frames(df, "ts", fold)
        assert ({r.id for r in a.collect()}, {r.id for r in b.collect()}) == (train, test)
    first = min(datetime.datetime.fromisoformat(f.cut) for f in made)
    assert set(tested) == {i for i, t in rows if t >= first}


def test_folds_of_odd_tables(spark):
    empty = series(spark, 1).limit(0)
    assert folds.time_folds(empty, "ts") == []
    assert folds.in_folds(empty, "ts", []).columns == [*empty.columns, "fold", "role"]
    one_time = spark.createDataFrame([(i, T0) for i in range(9)], "id long, ts timestamp_ntz")
    made = folds.time_folds(one_time, "ts", 3)
    assert [f.number for f in made] == [3]
    assert folds.in_folds(one_time, "ts", made).where("role = 'train'").count() == 0
    untimed = spark.createDataFrame([(1, None), (2, T0)], "id long, ts timestamp_ntz")
    assert {r.id for r in folds.in_folds(untimed, "ts", folds.time_folds(untimed, "ts", 1)).collect()} == {2}
    with pytest.raises(ValueError):
        folds.time_folds(one_time, "ts", 0)
    with pytest.raises(ValueError):
        folds.with_horizons(one_time, "id", [0], ["ts"])


def test_cross_validation_of_a_model(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = [(i, T0 + datetime.timedelta(hours=i), float(i % 7), 3.0 * (i % 7) + 1) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, x double, y double")
    steps = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="v"), LinearRegression(featuresCol="v", labelCol="y")])
    found = folds.cross_validate(df, "ts", folds.time_folds(df, "ts", 3), lambda t: steps.fit(t).transform, "y").collect()
    assert len(found) == 3 and sum(r.n for r in found) == 91
    assert all(r.rmse < 1e-6 for r in found)


def pinball(rows, q, line):
    return sum(max(q * (y - line(x)), (q - 1) * (y - line(x))) for x, y in rows) / len(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_quantile_lines_reach_the_least_loss(spark, seed):
    # Some line of least loss goes through two of the points.
    rng = random.Random(seed)
    rows = [(x, 2 * x + rng.expovariate(1) * (1 + x)) for x in [rng.uniform(0, 10) for _ in range(60)]]
    df = spark.createDataFrame(rows, "x double, y double")
    wanted = [0.1, 0.5, 0.9]
    for q, found in zip(wanted, quantile_regression(df, "y", ["x"], wanted)):
        best = min(
            pinball(rows, q, lambda x: y0 + (y1 - y0) / (x1 - x0) * (x - x0))
            for (x0, y0), (x1, y1) in itertools.combinations(rows, 2)
        )
        loss = pinball(rows, q, lambda x: found.intercept + found.slopes[0] * x)
        assert best - 1e-9 <= loss <= best * 1.005


def test_quantile_lines_of_odd_tables(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 6.0), (None, 5.0, 1.0), (4.0, float("nan"), 1.0), (5.0, 5.0, float("inf"))],
        "y double, same double, twice double",
    )
    assert [m.intercept for m in quantile_regression(df, "y", [], [0.2, 0.8])] == [1.0, 4.0]
    (line,) = quantile_regression(df, "y", ["same", "twice"], [0.5])
    assert line.slopes[0] == 0 and abs(line.slopes[1] - 0.5) < 1e-4
    assert quantile_regression(df.limit(0), "y", ["twice"]) == []
    with pytest.raises(ValueError):
        quantile_regression(df, "y", [], [1.0])


def test_forecast_metrics_and_cube(spark):
    rows = [("a", 1, 2.0, 3.0, 1.0), ("a", None, 0.0, 1.0, 1.0), ("b", 1, 4.0, None, 1.0), ("b", 2, 1.0, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "k string, h int, y double, p double, now double")
    got = metrics.forecast_metrics(df, "y", "p", "now").first()
    # 2 against 3: same side; 0 against 1 (which is now): not; 1 (which is now) against 0.5: not.
    assert (got.n, got.mape, round(got.direction, 6)) == (3, 0.5, round(1 / 3, 6))
    cube = {(r.k, r.h, r.k_all, r.h_all): (r.n, r.worst) for r in metrics.error_cube(df, "y", "p", ["k", "h"]).collect()}
    assert cube[None, None, True, True] == (3, 1.0)
    assert cube["a", None, False, True] == (2, 1.0) and cube["a", None, False, False] == (1, 1.0)
    assert ("b", 1, False, False) not in cube and cube[None, None, True, False] == (1, 1.0)
    (loss,) = metrics.pinball_loss(df, "y", {0.25: "p"}).collect()
    assert (loss.n, loss.loss, loss.covered) == (3, (0.75 + 0.75 + 0.125) / 3, 2 / 3)
    assert metrics.error_cube(df.limit(0), "y", "p", ["k"]).count() <= 1
