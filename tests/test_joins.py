"""As-of joins, interval joins and sessions against brute force, with hot keys, ties and missing values."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from airseries.operators.asof import asof_join
from airseries.operators.intervals import interval_join, interval_totals
from airseries.operators.sessions import sessions, with_sessions

T0 = datetime.datetime(2024, 1, 1)
MISSING = [(9001, 0, None, 1.0), (9002, None, T0, 2.0), (9003, None, None, 3.0)]


def at(minutes):
    return None if minutes is None else T0 + datetime.timedelta(minutes=minutes)


def readings(n, seed, hot=0.34):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        station = 0 if rng.random() < hot else rng.randrange(1, 6)
        minutes = 600 if rng.random() < hot else rng.randrange(0, 1500)
        rows.append((i, station, at(minutes), float(rng.randrange(100))))
    return [*rows, *MISSING]


def frame(spark, rows, tiles=5):
    return spark.createDataFrame(rows, "id long, station long, ts timestamp_ntz, v double").repartition(tiles)


def brute_asof(left, right, by, other, direction, exact, tolerance):
    out = []
    for row in left:
        best = None
        for r in right:
            if row[2] is None or r[2] is None or (by and (row[1] is None or row[1] != r[1])):
                continue
            if other and row[1] == r[1]:
                continue
            gap = (row[2] - r[2]).total_seconds()
            if gap == 0 and not exact:
                continue
            if tolerance is not None and abs(gap) > tolerance:
                continue
            if gap > 0 or gap == 0 and direction != "forward":
                key = (abs(gap), 0, -r[0])
            else:
                key = (abs(gap), 1, r[0])
            if direction == "backward" and gap < 0 or direction == "forward" and gap > 0:
                continue
            if best is None or key < best[0]:
                best = (key, r[0])
        out.append((row[0], best[1] if best else None))
    return sorted(out)


CASES = [
    (direction, exact, tolerance)
    for direction in ("backward", "forward", "nearest")
    for exact in (True, False)
    for tolerance in (None, 1800)
    if exact or direction != "nearest"
]


@pytest.mark.parametrize("kind", ["plain", "by", "other"])
@pytest.mark.parametrize(("direction", "exact", "tolerance"), CASES)
def test_asof(spark, kind, direction, exact, tolerance):
    left, right = readings(130, 1), readings(90, 2)
    by, other = ["station"] * (kind == "by"), "station" if kind == "other" else None
    got = asof_join(
        frame(spark, left), frame(spark, right), "ts", "id", by, other, direction, exact, tolerance, rows_per_tile=45
    )
    want = brute_asof(left, right, kind == "by", kind == "other", direction, exact, tolerance)
    assert sorted((r.id, r.match_id) for r in got.select("id", "match_id").collect()) == want


def test_asof_passes_columns_of_any_name(spark):
    left = frame(spark, readings(20, 3)).withColumn("_at", F.lit("l")).withColumn("match_v", F.lit(1)).withColumn("_tile", F.lit(1))
    right = frame(spark, readings(20, 4)).withColumn("_r1", F.lit("r")).withColumn("a.b", F.lit(7))
    got = asof_join(left, right, "ts", "id", rows_per_tile=4)
    assert got.columns == [*left.columns, *["match_" + c for c in right.columns]]
    assert got.count() == 23


def test_asof_of_empty_sides(spark):
    some, none = frame(spark, readings(10, 5)), frame(spark, [])
    assert asof_join(none, some, "ts", "id").count() == 0
    assert {r.match_id for r in asof_join(some, none, "ts", "id", ["station"], direction="nearest").collect()} == {None}


def test_asof_by_number(spark):
    rows = [(1, 0.5), (2, float("nan")), (3, 2.0), (4, None), (5, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double")
    got = asof_join(df, df, "x", "id", direction="backward", allow_exact=False, tolerance=0.75)
    assert sorted((r.id, r.match_id) for r in got.collect()) == [(1, None), (2, None), (3, None), (4, None), (5, 1)]


def test_asof_reads_tiles_where_they_lie(spark):
    df = frame(spark, readings(200, 6))
    got = asof_join(df, df, "ts", "id", ["station"], rows_per_tile=20)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Exchange hashpartitioning" not in plan


def brute_intervals(points, episodes, by, closed):
    out = []
    for p in points:
        for e in episodes:
            if p[2] is None or (by and (p[1] is None or p[1] != e[1])):
                continue
            after = e[2] is None or e[2] <= p[2]
            before = e[3] is None or (p[2] < e[3] if closed == "left" else p[2] <= e[3])
            empty = e[2] is not None and e[3] is not None and e[3] < e[2]
            if after and before and not empty:
                out.append((p[0], e[0]))
    return sorted(out)


def episodes(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lo = rng.randrange(-100, 1500)
        rows.append((i, 0 if i % 3 == 0 else rng.randrange(6), at(lo), at(lo + rng.choice([0, 1, 7, 60, 300, 5000, 10**6]))))
    rows += [(100, 0, None, at(600)), (101, 1, at(600), None), (102, 2, None, None), (103, None, at(0), at(10**4))]
    rows += [(104, 0, at(600), at(600)), (105, 0, at(700), at(600)), (106, 0, at(500), at(600)), (107, 0, at(600), at(601))]
    rows += [(108, 0, T0 + datetime.timedelta(seconds=36000.25), T0 + datetime.timedelta(seconds=36000.75))]
    return rows


@pytest.mark.parametrize("by", [(), ("station",)])
@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("cell", [0.01, 1.0, 97.0, 10.0**7])
def test_intervals(spark, by, closed, cell):
    points, spans = readings(120, 7), episodes(8)
    points.append((8000, 0, T0 + datetime.timedelta(seconds=36000.5), 0.0))
    held = spark.createDataFrame(spans, "id long, station long, lo timestamp_ntz, hi timestamp_ntz").repartition(3)
    want = brute_intervals(points, spans, bool(by), closed)
    got = interval_join(frame(spark, points), held, "ts", "lo", "hi", by, closed, cell_seconds=cell)
    assert sorted((r.id, r.interval_id) for r in got.select("id", "interval_id").collect()) == want


def test_points_without_interval(spark):
    points, spans = readings(40, 9), episodes(10)[:5]
    held = spark.createDataFrame(spans, "id long, station long, lo timestamp_ntz, hi timestamp_ntz")
    got = interval_join(frame(spark, points), held, "ts", "lo", "hi", ["station"], how="left").collect()
    inner = brute_intervals(points, spans, True, "left")
    alone = [(p[0], None) for p in points if p[0] not in {i for i, _ in inner}]
    assert sorted(((r.id, r.interval_id) for r in got), key=repr) == sorted([*inner, *alone], key=repr)


def test_numbers_and_odd_ends(spark):
    points = spark.createDataFrame([(1, -3.5), (2, 0.0), (3, float("nan")), (4, None), (5, float("inf")), (6, 8.25)], "id long, x double")
    spans = [(1, -4.0, 0.0), (2, float("nan"), 1.0), (3, float("-inf"), float("inf")), (4, 8.25, 8.25), (5, None, -3.5)]
    held = spark.createDataFrame(spans, "id long, lo double, hi double")
    for cell in (0.5, 1.0, 64.0):
        got = interval_join(points, held, "x", "lo", "hi", closed="both", cell_seconds=cell)
        pairs = sorted((r.id, r.interval_id) for r in got.collect())
        assert pairs == [(1, 1), (1, 3), (1, 5), (2, 1), (2, 3), (6, 3), (6, 4)]


def test_intervals_of_empty_sides(spark):
    held = spark.createDataFrame(episodes(1), "id long, station long, lo timestamp_ntz, hi timestamp_ntz")
    assert interval_join(frame(spark, []), held, "ts", "lo", "hi").count() == 0
    assert interval_join(frame(spark, MISSING), held.limit(0), "ts", "lo", "hi", how="left").count() == 3


def test_a_hot_cell_makes_no_needless_pairs(spark):
    """A third of the points at one time, and as many intervals just after it: none meets in the join."""
    points = spark.createDataFrame([(i, at(600)) for i in range(2000)], "id long, ts timestamp_ntz")
    spans = [(i, at(600) + datetime.timedelta(seconds=2), at(600) + datetime.timedelta(seconds=5 + i % 50)) for i in range(2000)]
    held = spark.createDataFrame(spans, "id long, lo timestamp_ntz, hi timestamp_ntz")
    extra = spark.createDataFrame([(9999, at(900))], "id long, ts timestamp_ntz")
    got = interval_join(points.unionByName(extra), held, "ts", "lo", "hi")
    assert got.collect() == []
    joins = _rows_of(got, "Join")
    assert joins and max(joins) == 0


@pytest.mark.parametrize("by", [(), ("station",)])
@pytest.mark.parametrize("closed", ["left", "both"])
def test_interval_totals(spark, by, closed):
    points, spans = readings(120, 7), episodes(8)
    points.append((8000, 0, T0 + datetime.timedelta(seconds=36000.5), 0.0))
    held = spark.createDataFrame(spans, "id long, station long, lo timestamp_ntz, hi timestamp_ntz").repartition(3)
    want = {p[0]: [] for p in points}
    for point, span in brute_intervals(points, spans, bool(by), closed):
        want[point].append(span)
    totals = {"n": ("count", "id"), "least": ("min", "id"), "most": ("max", "id"), "all": ("sum", "id")}
    got = interval_totals(frame(spark, points), held, "ts", "lo", "hi", totals, by, closed)
    assert {r.id: (r.n, r.least, r.most, r["all"]) for r in got.collect()} == {
        i: (len(x), min(x), max(x), sum(x)) if x else (0, None, None, None) for i, x in want.items()
    }
    assert got.count() == len(points)


def test_interval_totals_make_no_pairs(spark):
    """2,000 intervals hold each of 2,000 points: four million pairs, of which the totals make none."""
    points = spark.createDataFrame([(i, at(600 + i)) for i in range(2000)], "id long, ts timestamp_ntz")
    spans = [(i, at(i % 600), at(3000 + i % 7)) for i in range(2000)]
    held = spark.createDataFrame(spans, "id long, lo timestamp_ntz, hi timestamp_ntz")
    got = interval_totals(points, held, "ts", "lo", "hi", {"n": ("count", "id")})
    assert got.where("n <> 2000").count() == 0
    got.collect()
    joins = _rows_of(got, "Join")
    assert joins and max(joins) <= 2000 * 22


def test_episode_overlap_makes_no_pairs(spark):
    from airseries.checks.joins import episode_overlap

    got = episode_overlap(spark, "/root/testdata/sf0.01")
    got.collect()
    joins = _rows_of(got, "Join")
    # 10,000 readings look into at most 22 cells each; they lie in about two hundred thousand and more episodes.
    assert joins and max(joins) <= 22 * 10_000
    assert got.agg(F.sum("episodes")).first()[0] > 0


def _rows_of(df, kind):
    """Output rows of the operators whose name holds ``kind``, in the plan that ran."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if kind in node.nodeName():
            out.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def brute_sessions(rows, by, gap):
    out, number, before = {}, -1, None
    order = lambda r: ((r[1] is not None, r[1]) if by else (), r[2], r[0])
    for r in sorted((r for r in rows if r[2] is not None), key=order):
        key = r[1] if by else 0
        if before is None or before[0] != key or (r[2] - before[1]).total_seconds() > gap:
            number += 1
        out[r[0]] = number
        before = (key, r[2])
    return out


@pytest.mark.parametrize("by", [(), ("station",)])
@pytest.mark.parametrize("gap", [0, 300, 10**6])
@pytest.mark.parametrize("rows_per_tile", [13, 10**6])
def test_sessions(spark, by, gap, rows_per_tile):
    rows = readings(150, 11)
    got = with_sessions(frame(spark, rows), "ts", "id", gap, by, rows_per_tile=rows_per_tile).collect()
    want = brute_sessions(rows, by, gap)
    assert {r.id: r.session for r in got} == {r[0]: want.get(r[0]) for r in rows}


def test_session_table(spark):
    rows = readings(150, 12)
    got = sessions(frame(spark, rows), "ts", "id", 120, ["station"], {"top": F.max("v")}, rows_per_tile=10).collect()
    held = {}
    for row, number in ((r, brute_sessions(rows, True, 120).get(r[0])) for r in rows):
        if number is not None:
            held.setdefault(number, []).append(row)
    want = {
        n: (rs[0][1], min(r[2] for r in rs), max(r[2] for r in rs), len(rs), max(r[3] for r in rs)) for n, rs in held.items()
    }
    assert {r.session: (r.station, r.first, r["last"], r.rows, r.top) for r in got} == want


def test_no_sessions(spark):
    assert with_sessions(frame(spark, []), "ts", "id", 5).count() == 0
    assert [r.session for r in with_sessions(frame(spark, MISSING[:1]), "ts", "id", 5).collect()] == [None]


def test_readings_look_into_few_cells(spark, monkeypatch):
    """Each level of cells is a row more for every reading; a month needs fewer of hours than of seconds (nine)."""
    from airseries.checks import joins
    from airseries.operators import intervals

    levels = []
    cells = intervals._cells_of_level
    monkeypatch.setattr(intervals, "_cells_of_level", lambda k, top: levels.append(k) or cells(k, top))
    joins.readings_in_episodes(spark, "/root/testdata/sf0.01")
    assert 0 < len(levels) <= 6
