"""Streamed alerts: any order of files, late readings, repeated deliveries, restarts."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from airseries.streaming.alerts import alerts, read_arriving, write_alerts

T0 = datetime.datetime(2024, 3, 1)
SCHEMA = "id long, station long, ts timestamp, v double"


def at(minutes):
    return None if minutes is None else T0 + datetime.timedelta(minutes=minutes)


def readings(n, seed):
    """A third of the readings at one station; some without value or time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        value = rng.choice([None, float("nan"), 10.0, 90.0, 120.0, 100.0, 100.5])
        rows.append((i, 0 if rng.random() < 0.34 else rng.choice([None, 1, 2, 3]), at(i * 7 + rng.randrange(40)), value))
    return [*rows, (n, 1, None, 500.0)]


def brute(rows, gap, closed_at=None):
    held = {}
    for _, station, ts, v in rows:
        if ts is not None and v is not None and v > 100:
            held.setdefault(station, []).append((ts, v))
    out = []
    for station, own in held.items():
        own.sort()
        episode = [own[0]]
        for reading in [*own[1:], None]:
            if reading and reading[0] - episode[-1][0] <= gap:
                episode.append(reading)
                continue
            if closed_at is None or episode[-1][0] + gap <= closed_at:
                out.append((station, episode[0][0], episode[-1][0], len(episode), max(v for _, v in episode)))
            episode = [reading]
    return sorted(out, key=repr)


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def take_in(spark, folder, out, checkpoint, **how):
    stream = read_arriving(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    settings = {"gap": "30 minutes", "delay": "6 hours", "by": ["station"], "row_id": "id"} | how
    found = alerts(stream, "v", 100, **settings)
    write_alerts(found, str(out), str(checkpoint)).awaitTermination()
    rows = spark.read.schema(found.schema).parquet(str(out)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


GAP, DELAY = datetime.timedelta(minutes=30), datetime.timedelta(hours=6)


@pytest.mark.parametrize("seed", [1, 2])
def test_files_in_any_order_with_restarts(spark, tmp_path, seed):
    """Slices of three hours, neighbours swapped, every tenth reading one slice late, some delivered twice."""
    rows = readings(300, seed)
    rng = random.Random(seed)
    slices = [[] for _ in range(14)]
    for r in rows:
        k = 0 if r[2] is None else int((r[2] - T0).total_seconds() // (3 * 3600))
        slices[min(13, k + (r[0] % 10 == 0))].append(r)
    for k in range(0, 13, 2):
        slices[k], slices[k + 1] = slices[k + 1], slices[k]
    for own in slices:
        rng.shuffle(own)
        own += own[:3]
    got = []
    for part in (slices[:5], slices[5:9], slices[9:]):
        for own in part:
            land(spark, tmp_path / "in", own)
        got = take_in(spark, tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint")
    watermark = max(r[2] for r in rows if r[2]) - DELAY
    want = brute(rows, GAP, watermark)
    assert len(want) > 5
    assert got == want


def test_nothing_is_given_out_twice(spark, tmp_path):
    rows = readings(120, 3)
    land(spark, tmp_path / "in", rows)
    first = take_in(spark, tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint")
    again = take_in(spark, tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint")
    assert first and first == again


def test_a_reading_that_is_too_late_is_dropped(spark, tmp_path):
    land(spark, tmp_path / "in", [(1, 1, at(0), 150.0), (2, 1, at(10), 10.0)])
    land(spark, tmp_path / "in", [(3, 1, at(60 * 24), 10.0)])
    first = take_in(spark, tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint")
    assert first == [(1, at(0), at(0), 1, 150.0)]
    land(spark, tmp_path / "in", [(4, 1, at(5), 300.0), (5, 1, at(60 * 23), 300.0)])
    land(spark, tmp_path / "in", [(6, 1, at(60 * 48), 10.0)])
    later = take_in(spark, tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint")
    assert later == [(1, at(0), at(0), 1, 150.0), (1, at(60 * 23), at(60 * 23), 1, 300.0)]


def test_readings_below_the_threshold_close_episodes(spark, tmp_path):
    land(spark, tmp_path / "in", [(1, 1, at(0), 150.0)])
    land(spark, tmp_path / "in", [(2, 2, at(60 * 24), None)])
    assert take_in(spark, tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint") == [(1, at(0), at(0), 1, 150.0)]


def test_batch(spark):
    rows = readings(200, 4)
    df = spark.createDataFrame([*rows, *rows[:20]], SCHEMA).withColumn("_over", F.lit("clash"))
    got = alerts(df, "v", 100, by=["station"], gap="30 minutes", row_id="id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, GAP)
