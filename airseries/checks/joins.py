"""Queries on as-of joins, interval joins, sessions and streamed alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.checks.fixture import R, readings, table
from airseries.checks.registry import big, query, r6, rounded
from airseries.operators.asof import asof_join
from airseries.operators.intervals import interval_join, interval_totals
from airseries.operators.sessions import sessions, with_sessions
from airseries.session import stage_path
from airseries.streaming.alerts import alerts, read_arriving, write_alerts


@query(
    "asof_other_station",
    f"""WITH {R}, m AS (SELECT l.event_id, max({{'t': o.ts, 'i': o.event_id}}) AS x
        FROM r l JOIN r o ON o.ts < l.ts AND o.ts >= l.ts - INTERVAL 2 HOUR AND o.station <> l.station
        GROUP BY l.event_id)
    SELECT r.event_id, m.x.i AS other_id, o.station AS other_station, round(o.pm + 1e-9, 6) AS other_pm
    FROM r LEFT JOIN m ON m.event_id = r.event_id LEFT JOIN r o ON o.event_id = m.x.i""",
)
def asof_other_station(spark: SparkSession, sf: str) -> DataFrame:
    # The last earlier reading of any other station, at most two hours back.
    df = readings(spark, sf).select("event_id", "ts", "station", "pm")
    found = asof_join(
        df, df, "ts", "event_id", other_than="station", allow_exact=False, tolerance=7200, prefix="other_"
    )
    return found.select("event_id", F.col("other_event_id").alias("other_id"), "other_station", r6("other_pm"))


@query(
    "asof_last_value",
    f"""WITH {R}, w AS (SELECT *, max(CASE WHEN pm IS NOT NULL THEN {{'t': ts, 'i': event_id, 'v': pm}} END)
        OVER (PARTITION BY station ORDER BY ts RANGE UNBOUNDED PRECEDING) AS x FROM r)
    SELECT event_id, station, x.i AS last_id, round(x.v + 1e-9, 6) AS last_pm FROM w WHERE pm IS NULL""",
)
def asof_last_value(spark: SparkSession, sf: str) -> DataFrame:
    # A reading without a value takes the last one of its station.
    df = readings(spark, sf).select("event_id", "ts", "station", "pm")
    found = asof_join(df.where("pm IS NULL"), df.where("pm IS NOT NULL"), "ts", "event_id", ["station"], prefix="last_")
    return found.select("event_id", "station", F.col("last_event_id").alias("last_id"), r6("last_pm"))


@query(
    "asof_nearest",
    f"""WITH {R}, n AS (SELECT l.event_id, min({{'d': abs(epoch_us(o.ts) - epoch_us(l.ts)), 'later': o.ts > l.ts,
            'i': CASE WHEN o.ts > l.ts THEN o.event_id ELSE -o.event_id END}}) AS x
        FROM r l JOIN r o ON o.station = l.station AND o.pm IS NOT NULL WHERE l.pm IS NULL GROUP BY l.event_id)
    SELECT r.event_id, abs(n.x.i) AS near_id, CAST(n.x.d AS BIGINT) AS distance
    FROM r LEFT JOIN n ON n.event_id = r.event_id WHERE r.pm IS NULL""",
)
def asof_nearest(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf).select("event_id", "ts", "station", "pm")
    found = asof_join(
        df.where("pm IS NULL"), df.where("pm IS NOT NULL"), "ts", "event_id", ["station"], direction="nearest", prefix="near_"
    )
    distance = F.abs(F.timestamp_diff("MICROSECOND", F.col("near_ts"), F.col("ts")))
    return found.select("event_id", F.col("near_event_id").alias("near_id"), distance.alias("distance"))


# Every sign-up opens an episode at its station that lasts as many hours as its counter says; a
# tenth of them have no end, some are empty.
_EPISODES = f"""WITH {R}, ep AS (SELECT event_id AS episode, user_id AS station, ts AS lo,
        CASE WHEN event_id % 10 <> 0
             THEN ts + to_hours(CAST(json_extract_string(props, '$.k') AS INTEGER)) END AS hi
        FROM events WHERE event_type = 'signup')"""


def _episodes(spark: SparkSession, sf: str) -> DataFrame:
    hours = F.get_json_object("props", "$.k").cast("int")
    hi = F.col("ts") + F.make_interval(hours=hours)
    return (
        table(spark, sf, "events")
        .where("event_type = 'signup'")
        .select(
            F.col("event_id").alias("episode"),
            F.col("user_id").alias("station"),
            F.col("ts").alias("lo"),
            F.when(F.col("event_id") % 10 != 0, hi).alias("hi"),
        )
    )


@query(
    "readings_in_episodes",
    f"""{_EPISODES} SELECT r.event_id, ep.episode, round(r.pm + 1e-9, 6) AS pm FROM r JOIN ep
        ON ep.station = r.station AND r.ts >= ep.lo AND (ep.hi IS NULL OR r.ts <= ep.hi)""",
)
def readings_in_episodes(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf).select("event_id", "ts", "station", "pm")
    # Episodes last whole hours, so cells of an hour fit them; smaller ones would only be more rows a reading and episode.
    found = interval_join(
        df, _episodes(spark, sf), "ts", "lo", "hi", ["station"], closed="both", cell_seconds=3600, prefix="in_"
    )
    return found.select("event_id", F.col("in_episode").alias("episode"), r6("pm"))


@query(
    "episode_overlap",
    f"""{_EPISODES} SELECT r.event_id, count(ep.episode) AS episodes, min(ep.episode) AS first_episode FROM r
        LEFT JOIN ep ON r.ts >= ep.lo AND r.ts < ep.hi AND ep.hi IS NOT NULL AND ep.episode % 7 = 0 GROUP BY r.event_id""",
)
def episode_overlap(spark: SparkSession, sf: str) -> DataFrame:
    # Of any station; readings in no episode stay. Episodes of all stations overlap, so there is no row for each pair.
    some = _episodes(spark, sf).where("hi IS NOT NULL AND episode % 7 = 0")
    df = readings(spark, sf).select("event_id", "ts")
    totals = {"episodes": ("count", "episode"), "first_episode": ("min", "episode")}
    found = interval_totals(df, some, "ts", "lo", "hi", totals)
    return found.groupBy("event_id").agg(F.sum("episodes").alias("episodes"), F.min("first_episode").alias("first_episode"))


_SESSIONS = f"""WITH {R}, g AS (SELECT *, CASE WHEN lag(ts) OVER o IS NULL OR ts - lag(ts) OVER o > INTERVAL 6 HOUR
        THEN 1 ELSE 0 END AS starts FROM r WINDOW o AS (PARTITION BY station ORDER BY ts, event_id)),
    n AS (SELECT *, CAST(sum(starts) OVER (ORDER BY station, ts, event_id) AS BIGINT) - 1 AS session FROM g)"""


@query("session_rows", f"{_SESSIONS} SELECT event_id, session FROM n")
def session_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf).select("event_id", "ts", "station")
    return with_sessions(df, "ts", "event_id", 6 * 3600, ["station"]).select("event_id", "session")


@query(
    "session_table",
    f"""{_SESSIONS} SELECT session, station, min(ts) AS first, max(ts) AS last, count(*) AS rows,
        round(max(pm) + 1e-9, 6) AS peak, count(pm) AS measured FROM n GROUP BY session, station""",
)
def session_table(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf).select("event_id", "ts", "station", "pm")
    found = sessions(
        df, "ts", "event_id", 6 * 3600, ["station"], {"peak": F.max("pm"), "measured": F.count("pm")}, rows_per_tile=5000
    )
    return rounded(found)


# Closed episodes: the last reading came a day and more after their end.
@query(
    "stream_alerts",
    f"""WITH {R}, over_it AS (SELECT * FROM r WHERE pm > 60),
    g AS (SELECT *, CASE WHEN lag(ts) OVER o IS NULL OR ts - lag(ts) OVER o > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS starts
          FROM over_it WINDOW o AS (PARTITION BY station ORDER BY ts)),
    n AS (SELECT *, sum(starts) OVER (PARTITION BY station ORDER BY ts ROWS UNBOUNDED PRECEDING) AS episode FROM g)
    SELECT station, min(ts) AS first, max(ts) AS last, count(*) AS readings, round(max(pm) + 1e-9, 6) AS peak
    FROM n GROUP BY station, episode
    HAVING max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) FROM r) - INTERVAL 1 DAY""",
)
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    events = read_arriving(spark, f"{sf}/events*.parquet", spark.read.parquet(f"{sf}/events.parquet").schema)
    value = F.when(F.col("event_type") != "error", F.col("value"))
    arriving = events.select("event_id", "ts", F.col("user_id").alias("station"), value.alias("pm"))
    found = alerts(arriving, "pm", 60, by=["station"], gap="12 hours", delay="1 day", row_id="event_id")
    out = stage_path(spark, "alerts")
    write_alerts(found, out, stage_path(spark, "alerts-checkpoint")).awaitTermination()
    written = spark.read.schema(found.schema).parquet(out)
    # The session time zone is where times without a zone became instants.
    return written.select(
        "station",
        F.col("first").cast("timestamp_ntz").alias("first"),
        F.col("last").cast("timestamp_ntz").alias("last"),
        big("readings"),
        r6("peak"),
    )
