"""Queries on row frames, time-range frames, one-hot columns, splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.checks.fixture import (
    BAND,
    FEATURE_SELECT,
    FILLED,
    K,
    R,
    features_sql,
    filled,
    raw_readings,
    readings,
    table,
)
from airseries.checks.registry import big, query, r6, rounded
from airseries.functions.bands import band
from airseries.functions.naming import slug
from airseries.functions.numeric import safe_ratio
from airseries.operators import clean, sampling
from airseries.operators.encode import one_hot
from airseries.operators.ordering import with_row_index
from airseries.operators.temporal import (
    difference,
    lag,
    range_mean,
    rolling_mean,
    with_row_frames,
)
from airseries.plans.readings import CATEGORIES, build_features, prepare

ORDER = ["ts", "event_id"]


@query(
    "row_index",
    f"WITH {R} SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM r",
)
def row_index(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf).select("event_id", "ts")
    return with_row_index(df, ORDER, "row_index").select("event_id", "row_index")


@query(
    "rolling_means",
    f"""WITH {FILLED} SELECT event_id,
        round(avg(pm) OVER (ORDER BY ts, event_id ROWS 2 PRECEDING) + 1e-9, 6) AS pm_3,
        round(avg(pm) OVER (ORDER BY ts, event_id ROWS 5 PRECEDING) + 1e-9, 6) AS pm_6,
        round(avg(pm) OVER (ORDER BY ts, event_id ROWS 11 PRECEDING) + 1e-9, 6) AS pm_12,
        round(avg(pm) OVER (ORDER BY ts, event_id ROWS 23 PRECEDING) + 1e-9, 6) AS pm_24,
        round(avg(temp) OVER (ORDER BY ts, event_id ROWS 23 PRECEDING) + 1e-9, 6) AS temp_24
        FROM f""",
)
def rolling_means(spark: SparkSession, sf: str) -> DataFrame:
    frames = {f"pm_{n}": rolling_mean("pm", n) for n in (3, 6, 12, 24)}
    frames["temp_24"] = rolling_mean("temp", 24)
    df = filled(spark, sf).select("event_id", "ts", "pm", "temp")
    return rounded(with_row_frames(df, frames, ORDER).select("event_id", *frames))


@query(
    "lags_and_diffs",
    f"""WITH {FILLED}, w AS (SELECT event_id, pm, lag(pm, 1) OVER o AS l1, lag(pm, 3) OVER o AS l3,
        lag(pm, 24) OVER o AS l24, lag(temp, 6) OVER o AS t6
        FROM f WINDOW o AS (ORDER BY ts, event_id))
    SELECT event_id, round(l1 + 1e-9, 6) AS lag_1, round(l3 + 1e-9, 6) AS lag_3,
        round(l24 + 1e-9, 6) AS lag_24, round(t6 + 1e-9, 6) AS temp_lag_6,
        round(pm - l1 + 1e-9, 6) AS diff_1, round(pm - l24 + 1e-9, 6) AS diff_24 FROM w""",
)
def lags_and_diffs(spark: SparkSession, sf: str) -> DataFrame:
    frames = {f"lag_{k}": lag("pm", k) for k in (1, 3, 24)}
    frames["temp_lag_6"] = lag("temp", 6)
    frames.update({f"diff_{k}": difference("pm", k) for k in (1, 24)})
    df = filled(spark, sf).select("event_id", "ts", "pm", "temp")
    return rounded(with_row_frames(df, frames, ORDER).select("event_id", *frames))


@query(
    "trend",
    f"""WITH {FILLED}, w AS (SELECT event_id, temp, avg(pm) OVER (ORDER BY ts, event_id ROWS 2 PRECEDING) AS a,
        avg(pm) OVER (ORDER BY ts, event_id ROWS 23 PRECEDING) AS b,
        avg(temp) OVER (ORDER BY ts, event_id ROWS 23 PRECEDING) AS c FROM f)
    SELECT event_id, round(CASE WHEN b <> 0 THEN a / b ELSE 1 END + 1e-9, 6) AS trend,
        round(temp - c + 1e-9, 6) AS deviation FROM w""",
)
def trend(spark: SparkSession, sf: str) -> DataFrame:
    frames = {
        "short": rolling_mean("pm", 3),
        "long": rolling_mean("pm", 24),
        "mean": rolling_mean("temp", 24),
    }
    df = filled(spark, sf).select("event_id", "ts", "pm", "temp")
    return with_row_frames(df, frames, ORDER).select(
        "event_id",
        r6(safe_ratio("short", "long", 1.0), "trend"),
        r6(F.col("temp") - F.col("mean"), "deviation"),
    )


_BY_STATION = f"""WITH {FILLED} SELECT event_id, station,
    round(avg(pm) OVER (PARTITION BY station ORDER BY ts, event_id ROWS 5 PRECEDING) + 1e-9, 6) AS pm_6,
    round(lag(pm, 2) OVER (PARTITION BY station ORDER BY ts, event_id) + 1e-9, 6) AS lag_2 FROM f"""


@query("rolling_by_station", _BY_STATION)
def rolling_by_station(spark: SparkSession, sf: str) -> DataFrame:
    frames = {"pm_6": rolling_mean("pm", 6), "lag_2": lag("pm", 2)}
    df = filled(spark, sf).select("event_id", "ts", "station", "pm")
    out = with_row_frames(df, frames, ORDER, by=["station"])
    return rounded(out.select("event_id", "station", *frames))


@query("rolling_by_station_blocks", _BY_STATION)
def rolling_by_station_blocks(spark: SparkSession, sf: str) -> DataFrame:
    # Small tiles cut the series, and frames reach over their edges.
    frames = {"pm_6": rolling_mean("pm", 6), "lag_2": lag("pm", 2)}
    df = filled(spark, sf).select("event_id", "ts", "station", "pm")
    out = with_row_frames(df, frames, ORDER, by=["station"], rows_per_tile=1000)
    return rounded(out.select("event_id", "station", *frames))


@query(
    "rolling_time_range",
    f"""WITH {FILLED} SELECT event_id, round(avg(pm) OVER (ORDER BY ts
        RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW) + 1e-9, 6) AS pm_3h FROM f""",
)
def rolling_time_range(spark: SparkSession, sf: str) -> DataFrame:
    out = range_mean(filled(spark, sf), "pm", 3, "ts", "event_id", out="pm_3h")
    return rounded(out.select("event_id", "pm_3h"))


_RANGE_BY_STATION = f"""WITH {FILLED} SELECT event_id, station, round(avg(pm) OVER (PARTITION BY station
    ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) + 1e-9, 6) AS pm_24h FROM f"""


@query("time_range_by_station", _RANGE_BY_STATION)
def time_range_by_station(spark: SparkSession, sf: str) -> DataFrame:
    df = filled(spark, sf)
    out = range_mean(df, "pm", 24, "ts", "event_id", ["station"], "pm_24h")
    return rounded(out.select("event_id", "station", "pm_24h"))


@query("time_range_by_station_sums", _RANGE_BY_STATION)
def time_range_by_station_sums(spark: SparkSession, sf: str) -> DataFrame:
    # The same rows, with an infinite value and a NaN added to every station, which are missing.
    df = filled(spark, sf).select("event_id", "ts", "station", "pm")
    odd = df.select(
        (-F.col("event_id") - 1).alias("event_id"),
        "ts",
        "station",
        F.when(F.col("event_id") % 2 == 0, float("inf")).otherwise(float("nan")).alias("pm"),
    )
    out = range_mean(df.union(odd), "pm", 24, "ts", "event_id", ["station"], "pm_24h")
    return rounded(out.filter("event_id >= 0").select("event_id", "station", "pm_24h"))


@query(
    "warmup_filter",
    f"""WITH {FILLED}, w AS (SELECT event_id, lag(pm, 24) OVER (ORDER BY ts, event_id) AS lag_24,
        avg(pm) OVER (ORDER BY ts, event_id ROWS 23 PRECEDING) AS mean_24 FROM f)
    SELECT event_id, round(lag_24 + 1e-9, 6) AS lag_24 FROM w
    WHERE lag_24 IS NOT NULL AND mean_24 IS NOT NULL""",
)
def warmup_filter(spark: SparkSession, sf: str) -> DataFrame:
    frames = {"lag_24": lag("pm", 24), "mean_24": rolling_mean("pm", 24)}
    df = with_row_frames(filled(spark, sf).select("event_id", "ts", "pm"), frames, ORDER)
    return clean.drop_warmup(df, "lag_24", "mean_24").select("event_id", r6("lag_24"))


@query(
    "one_hot",
    f"""WITH {K}, b AS (SELECT event_id, direction, {BAND.format(x='pm')} AS band FROM k)
    SELECT event_id, """
    + ", ".join(
        f"CAST(coalesce(direction = '{d}', FALSE) AS BIGINT) AS wind_{d}"
        for d in ("click", "view", "purchase")
    )
    + ", "
    + ", ".join(
        f"CAST(band = '{label}' AS BIGINT) AS aqi_{name}"
        for label, name in (
            ("Good", "good"),
            ("Moderate", "moderate"),
            ("Unhealthy for Sensitive Groups", "unhealthy_sensitive"),
            ("Unhealthy", "unhealthy"),
            ("Very Unhealthy", "very_unhealthy"),
            ("Hazardous", "hazardous"),
        )
    )
    + " FROM b",
)
def one_hot_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.drop_missing(readings(spark, sf), "pm")
    df = df.select("event_id", "direction", band("pm").alias("band"))
    df = one_hot(df, "direction", ["click", "view", "purchase"], "wind")
    df = one_hot(df, "band", CATEGORIES, "aqi", slug)
    return rounded(df.drop("direction", "band"))


@query("feature_table", f"WITH {features_sql()} {FEATURE_SELECT}")
def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(build_features(prepare(raw_readings(spark, sf)), keep=["No"]))


@query("feature_table_causal", f"WITH {features_sql(1)} {FEATURE_SELECT}")
def feature_table_causal(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(build_features(prepare(raw_readings(spark, sf)), causal=True, keep=["No"]))


@query(
    "split_by_quantile",
    f"""WITH {K}, c AS (SELECT quantile_disc(ts, 0.8) AS cut FROM k)
    SELECT event_id, CASE WHEN ts < cut THEN 'train' ELSE 'test' END AS split FROM k, c""",
)
def split_by_quantile(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.drop_missing(readings(spark, sf), "pm")
    return sampling.temporal_split(df, "ts", 0.8).select("event_id", "split")


@query(
    "split_by_row",
    f"""WITH {K}, n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i,
        count(*) OVER () AS n FROM k)
    SELECT event_id, CASE WHEN i < floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM n""",
)
def split_by_row(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.drop_missing(readings(spark, sf), "pm").select("event_id", "ts")
    return sampling.positional_split(df, ORDER, 0.8).select("event_id", "split")


_HASH = "(((event_id % 2147483647) * 2654435761) % 4294967296) / 4294967296.0e0"


@query("hash_sample", f"SELECT event_id, value FROM events WHERE {_HASH} < 0.1")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "value")
    return sampling.hash_sample(events, "event_id", 0.1)


@query(
    "hash_split",
    f"SELECT event_id, CASE WHEN {_HASH} < 0.8 THEN 'train' ELSE 'test' END AS split FROM events",
)
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id")
    return sampling.hash_split(events, "event_id", 0.8)


@query("random_sample")
def random_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.bernoulli_sample(table(spark, sf, "events"), 0.1, 42).select(
        "event_id", "value"
    )


@query(
    "random_split",
    "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_ids FROM events",
)
def random_split(spark: SparkSession, sf: str) -> DataFrame:
    # The parts themselves depend on the layout; that they share no row does not.
    train, test = sampling.random_split(table(spark, sf, "events").select("event_id"))
    return train.union(test).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_ids")
    )


@query(
    "top_k",
    f"""WITH {K} SELECT event_id, round(pm + 1e-9, 6) AS pm FROM k
        ORDER BY k.pm DESC, event_id LIMIT 20""",
)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.drop_missing(readings(spark, sf), "pm")
    return df.orderBy(F.desc("pm"), "event_id").limit(20).select("event_id", r6("pm"))


@query(
    "top_stations",
    f"""WITH {K} SELECT station, count(*) AS n FROM k GROUP BY station
        ORDER BY n DESC, station LIMIT 15""",
)
def top_stations(spark: SparkSession, sf: str) -> DataFrame:
    counts = (
        clean.drop_missing(readings(spark, sf), "pm")
        .groupBy("station")
        .agg(big(F.count(F.lit(1)), "n"))
    )
    return counts.orderBy(F.desc("n"), "station").limit(15)
