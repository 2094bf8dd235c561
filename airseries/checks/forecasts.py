"""Queries on folds along time, horizons, quantile models and the error cube."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.checks.fixture import BAND, FILLED, K, filled, readings
from airseries.checks.registry import big, query, r6, rounded
from airseries.functions.bands import band
from airseries.operators.folds import (
    cross_validate,
    group_means,
    horizon_metrics,
    in_folds,
    time_folds,
    with_horizons,
)
from airseries.operators.metrics import error_cube, pinball_loss
from airseries.operators.quantile_regression import quantile_regression
from airseries.operators.temporal import centred, lag, rolling_mean, with_row_frames
from airseries.session import stage

# Four folds, training on the last two blocks, six hours left out before each cut.
_FOLDS = f"""WITH {K},
q AS (SELECT quantile_disc(ts, 0.2) AS c1, quantile_disc(ts, 0.4) AS c2, quantile_disc(ts, 0.6) AS c3,
             quantile_disc(ts, 0.8) AS c4 FROM k),
fold AS (SELECT 1 AS fold, NULL AS start, c1 AS cut, c2 AS finish FROM q UNION ALL SELECT 2, NULL, c2, c3 FROM q
         UNION ALL SELECT 3, c1, c3, c4 FROM q UNION ALL SELECT 4, c2, c4, NULL FROM q),
p AS (SELECT k.*, fold, CASE WHEN ts < cut THEN 'train' ELSE 'test' END AS role FROM k JOIN fold
      ON (ts < cut - INTERVAL 6 HOUR AND (start IS NULL OR ts >= start)) OR (ts >= cut AND (finish IS NULL OR ts < finish)))"""


def _known(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf).where("pm IS NOT NULL").select("event_id", "ts", "station", "pm")


@query(
    "fold_parts",
    f"""{_FOLDS} SELECT CAST(fold AS BIGINT) AS fold, role, count(*) AS n, min(ts) AS first, max(ts) AS last,
        round(avg(pm) + 1e-9, 6) AS mean_pm FROM p GROUP BY fold, role""",
)
def fold_parts(spark: SparkSession, sf: str) -> DataFrame:
    df = _known(spark, sf)
    parts = in_folds(df, "ts", time_folds(df, "ts", 4, window=2, gap=6 * 3600))
    found = parts.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.avg("pm").alias("mean_pm")
    )
    return rounded(found)


@query(
    "fold_metrics",
    f"""{_FOLDS}, m AS (SELECT fold, hour(ts) AS h, avg(pm) AS said FROM p WHERE role = 'train' GROUP BY fold, h),
    e AS (SELECT p.fold, p.pm, m.said FROM p JOIN m ON m.fold = p.fold AND m.h = hour(p.ts) WHERE role = 'test')
    SELECT CAST(fold AS BIGINT) AS fold, count(*) AS n, round(sqrt(avg(pow(pm - said, 2))) + 1e-9, 6) AS rmse,
        round(avg(abs(pm - said)) + 1e-9, 6) AS mae,
        round(1 - avg(pow(pm - said, 2)) / var_pop(pm) + 1e-9, 6) AS r2 FROM e GROUP BY fold""",
)
def fold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    # The usual day as the model: the mean of the hour, of training rows only.
    df = _known(spark, sf).withColumn("hour", F.hour("ts"))
    folds = time_folds(df, "ts", 4, window=2, gap=6 * 3600)
    return rounded(cross_validate(df, "ts", folds, group_means("pm", ["hour"]), "pm"))


_AHEAD = [1, 6, 12, 24]


@query(
    "horizon_errors",
    f"""WITH {K}, w AS (SELECT pm, avg(pm) OVER (PARTITION BY station ORDER BY ts, event_id ROWS 5 PRECEDING) AS said,
        {", ".join(f"lead(pm, {h}) OVER o AS y{h}" for h in _AHEAD)}
        FROM k WINDOW o AS (PARTITION BY station ORDER BY ts, event_id)),
    e AS ({" UNION ALL ".join(f"SELECT {h} AS horizon, pm, said, y{h} AS y FROM w" for h in _AHEAD)})
    SELECT CAST(horizon AS BIGINT) AS horizon, count(y) AS n, round(sqrt(avg(pow(y - said, 2))) + 1e-9, 6) AS rmse,
        round(avg(abs(y - said)) + 1e-9, 6) AS mae,
        round(1 - avg(pow(y - said, 2)) / var_pop(y) + 1e-9, 6) AS r2,
        round(avg(CASE WHEN y <> 0 THEN abs(y - said) / abs(y) END) + 1e-9, 6) AS mape,
        round(avg(CASE WHEN y IS NOT NULL THEN CASE WHEN sign(y - pm) = sign(said - pm) THEN 1.0 ELSE 0.0 END END) + 1e-9, 6) AS direction
    FROM e GROUP BY horizon""",
)
def horizon_errors(spark: SparkSession, sf: str) -> DataFrame:
    # The mean of the last six readings of a station as forecast of those to come.
    frames = {"said": rolling_mean("pm", 6)}
    df = with_horizons(_known(spark, sf), "pm", _AHEAD, ["ts", "event_id"], ["station"], frames, rows_per_tile=5000)
    return rounded(horizon_metrics(df, "pm", _AHEAD, "said"))


@query(
    "centred_means",
    f"""WITH {FILLED} SELECT event_id,
        round(avg(pm) OVER (ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) + 1e-9, 6) AS pm_25,
        round(max(pm) OVER (ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) + 1e-9, 6) AS peak_7 FROM f""",
)
def centred_means(spark: SparkSession, sf: str) -> DataFrame:
    df = filled(spark, sf).select("event_id", "ts", "pm")
    frames = {"pm_25": centred("pm", 12), "peak_7": centred("pm", 3, F.max)}
    return rounded(with_row_frames(df, frames, ["ts", "event_id"], rows_per_tile=1000).select("event_id", *frames))


_Q = [0.1, 0.5, 0.9]


@query(
    "quantile_forecasts",
    f"""WITH {FILLED}, c AS (SELECT {", ".join(f"quantile_disc(pm, {q}) AS q{i}" for i, q in enumerate(_Q))} FROM f)
    {" UNION ALL ".join(
        f'''SELECT CAST({q} AS DOUBLE) AS quantile, count(*) AS n,
            round(avg(greatest({q}e0 * (pm - q{i}), ({q}e0 - 1) * (pm - q{i}))) + 1e-9, 6) AS loss,
            round(avg(CASE WHEN pm <= q{i} THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS covered, true AS line_covers,
            true AS line_no_worse FROM f, c''' for i, q in enumerate(_Q))}""",
)
def quantile_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    # The model without features is the quantile itself. A line with features covers its share of
    # rows exactly as well, and its loss is no greater than that of the model without.
    df = stage(filled(spark, sf).select("pm", "temp", F.hour("ts").cast("double").alias("hour")), "quantile-forecasts")
    scored = df
    plain = quantile_regression(df, "pm", [], _Q)
    lines = quantile_regression(df, "pm", ["temp", "hour"], _Q)
    for i, (alone, line) in enumerate(zip(plain, lines, strict=True)):
        scored = line.predict(alone.predict(scored, f"q{i}"), f"line{i}")
    alone = pinball_loss(scored, "pm", {q: f"q{i}" for i, q in enumerate(_Q)})
    lines = pinball_loss(scored, "pm", {q: f"line{i}" for i, q in enumerate(_Q)}).select(
        "quantile", F.col("loss").alias("_loss"), F.col("covered").alias("_covered")
    )
    off = F.abs(F.col("_covered") - F.col("quantile"))
    return alone.join(lines, "quantile").select(
        "quantile", "n", r6("loss"), r6("covered"),
        (off <= 1.0 / F.col("n") + 1e-9).alias("line_covers"),
        (F.col("_loss") <= F.col("loss") * (1 + 1e-4)).alias("line_no_worse"),
    )


@query(
    "error_subtotals",
    f"""WITH {FILLED}, w AS (SELECT {BAND.format(x="pm")} AS band, CAST(hour(ts) AS BIGINT) AS hour, direction,
        pm - lag(pm) OVER (PARTITION BY station ORDER BY ts, event_id) AS e FROM f)
    SELECT band, hour, direction, grouping(band) = 1 AS band_all, grouping(hour) = 1 AS hour_all,
        grouping(direction) = 1 AS direction_all, count(*) AS n, round(avg(e) + 1e-9, 6) AS bias,
        round(avg(abs(e)) + 1e-9, 6) AS mae, round(sqrt(avg(e * e)) + 1e-9, 6) AS rmse,
        round(max(abs(e)) + 1e-9, 6) AS worst
    FROM w WHERE e IS NOT NULL GROUP BY CUBE (band, hour, direction)""",
)
def error_subtotals(spark: SparkSession, sf: str) -> DataFrame:
    df = filled(spark, sf).select("event_id", "ts", "station", "direction", "pm")
    df = with_row_frames(df, {"said": lag("pm", 1)}, ["ts", "event_id"], ["station"])
    df = df.withColumns({"band": band("pm"), "hour": big(F.hour("ts"))})
    return rounded(error_cube(df, "pm", "said", ["band", "hour", "direction"]))

