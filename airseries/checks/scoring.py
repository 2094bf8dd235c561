"""Queries on metrics, confusion matrices, comparisons and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.checks.fixture import BAND, FILLED, filled
from airseries.checks.registry import query, rounded
from airseries.functions.bands import band
from airseries.operators import metrics
from airseries.operators.runs import best_run, compare_runs, log_run, read_runs
from airseries.operators.sampling import hash_split, temporal_split
from airseries.operators.temporal import lag, rolling_mean, with_row_frames
from airseries.plans.readings import CATEGORIES
from airseries.session import stage, stage_path

ORDER = ["ts", "event_id"]

_FORECAST = f"""{FILLED},
w AS (SELECT event_id, ts, pm, avg(pm) OVER o24 AS mean_24, lag(pm, 1) OVER o AS lag_1,
             lag(pm, 24) OVER o AS lag_24
      FROM f WINDOW o AS (ORDER BY ts, event_id),
                    o24 AS (ORDER BY ts, event_id ROWS 23 PRECEDING)),
v AS (SELECT * FROM w WHERE lag_24 IS NOT NULL),
c AS (SELECT quantile_disc(ts, 0.8) AS cut FROM v),
s AS (SELECT v.*, CASE WHEN ts < cut THEN 'train' ELSE 'test' END AS split FROM v, c)"""


def _forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with the 24-row mean and two lags as forecasts, split by time."""
    frames = {"mean_24": rolling_mean("pm", 24), "lag_1": lag("pm", 1), "lag_24": lag("pm", 24)}
    df = filled(spark, sf).select("event_id", "ts", "pm")
    df = with_row_frames(df, frames, ORDER).filter(F.col("lag_24").isNotNull())
    return temporal_split(stage(df, "forecasts"), "ts", 0.8)


def _metrics_sql(p: str) -> str:
    return f"""count(*) AS n, round(sqrt(avg(pow(pm - {p}, 2))) + 1e-9, 6) AS rmse,
        round(avg(abs(pm - {p})) + 1e-9, 6) AS mae,
        round(1 - avg(pow(pm - {p}, 2)) / var_pop(pm) + 1e-9, 6) AS r2"""


@query(
    "baseline_metrics",
    f"WITH {_FORECAST} SELECT split, {_metrics_sql('mean_24')} FROM s GROUP BY split",
)
def baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = _forecasts(spark, sf)
    return rounded(metrics.regression_metrics(scored, "pm", "mean_24", by=["split"]))


@query(
    "baseline_forecast",
    f"""WITH {_FORECAST} SELECT event_id, ts, round(pm + 1e-9, 6) AS pm,
        round(mean_24 + 1e-9, 6) AS prediction, {BAND.format(x='pm')} AS category
        FROM s WHERE split = 'test'""",
)
def baseline_forecast(spark: SparkSession, sf: str) -> DataFrame:
    test = _forecasts(spark, sf).filter(F.col("split") == "test")
    return rounded(
        test.select(
            "event_id", "ts", "pm", F.col("mean_24").alias("prediction"), band("pm").alias("category")
        )
    )


@query(
    "model_comparison",
    f"""WITH {_FORECAST}
    SELECT 'mean of 24 rows' AS model, {_metrics_sql('mean_24')} FROM s WHERE split = 'test'
    UNION ALL SELECT 'last row', {_metrics_sql('lag_1')} FROM s WHERE split = 'test'
    UNION ALL SELECT 'row before 24', {_metrics_sql('lag_24')} FROM s WHERE split = 'test'""",
)
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    test = _forecasts(spark, sf).filter(F.col("split") == "test")
    names = {"mean of 24 rows": "mean_24", "last row": "lag_1", "row before 24": "lag_24"}
    return rounded(metrics.compare_predictions(test, "pm", names))


@query(
    "split_comparison",
    f"""WITH {_FORECAST}
    SELECT 'train' AS model, {_metrics_sql('lag_1')} FROM s WHERE split = 'train'
    UNION ALL SELECT 'test', {_metrics_sql('lag_1')} FROM s WHERE split = 'test'""",
)
def split_comparison(spark: SparkSession, sf: str) -> DataFrame:
    scored = _forecasts(spark, sf)
    tables = {
        part: metrics.regression_metrics(scored.filter(F.col("split") == part), "pm", "lag_1")
        for part in ("train", "test")
    }
    return rounded(metrics.compare_models(tables, "rmse"))


@query(
    "run_log",
    f"""WITH {_FORECAST}, l AS (
    SELECT 'mean of 24 rows' AS name, {_metrics_sql('mean_24')} FROM s WHERE split = 'test'
    UNION ALL SELECT 'last row', {_metrics_sql('lag_1')} FROM s WHERE split = 'test')
    SELECT name, rmse, mae, r2, CAST(rmse = min(rmse) OVER () AS BIGINT) AS is_best FROM l""",
)
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    test = _forecasts(spark, sf).filter(F.col("split") == "test")
    path = stage_path(spark, "runs")
    for name, column, hours in (("mean of 24 rows", "mean_24", 24), ("last row", "lag_1", 1)):
        log_run(
            spark, path, name, {"kind": "baseline", "rows": hours},
            metrics.regression_metrics(test, "pm", column),
        )
    runs = read_runs(spark, path)
    best = best_run(runs, "rmse").select("name").scalar()
    table = compare_runs(runs, ["rmse", "mae", "r2"], "rmse")
    is_best = (F.col("name") == best).cast("int")
    return rounded(table.select("name", "rmse", "mae", "r2", is_best.alias("is_best")))


_RULE = f"""{FILLED}, w AS (SELECT event_id, pm, lag(pm, 1) OVER (ORDER BY ts, event_id) AS before FROM f),
b AS (SELECT event_id, {BAND.format(x='pm')} AS label, {BAND.format(x='before')} AS prediction
      FROM w WHERE before IS NOT NULL)"""


def _rule_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Band of each row, predicted to be the band of the row before."""
    df = filled(spark, sf).select("event_id", "ts", "pm")
    df = with_row_frames(df, {"before": lag("pm", 1)}, ORDER).filter(F.col("before").isNotNull())
    return df.select("event_id", band("pm").alias("label"), band("before").alias("prediction"))


# The first band is left out of the list, so that its rows show as "other".
_CLASSES = ", ".join(f"('{c}')" for c in [*CATEGORIES[1:], "other"])


@query(
    "confusion_matrix",
    f"""WITH {_RULE}, cls(actual) AS (VALUES {_CLASSES})
    SELECT actual, """
    + ", ".join(
        f"count(*) FILTER (WHERE prediction = '{c}') AS \"pred_{c}\"" for c in CATEGORIES[1:]
    )
    + f""", count(*) FILTER (WHERE prediction NOT IN ({', '.join(f"'{c}'" for c in CATEGORIES[1:])})) AS pred_other"""
    + """ FROM cls LEFT JOIN b ON CASE WHEN label = 'Good' THEN 'other' ELSE label END = actual GROUP BY actual""",
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(
        _rule_classes(spark, sf), "label", "prediction", CATEGORIES[1:]
    )


@query(
    "confusion_long",
    f"""WITH {_RULE}, cls(c) AS (VALUES {_CLASSES}), pairs AS (SELECT x.c AS actual, y.c AS predicted FROM cls x, cls y)
    SELECT actual, predicted, count(label) AS n FROM pairs LEFT JOIN b
    ON CASE WHEN label = 'Good' THEN 'other' ELSE label END = actual
    AND CASE WHEN prediction = 'Good' THEN 'other' ELSE prediction END = predicted GROUP BY actual, predicted""",
)
def confusion_long(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_long(_rule_classes(spark, sf), "label", "prediction", CATEGORIES[1:])


_PER_CLASS = f"""{_RULE},
a AS (SELECT label AS class, count(*) AS actual, count(*) FILTER (WHERE label = prediction) AS correct
      FROM b GROUP BY label),
p AS (SELECT prediction AS class, count(*) AS predicted FROM b GROUP BY prediction),
j AS (SELECT class, coalesce(actual, 0) AS actual, coalesce(predicted, 0) AS predicted,
             coalesce(correct, 0) AS correct FROM a FULL JOIN p USING (class)),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS "precision",
              CASE WHEN actual > 0 THEN correct / actual ELSE 0 END AS recall FROM j),
pc AS (SELECT *, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall)
                 ELSE 0 END AS f1 FROM pr)"""


@query(
    "class_metrics",
    f"""WITH {_PER_CLASS} SELECT class, actual, predicted, correct, round("precision" + 1e-9, 6) AS "precision",
        round(recall + 1e-9, 6) AS recall, round(f1 + 1e-9, 6) AS f1 FROM pc""",
)
def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.class_metrics(_rule_classes(spark, sf), "label", "prediction"))


@query(
    "classification_metrics",
    f"""WITH {_PER_CLASS} SELECT CAST(sum(actual) AS BIGINT) AS n,
        round(sum(correct) / sum(actual) + 1e-9, 6) AS accuracy,
        round(sum(actual * f1) / sum(actual) + 1e-9, 6) AS f1,
        round(sum(actual * "precision") / sum(actual) + 1e-9, 6) AS weighted_precision,
        round(sum(actual * recall) / sum(actual) + 1e-9, 6) AS weighted_recall FROM pc""",
)
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.classification_metrics(_rule_classes(spark, sf), "label", "prediction"))


_SPLIT_RULE = f"""{_RULE},
h AS (SELECT label, prediction, CASE WHEN (((event_id % 2147483647) * 2654435761) % 4294967296)
             / 4294967296.0e0 < 0.8 THEN 'train' ELSE 'test' END AS split FROM b),
a AS (SELECT split, label AS class, count(*) AS actual, count(*) FILTER (WHERE label = prediction) AS correct
      FROM h GROUP BY split, label),
p AS (SELECT split, prediction AS class, count(*) AS predicted FROM h GROUP BY split, prediction),
j AS (SELECT split, actual, correct, correct / actual AS recall, coalesce(correct / predicted, 0) AS "precision"
      FROM a LEFT JOIN p USING (split, class)),
pc AS (SELECT *, CASE WHEN correct > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END AS f1 FROM j)"""


@query(
    "classification_by_split",
    f"""WITH {_SPLIT_RULE}
    SELECT split, CAST(sum(actual) AS BIGINT) AS n, round(sum(correct) / sum(actual) + 1e-9, 6) AS accuracy,
        round(sum(actual * f1) / sum(actual) + 1e-9, 6) AS f1,
        round(sum(actual * "precision") / sum(actual) + 1e-9, 6) AS weighted_precision,
        round(sum(actual * recall) / sum(actual) + 1e-9, 6) AS weighted_recall
    FROM pc GROUP BY split""",
)
def classification_by_split(spark: SparkSession, sf: str) -> DataFrame:
    marked = hash_split(_rule_classes(spark, sf), "event_id")
    return rounded(metrics.classification_metrics(marked, "label", "prediction", by=["split"]))


@query(
    "class_distribution",
    f"""WITH {_RULE} SELECT label, prediction, count(*) AS n FROM b GROUP BY label, prediction""",
)
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    counts = metrics.confusion_counts(_rule_classes(spark, sf), "label", "prediction")
    return counts.withColumnsRenamed({"actual": "label", "predicted": "prediction"})
