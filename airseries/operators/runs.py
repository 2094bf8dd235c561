"""Run records in a plain Parquet table: one row per run and key."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, name string, kind string, key string, text string, number double, at timestamp"


def log_run(
    spark: SparkSession,
    path: str,
    name: str,
    params: Mapping[str, Any] | None = None,
    metrics: Mapping[str, float] | DataFrame | None = None,
    model: Model | None = None,
    run_id: str | None = None,
) -> str:
    """Append one run; ``metrics`` is a dict or a one-row table. Returns the run id.

    A given model is saved next to the table and its path recorded.
    """
    run = run_id or uuid.uuid4().hex
    if isinstance(metrics, DataFrame):
        metrics = metrics.first().asDict()
    at = datetime.now(timezone.utc)
    rows: list[tuple] = [
        (run, name, "param", k, str(v), None, at) for k, v in (params or {}).items()
    ]
    rows += [
        (run, name, "metric", k, None, None if v is None else float(v), at)
        for k, v in (metrics or {}).items()
    ]
    if model is not None:
        target = f"{path.rstrip('/')}_models/{run}"
        save_model(model, target)
        rows.append((run, name, "artifact", "model", target, None, at))
    spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All run records."""
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def compare_runs(runs: DataFrame, metrics: list[str], best_by: str, ascending: bool = True) -> DataFrame:
    """One row per run with the named metrics as columns, best first."""
    wide = (
        runs.filter(F.col("kind") == "metric")
        .groupBy("run_id", "name")
        .agg(*[F.max(F.when(F.col("key") == m, F.col("number"))).alias(m) for m in metrics])
    )
    key = F.asc_nulls_last(best_by) if ascending else F.desc_nulls_last(best_by)
    return wide.orderBy(key, "name", "run_id")


def best_run(runs: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    """The run with the best value of one metric."""
    return compare_runs(runs, [metric], metric, ascending).limit(1)


def save_model(model: Model, path: str) -> None:
    """Save a fitted model, over an older one at the same path."""
    model.write().overwrite().save(path)


def load_model(kind: type[Model], path: str) -> Model:
    """Load a saved model of the given class."""
    return kind.load(path)
