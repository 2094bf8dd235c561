"""Alerts on a stream of readings: episodes over a threshold, whatever order the readings come in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airseries.operators.columns import quoted


def read_arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files that land in a folder (or under a glob), each read once."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def alerts(
    readings: DataFrame,
    value: str,
    threshold: float,
    ts: str = "ts",
    by: Sequence[str] = (),
    gap: str = "1 hour",
    delay: str = "1 day",
    row_id: str | None = None,
) -> DataFrame:
    """One row per episode over the threshold and ``by``: first and last time over it, readings over it, the highest.

    An episode goes on while the next reading over the threshold comes within ``gap``. It is given out when no reading may
    join it any more, that is when readings have come that are ``delay`` later than its end; a reading that comes later
    than that is dropped if its own episode is over. So the result depends on the readings,
    not on the order or the files they come in, as long as they are no more than ``delay`` late. With ``row_id`` a reading
    that is delivered twice counts once. Null and NaN are over no threshold, rows without a time are dropped,
    null is a key like any other.

    State is one row per open episode (and per recent ``row_id``). Episodes are merged from partial ones, so a hot key
    is summed up before the shuffle. Works on a batch of readings as well; then all episodes come back.
    """
    if isinstance(readings.schema[ts].dataType, T.TimestampNTZType):
        readings = readings.withColumn(ts, F.col(quoted(ts)).cast("timestamp"))
    readings = readings.where(F.col(quoted(ts)).isNotNull())
    number = F.col(quoted(value)).cast("double")
    over = ~F.isnan(number) & (number > threshold)
    kept = [F.col(quoted(c)).alias(f"_k{i}") for i, c in enumerate(by)]
    rows = readings.select(
        F.col(quoted(ts)).alias("_ts"),
        number.alias("_value"),
        F.coalesce(over, F.lit(False)).alias("_over"),
        *kept,
        *([F.col(quoted(row_id)).alias("_id")] if row_id else []),
    ).withWatermark("_ts", delay)
    if row_id:
        rows = rows.dropDuplicatesWithinWatermark(["_id"]) if readings.isStreaming else rows.dropDuplicates(["_id"])
    # A reading below the threshold has no window and is left out, but only here: it moves the watermark too.
    window = F.session_window("_ts", F.when(F.col("_over"), F.lit(gap)).otherwise(F.lit("0 seconds")))
    return (
        rows.groupBy(window, *[f"_k{i}" for i in range(len(by))])
        .agg(
            F.min("_ts").alias("first"),
            F.max("_ts").alias("last"),
            F.count(F.lit(1)).alias("readings"),
            F.max("_value").alias("peak"),
        )
        .select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(by)], "first", "last", "readings", "peak")
    )


def write_alerts(found: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Takes in what has arrived, appends closed episodes to ``path`` and ends; the next call goes on from the checkpoint."""
    return (
        found.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
