"""Readers with declared schemas; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.functions.numeric import null_if_nan

# Columns of the raw hourly readings.
READINGS_SCHEMA = T.StructType(
    [T.StructField("No", T.LongType())]
    + [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day", "hour")]
    + [T.StructField(c, T.DoubleType()) for c in ("pm2.5", "DEWP", "TEMP", "PRES")]
    + [T.StructField("cbwd", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("Iws", "Is", "Ir")]
)

# Fields of landed measurement records used here.
MEASUREMENT_SCHEMA = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("date", T.StructType([T.StructField("utc", T.StringType())])),
    ]
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as null in all float and double columns, in one projection."""
    floats = [
        f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    return df.withColumns({c: null_if_nan(_quoted(c)) for c in floats}) if floats else df


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_readings_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = READINGS_SCHEMA,
    null_value: str = "NA",
    malformed: str = "FAILFAST",
) -> DataFrame:
    """Delimited readings with a header; ``null_value`` and NaN become null.

    A cell that does not fit its type stops the read; ``malformed="PERMISSIVE"``
    makes it null and ``"DROPMALFORMED"`` drops its row, as the CSV source has it.
    """
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", null_value)
        .option("mode", malformed)
        .csv(path)
    )
    return nan_to_null(raw)


def read_measurements_json(
    spark: SparkSession,
    path: str | list[str],
    country: str | None = None,
    parameters: Sequence[str] | None = None,
    date_from: datetime | str | None = None,
    limit: int | None = None,
    schema: T.StructType = MEASUREMENT_SCHEMA,
) -> DataFrame:
    """Landed JSON-lines measurements, filtered as the service's query would.

    ``date.utc`` is a time in UTC whatever zone or offset its text names; text
    without one is UTC. Text that is no time stops the read, so no row is lost by
    it, and so does a malformed record. ``limit`` keeps the newest rows, ties by
    the other columns.
    """
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    df = df.withColumn("date", F.when(F.col("date").isNotNull(), F.struct(utc_time(F.col("date.utc")).alias("utc"))))
    if country is not None:
        df = df.filter(F.col("country") == country)
    if parameters is not None:
        df = df.filter(F.col("parameter").isin(*parameters))
    if date_from is not None:
        df = df.filter(F.col("date.utc") >= F.lit(str(date_from)).cast("timestamp_ntz"))
    if limit is not None:
        rest = [c for c in df.columns if c != "date"]
        df = df.orderBy(F.desc("date.utc"), *[_quoted(c) for c in rest]).limit(limit)
    return df


def utc_time(text: Column) -> Column:
    """A time without zone, in UTC, from text with a zone, an offset or neither; else an error."""
    zoned = F.when(text.rlike(r"(?i)(Z|UTC|[+-]\d{2}:?\d{2})\s*$"), text).otherwise(F.concat(text, F.lit("Z")))
    micros = F.unix_micros(F.try_to_timestamp(zoned))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wrong = F.raise_error(F.concat(F.lit("not a time: "), text)).cast("timestamp_ntz")
    return F.when(text.isNotNull() & micros.isNull(), wrong).otherwise(
        F.timestamp_add("MICROSECOND", micros, epoch)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name."""
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files."""
    return spark.read.parquet(path)


def preview(spark: SparkSession, name: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows of a catalog table by SQL text; the name is passed as an identifier."""
    return spark.sql("SELECT * FROM IDENTIFIER(:t) LIMIT :n", args={"t": name, "n": n})


def literal_rows(
    spark: SparkSession, rows: Iterable[Any], schema: T.StructType | Sequence[str]
) -> DataFrame:
    """A small table written out in the program, with a full schema or a list of names."""
    return spark.createDataFrame(
        list(rows), schema if isinstance(schema, T.StructType) else list(schema)
    )


def literal_dicts(
    spark: SparkSession, records: Iterable[Mapping[str, Any]], schema: T.StructType
) -> DataFrame:
    """A small table from dicts; missing keys become null."""
    return spark.createDataFrame(
        [tuple(r.get(f.name) for f in schema) for r in records], schema
    )


def from_pandas(spark: SparkSession, frame: Any, schema: T.StructType | None = None) -> DataFrame:
    """A small result held in pandas, with NaN as null."""
    return nan_to_null(spark.createDataFrame(frame, schema))
