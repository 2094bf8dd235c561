"""Writers and catalog helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class WriteMismatch(RuntimeError):
    """The table read back is not the table written."""


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if missing and make it the current one."""
    ident = "`" + name.replace("`", "``") + "`"
    where = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident}{where}")
    spark.catalog.setCurrentDatabase(name)


def save_table(df: DataFrame, name: str) -> None:
    """Overwrite a managed table."""
    df.write.mode("overwrite").saveAsTable(name)


def write_checked(df: DataFrame, name: str) -> DataFrame:
    """Overwrite a managed table, then compare what was written with what is read back.

    The rows are counted while they are written, by an observation, so the
    input is computed once. Returns the saved table.
    """
    from pyspark.sql import Observation

    seen = Observation()
    save_table(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    saved = df.sparkSession.table(name)
    written, kept = seen.get["n"], saved.count()
    if written != kept:
        raise WriteMismatch(f"{name}: wrote {written} rows, read {kept}")
    want = [(f.name, f.dataType) for f in df.schema]
    have = [(f.name, f.dataType) for f in saved.schema]
    if want != have:
        raise WriteMismatch(f"{name}: schema {have} is not {want}")
    return saved


def table_report(spark: SparkSession, name: str) -> DataFrame:
    """One row: table name, number of rows, number of columns."""
    table = spark.table(name)
    return table.agg(
        F.lit(name.split(".")[-1]).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(table.columns)).cast("long").alias("n_columns"),
    )


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a database, by the catalog's own listing."""
    if database is None:
        return spark.sql("SHOW TABLES")
    return spark.sql("SHOW TABLES IN `" + database.replace("`", "``") + "`")


def list_databases(spark: SparkSession) -> DataFrame:
    """All databases."""
    return spark.sql("SHOW DATABASES")


def write_csv(df: DataFrame, path: str, null_value: str = "NA") -> None:
    """Delimited text with a header; null as ``null_value``."""
    df.write.mode("overwrite").option("header", True).option("nullValue", null_value).csv(path)
