"""Queries on readers, writers and the catalog; each works on a whole test table."""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.checks.fixture import RAW, raw_readings, table
from airseries.checks.registry import query, rounded
from airseries.sources import readers, sinks
from airseries.session import stage_path


@query(
    "csv_roundtrip",
    f"""WITH {RAW} SELECT "No", y AS "year", mo AS "month", d AS "day", h AS "hour",
        round(pm2_5 + 1e-9, 6) AS "pm2.5", round("DEWP" + 1e-9, 6) AS "DEWP",
        round("TEMP" + 1e-9, 6) AS "TEMP", round("PRES" + 1e-9, 6) AS "PRES", cbwd,
        round("Iws" + 1e-9, 6) AS "Iws", round("Is" + 1e-9, 6) AS "Is", round("Ir" + 1e-9, 6) AS "Ir"
        FROM raw""",
)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "csv")
    sinks.write_csv(raw_readings(spark, sf), path)
    return rounded(readers.read_readings_csv(spark, path))


def _spelled(ts: str, key: str):
    """A UTC time as text in four spellings, by turns: Z, offset zero, offset one hour, none."""
    shown = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    turn = F.col(key) % 4
    later = F.date_format(F.col(ts) + F.expr("INTERVAL '1' HOUR"), shown)
    plain = F.date_format(ts, shown)
    return (
        F.when(turn == 0, F.concat(plain, F.lit("Z")))
        .when(turn == 1, F.concat(plain, F.lit("+00:00")))
        .when(turn == 2, F.concat(later, F.lit("+01:00")))
        .otherwise(plain)
    )


@query(
    "json_measurements",
    """SELECT CAST(user_id AS VARCHAR) AS location, event_type AS parameter, value, ts AS utc FROM events
       WHERE event_type IN ('click', 'view') AND user_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-10 00:00:00'""",
)
def json_measurements(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "json")
    table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("location"),
        F.when(F.col("user_id") % 2 == 0, "ES").otherwise("PT").alias("country"),
        F.col("event_type").alias("parameter"),
        "value",
        F.lit("ug/m3").alias("unit"),
        F.struct(_spelled("ts", "event_id").alias("utc")).alias("date"),
    ).write.json(path)
    since = datetime.datetime(2024, 1, 10)
    df = readers.read_measurements_json(spark, path, "ES", ["click", "view"], since)
    return df.select("location", "parameter", "value", F.col("date.utc").alias("utc"))


@contextlib.contextmanager
def scratch_database(spark: SparkSession) -> Iterator[str]:
    """A database of its own, current inside; it goes with the tables' folder when the stages are dropped."""
    path = stage_path(spark, "db")
    name = "db_" + path.rsplit("-", 1)[-1]
    before = spark.catalog.currentDatabase()
    sinks.use_database(spark, name, path)
    try:
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)


@query(
    "newest_measurements",
    """SELECT CAST(user_id AS VARCHAR) AS location, value, ts AS utc FROM events
       ORDER BY ts DESC, CAST(user_id AS VARCHAR), event_type, value LIMIT 100""",
)
def newest_measurements(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "json")
    table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("location"),
        F.lit("ES").alias("country"),
        F.col("event_type").alias("parameter"),
        "value",
        F.lit("ug/m3").alias("unit"),
        F.struct(_spelled("ts", "event_id").alias("utc")).alias("date"),
    ).write.json(path)
    df = readers.read_measurements_json(spark, path, limit=100)
    return df.select("location", "value", F.col("date.utc").alias("utc"))


def _customer_copy(spark: SparkSession, sf: str, database: str) -> str:
    name = f"{database}.customer_copy"
    sinks.write_checked(table(spark, sf, "customer"), name)
    return name


@query(
    "table_roundtrip",
    """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
        round(c_acctbal + 1e-9, 6) AS c_acctbal, c_mktsegment FROM customer""",
)
def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    with scratch_database(spark) as database:
        return rounded(readers.read_table(spark, _customer_copy(spark, sf, database)))


@query(
    "table_report",
    "SELECT 'customer_copy' AS table_name, count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM customer",
)
def table_report(spark: SparkSession, sf: str) -> DataFrame:
    with scratch_database(spark) as database:
        return rounded(sinks.table_report(spark, _customer_copy(spark, sf, database)))


@query(
    "list_tables",
    """SELECT 'customer_copy' AS table_name, FALSE AS is_temporary, count(*) AS n_rows,
        CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer""",
)
def list_tables(spark: SparkSession, sf: str) -> DataFrame:
    with scratch_database(spark) as database:
        saved = spark.table(_customer_copy(spark, sf, database))
        listed = sinks.list_tables(spark, database).filter(F.col("namespace") == database)
    rows = saved.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("k")).alias("s")).scalar()
    return listed.select(
        F.col("tableName").alias("table_name"),
        F.col("isTemporary").alias("is_temporary"),
        rows["n"].alias("n_rows"),
        rows["k"].alias("key_sum"),
    )


@query(
    "list_databases",
    "SELECT CAST(2 AS BIGINT) AS n_databases, count(*) AS n_rows FROM customer",
)
def list_databases(spark: SparkSession, sf: str) -> DataFrame:
    # The default database and the new one, which holds the copy.
    with scratch_database(spark) as database:
        saved = spark.table(_customer_copy(spark, sf, database))
        listed = sinks.list_databases(spark)
    here = listed.filter(F.col("namespace").isin("default", database))
    rows = saved.agg(F.count(F.lit(1)).alias("n")).scalar()
    return here.agg(F.count(F.lit(1)).alias("n_databases")).select("n_databases", rows.alias("n_rows"))


@query(
    "sql_limit",
    "SELECT least(count(*), 10) AS n_rows, least(count(*), 10) AS n_found FROM customer",
)
def sql_limit(spark: SparkSession, sf: str) -> DataFrame:
    # Which ten rows come first is not defined; how many, and that all are rows of the table, is.
    with scratch_database(spark) as database:
        shown = readers.preview(spark, _customer_copy(spark, sf, database), 10)
    customers = table(spark, sf, "customer")
    found = shown.join(customers.select(*[F.col(c).alias(f"t_{c}") for c in customers.columns]),
                       F.col("c_custkey") == F.col("t_c_custkey"), "left")
    same = F.col("c_name").eqNullSafe(F.col("t_c_name")) & F.col("c_acctbal").eqNullSafe(F.col("t_c_acctbal"))
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_found"))


_PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query(
    "literal_lookup",
    """SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS rank, CASE o_orderstatus WHEN 'F' THEN 'filled'
        WHEN 'O' THEN 'open' WHEN 'P' THEN 'part' END AS status,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'soon' ELSE 'later' END AS speed,
        CASE o_orderstatus WHEN 'F' THEN 1.0e0 WHEN 'O' THEN 0.5e0 END AS weight, count(*) AS n
       FROM orders GROUP BY ALL""",
)
def literal_lookup(spark: SparkSession, sf: str) -> DataFrame:
    # Written-out tables of a few rows each, joined to the whole order table
    # after it is reduced to one row per pair of codes.
    ranks = readers.literal_rows(
        spark,
        _PRIORITIES,
        T.StructType(
            [T.StructField("o_orderpriority", T.StringType()), T.StructField("rank", T.IntegerType())]
        ),
    )
    states = readers.literal_rows(
        spark, [("F", "filled"), ("O", "open"), ("P", "part")], ["o_orderstatus", "status"]
    )
    speeds = readers.literal_dicts(
        spark,
        [
            {"o_orderpriority": p, "speed": "soon" if r <= 2 else "later"}
            for p, r in _PRIORITIES
        ],
        T.StructType(
            [T.StructField("o_orderpriority", T.StringType()), T.StructField("speed", T.StringType())]
        ),
    )
    weights = readers.from_pandas(
        spark, pd.DataFrame({"o_orderstatus": ["F", "O", "P"], "weight": [1.0, 0.5, float("nan")]})
    )
    counts = (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = (
        counts.join(ranks, "o_orderpriority")
        .join(speeds, "o_orderpriority")
        .join(states, "o_orderstatus", "left")
        .join(weights, "o_orderstatus", "left")
    )
    return rounded(joined.select("rank", "status", "speed", "weight", "n"))
