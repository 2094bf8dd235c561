"""The test tables seen as sensor readings.

``events`` stands for a table of readings: ``value`` is the particle reading,
``user_id`` the station, ``props.k`` the temperature. An ``error`` event has no
reading, and temperatures below 5 count as not measured, so the tables hold the
gaps that cleaning is about.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.operators.clean import drop_missing, impute_mean
from airseries.sources.readers import read_parquet


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """event_id, ts, station, direction, pm (nullable), temp (nullable)."""
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.col("user_id").alias("station"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("direction"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("pm"),
        F.when(k >= 5, k).alias("temp"),
    )


def filled(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with a target, temperature filled with its mean."""
    return impute_mean(drop_missing(readings(spark, sf), "pm"), ["temp"])


R = """
r AS (SELECT event_id, ts, user_id AS station,
             CASE WHEN event_type <> 'signup' THEN event_type END AS direction,
             CASE WHEN event_type <> 'error' THEN value END AS pm,
             CASE WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 5
                  THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS temp
      FROM events)"""

K = R + """,
k AS (SELECT * FROM r WHERE pm IS NOT NULL)"""

FILLED = K + """,
m AS (SELECT avg(temp) AS mt FROM k),
f AS (SELECT event_id, ts, station, direction, pm, coalesce(temp, mt) AS temp FROM k, m)"""


def raw_readings(spark: SparkSession, sf: str) -> DataFrame:
    """The events as raw hourly readings, under the raw column names."""
    k = F.get_json_object("props", "$.k").cast("double")
    wind = (
        F.when(F.col("event_type") == "click", "NE")
        .when(F.col("event_type") == "view", "NW")
        .when(F.col("event_type") == "purchase", "SE")
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("No"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.day("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("pm2.5"),
        (k * 0.5 - 20).alias("DEWP"),
        F.when(k >= 5, k - 40).alias("TEMP"),
        F.when(k != 7, F.lit(990.0) + F.col("user_id") % 50).alias("PRES"),
        wind.alias("cbwd"),
        (k * 0.75).alias("Iws"),
        (F.col("user_id") % 3).cast("double").alias("Is"),
        F.when(F.col("event_type") == "view", 2.0).otherwise(0.0).alias("Ir"),
    )


RAW = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS kk FROM events),
raw AS (SELECT event_id AS "No", year(ts) AS y, month(ts) AS mo, day(ts) AS d, hour(ts) AS h,
               CASE WHEN event_type <> 'error' THEN value END AS pm2_5,
               kk * 0.5 - 20 AS "DEWP",
               CASE WHEN kk >= 5 THEN kk - 40 END AS "TEMP",
               CASE WHEN kk <> 7 THEN 990.0 + user_id % 50 END AS "PRES",
               CASE event_type WHEN 'click' THEN 'NE' WHEN 'view' THEN 'NW'
                               WHEN 'purchase' THEN 'SE' END AS cbwd,
               kk * 0.75 AS "Iws", CAST(user_id % 3 AS DOUBLE) AS "Is",
               CASE WHEN event_type = 'view' THEN 2.0 ELSE 0.0 END AS "Ir"
        FROM e)"""

BAND = """CASE WHEN {x} IS NULL THEN NULL
     WHEN {x} <= 12 THEN 'Good' WHEN {x} <= 35.4 THEN 'Moderate'
     WHEN {x} <= 55.4 THEN 'Unhealthy for Sensitive Groups' WHEN {x} <= 150.4 THEN 'Unhealthy'
     WHEN {x} <= 250.4 THEN 'Very Unhealthy' ELSE 'Hazardous' END"""

AQI = """CASE WHEN {x} IS NULL THEN NULL
     WHEN {x} <= 12 THEN {x} * 4.17e0 WHEN {x} <= 35.4 THEN 50 + ({x} - 12) * 2.13e0
     WHEN {x} <= 55.4 THEN 100 + ({x} - 35.4e0) * 2.5e0
     WHEN {x} <= 150.4 THEN 150 + ({x} - 55.4e0) * 1.05e0
     WHEN {x} <= 250.4 THEN 200 + ({x} - 150.4e0) * 0.5e0
     ELSE 300 + ({x} - 250.4e0) * 0.4e0 END"""

CLEAN = RAW + """,
kept AS (SELECT * FROM raw WHERE pm2_5 IS NOT NULL),
means AS (SELECT avg("DEWP") AS a1, avg("TEMP") AS a2, avg("PRES") AS a3,
                 avg("Iws") AS a4, avg("Is") AS a5, avg("Ir") AS a6 FROM kept),
clean AS (SELECT "No", y AS "year", mo AS "month", d AS "day", h AS "hour", pm2_5,
                 coalesce("DEWP", a1) AS "DEWP", coalesce("TEMP", a2) AS "TEMP",
                 coalesce("PRES", a3) AS "PRES", coalesce(cbwd, 'cv') AS cbwd,
                 coalesce("Iws", a4) AS "Iws", coalesce("Is", a5) AS "Is",
                 coalesce("Ir", a6) AS "Ir",
                 make_timestamp(y, mo, d, h, 0, 0.0) AS "timestamp",
                 """ + BAND.format(x="pm2_5") + """ AS aqi_category,
                 """ + AQI.format(x="pm2_5") + """ AS aqi
          FROM kept, means)"""


def features_sql(shift: int = 0) -> str:
    """CTEs up to the feature table; ``shift`` ends all frames that many rows earlier."""

    def mean(c: str, n: int) -> str:
        end = "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
        return f"avg({c}) OVER (ORDER BY \"timestamp\", \"No\" ROWS BETWEEN {n - 1 + shift} PRECEDING AND {end})"

    def back(c: str, k: int) -> str:
        return f'lag({c}, {k}) OVER (ORDER BY "timestamp", "No")' if k else c

    rolling = [("pm25", "pm2_5", n) for n in (3, 6, 12, 24)]
    rolling += [("temp", '"TEMP"', n) for n in (6, 24)] + [("pres", '"PRES"', n) for n in (6, 24)]
    lags = [("pm25", "pm2_5", k) for k in (1, 3, 6, 12, 24)]
    lags += [("temp", '"TEMP"', k) for k in (6, 24)] + [("pres", '"PRES"', 6)]
    cols = [f"{mean(c, n)} AS {p}_rolling_{n}h" for p, c, n in rolling]
    cols += [f"{back(c, k)} AS {p}_lag_{k}h" for p, c, k in lags]
    cols += [
        f"{back('pm2_5', shift)} - {back('pm2_5', k + shift)} AS pm25_diff_{k}h" for k in (1, 24)
    ]
    return CLEAN + f""",
w AS (SELECT *, {", ".join(cols)} FROM clean),
t AS (SELECT *, dayofweek("timestamp") + 1 AS day_of_week, day("timestamp") AS day_of_month,
             weekofyear("timestamp") AS week_of_year,
             CASE WHEN "month" IN (12, 1, 2) THEN 'Winter' WHEN "month" IN (3, 4, 5) THEN 'Spring'
                  WHEN "month" IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
      FROM w WHERE pm25_lag_24h IS NOT NULL AND pm25_rolling_24h IS NOT NULL
      {"AND pm25_diff_24h IS NOT NULL" if shift else ""})"""


def _rounded(names: list[str]) -> str:
    return ", ".join(f'round("{c}" + 1e-9, 6) AS "{c}"' for c in names)


FEATURE_SELECT = (
    'SELECT "No", "timestamp", aqi_category, '
    + _rounded(["pm2_5", "aqi", "DEWP", "TEMP", "PRES", "Iws", "Is", "Ir"])
    + ', "hour", day_of_week, day_of_month, week_of_year, '
    + """CAST(day_of_week IN (1, 7) AS BIGINT) AS is_weekend,
       CAST("hour" IN (7, 8, 9, 18, 19, 20) AS BIGINT) AS is_rush_hour,
       CAST("hour" BETWEEN 8 AND 18 AND day_of_week NOT IN (1, 7) AS BIGINT) AS is_business_hours, """
    + _rounded(
        [f"pm25_rolling_{n}h" for n in (3, 6, 12, 24)]
        + [f"{p}_rolling_{n}h" for p in ("temp", "pres") for n in (6, 24)]
        + [f"pm25_lag_{k}h" for k in (1, 3, 6, 12, 24)]
        + ["temp_lag_6h", "temp_lag_24h", "pres_lag_6h", "pm25_diff_1h", "pm25_diff_24h"]
    )
    + """,
       round(CASE WHEN "TEMP" <> 0 THEN "DEWP" / "TEMP" ELSE 0 END + 1e-9, 6) AS humidity_ratio,
       round("TEMP" * "PRES" + 1e-9, 6) AS temp_pres_interaction,
       round("TEMP" - temp_rolling_24h + 1e-9, 6) AS temp_deviation,
       round(CASE WHEN pm25_rolling_24h <> 0 THEN pm25_rolling_3h / pm25_rolling_24h ELSE 1 END + 1e-9, 6) AS pm25_trend,
       round("Iws" + "Is" + "Ir" + 1e-9, 6) AS wind_total, """
    + ", ".join(f"CAST(cbwd = '{v}' AS BIGINT) AS wind_{v}" for v in ("NE", "NW", "SE", "cv"))
    + ", "
    + ", ".join(
        f"CAST(season = '{s}' AS BIGINT) AS \"season_{s}\""
        for s in ("Winter", "Spring", "Summer", "Fall")
    )
    + " FROM t"
)
