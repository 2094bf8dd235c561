"""Queries on filters, imputation, profiles, bands and column maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.checks.fixture import (
    AQI,
    BAND,
    CLEAN,
    FILLED,
    K,
    R,
    filled,
    raw_readings,
    readings,
    table,
)
from airseries.checks.registry import big, query, r6, rounded
from airseries.functions.bands import (
    COARSE_BANDS,
    COARSE_CODES,
    EPA_INDEX,
    FIVE_BAND_INDEX,
    FIVE_BANDS,
    band,
    encode_labels,
    group_values,
    piecewise,
)
from airseries.functions.calendar import (
    assemble_timestamp,
    calendar_columns,
    parse_timestamp,
    season,
)
from airseries.functions.numeric import safe_ratio
from airseries.operators import clean, columns, profile
from airseries.operators.quantiles import quantiles
from airseries.plans.readings import band_summary, prepare, profile_by


@query(
    "band_distribution",
    f"""WITH {FILLED},
    b AS (SELECT {BAND.format(x="pm")} AS band, pm, {AQI.format(x="pm")} AS i FROM f)
    SELECT band, count(*) AS n_rows, round(avg(pm) + 1e-9, 6) AS avg_value,
           round(avg(i) + 1e-9, 6) AS avg_index FROM b GROUP BY band""",
)
def band_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(band_summary(filled(spark, sf), "pm"))


@query(
    "null_census",
    f"""WITH {R} SELECT count(*) - count(event_id) AS event_id, count(*) - count(ts) AS ts,
        count(*) - count(station) AS station, count(*) - count(direction) AS direction,
        count(*) - count(pm) AS pm, count(*) - count(temp) AS temp FROM r""",
)
def null_census(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_census(readings(spark, sf))


@query(
    "null_report",
    f"""WITH {R}, c AS (SELECT count(*) AS n, count(*) - count(direction) AS direction,
        count(*) - count(pm) AS pm, count(*) - count(temp) AS temp FROM r),
    l AS (SELECT 'direction' AS "column", direction AS null_count, n FROM c
          UNION ALL SELECT 'pm', pm, n FROM c UNION ALL SELECT 'temp', temp, n FROM c)
    SELECT "column", null_count, round(null_count / n * 100, 2) AS null_percentage
    FROM l WHERE null_count > 0""",
)
def null_report(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_report(readings(spark, sf))


@query(
    "drop_missing",
    f"WITH {K} SELECT event_id, round(pm + 1e-9, 6) AS pm FROM k",
)
def drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_missing(readings(spark, sf), "pm").select("event_id", r6("pm"))


@query(
    "impute_mean",
    f"WITH {FILLED} SELECT event_id, round(temp + 1e-9, 6) AS temp FROM f",
)
def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    return filled(spark, sf).select("event_id", r6("temp"))


@query(
    "fill_categorical",
    f"WITH {R} SELECT event_id, coalesce(direction, 'cv') AS direction FROM r",
)
def fill_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return clean.fill_constant(readings(spark, sf), "direction", "cv").select(
        "event_id", "direction"
    )


_MODE = f"""WITH {R}, d AS (SELECT direction, count(*) AS n FROM r WHERE direction IS NOT NULL
    GROUP BY direction ORDER BY n DESC, direction LIMIT 1)"""


@query("mode_value", f"{_MODE} SELECT direction, n FROM d")
def mode_value(spark: SparkSession, sf: str) -> DataFrame:
    return clean.mode_of(readings(spark, sf), "direction")


@query(
    "fill_mode",
    f"{_MODE} SELECT event_id, coalesce(r.direction, d.direction) AS direction FROM r, d",
)
def fill_mode(spark: SparkSession, sf: str) -> DataFrame:
    return clean.fill_mode(readings(spark, sf), "direction").select("event_id", "direction")


@query(
    "direction_frequency",
    f'WITH {R} SELECT direction, count(*) AS "count" FROM r GROUP BY direction',
)
def direction_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return profile.frequency(readings(spark, sf), "direction")


def _describe_sql(extra: str) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}) + 1e-9, 6) AS mean,
            round(stddev_samp({c}) + 1e-9, 6) AS stddev, round(min({c}) + 1e-9, 6) AS "min",
            round(max({c}) + 1e-9, 6) AS "max" {extra.format(c=c)} FROM r"""
        for c in ("pm", "temp")
    ]
    return f"WITH {R} " + " UNION ALL ".join(parts)


@query("describe_typed", _describe_sql(""))
def describe_typed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.describe_numeric(readings(spark, sf), ["pm", "temp"]))


@query(
    "describe_text",
    f"""WITH {R} SELECT 'direction' AS "column", count(direction) AS "count", CAST(NULL AS DOUBLE) AS mean,
        min(direction) AS "min", max(direction) AS "max" FROM r
        UNION ALL SELECT 'station', count(station), round(avg(station) + 1e-9, 6),
        CAST(min(station) AS VARCHAR), CAST(max(station) AS VARCHAR) FROM r""",
)
def describe_text(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.describe_columns(readings(spark, sf), ["direction", "station"])
    return rounded(found.select("column", "count", "mean", "min", "max"))


@query(
    "summary_typed",
    _describe_sql(
        ", "
        + ", ".join(
            "round(quantile_disc({c}, %s) + 1e-9, 6) AS p%d" % (p, int(p * 100))
            for p in (0.25, 0.5, 0.75)
        )
    ),
)
def summary_typed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.summary_numeric(readings(spark, sf), ["pm", "temp"]))


@query(
    "exact_quantiles",
    f"""WITH {K} SELECT round(quantile_disc(pm, 0.01) + 1e-9, 6) AS p01,
        round(quantile_disc(pm, 0.25) + 1e-9, 6) AS p25, round(quantile_disc(pm, 0.5) + 1e-9, 6) AS p50,
        round(quantile_disc(pm, 0.75) + 1e-9, 6) AS p75, round(quantile_disc(pm, 0.99) + 1e-9, 6) AS p99,
        count(*) AS n FROM k""",
)
def exact_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    # Few buckets, so that many rounds of counting are checked.
    df = readings(spark, sf)
    shares = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    found = quantiles(df, "pm", list(shares.values()), buckets=16)
    row = clean.drop_missing(df, "pm").agg(F.count(F.lit(1)).alias("n"))
    return row.select(*[r6(F.lit(v), name) for name, v in zip(shares, found)], "n")


@query(
    "approx_quantiles",
    f"""WITH {K} SELECT unnest([0.01e0, 0.25e0, 0.5e0, 0.75e0, 0.99e0]) AS share,
        round(unnest(quantile_disc(pm, [0.0, 0.24, 0.49, 0.74, 0.98])) + 1e-9, 6) AS low,
        round(unnest(quantile_disc(pm, [0.02, 0.26, 0.51, 0.76, 1.0])) + 1e-9, 6) AS high, TRUE AS within_error
        FROM k""",
)
def approx_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    # A value is right if it lies between the exact quantiles one percent of the rows below and above.
    df = clean.drop_missing(readings(spark, sf), "pm")
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = profile.approx_quantiles(df, "pm", shares, 0.01)
    ends = quantiles(df, "pm", [round(x, 2) for p in shares for x in (p - 0.01, p + 0.01)])
    rows = [
        (p, ends[2 * i], ends[2 * i + 1], ends[2 * i] <= v <= ends[2 * i + 1])
        for i, (p, v) in enumerate(zip(shares, found, strict=True))
    ]
    return rounded(spark.createDataFrame(rows, "share double, low double, high double, within_error boolean"))


_FENCES = f"""WITH {K}, q AS (SELECT quantile_disc(pm, 0.25) AS q1, quantile_disc(pm, 0.5) AS median,
        quantile_disc(pm, 0.75) AS q3 FROM k),
    fence AS (SELECT *, q1 - 3 * (q3 - q1) AS lower, q3 + 3 * (q3 - q1) AS upper FROM q)"""


@query(
    "iqr_outliers",
    f"""{_FENCES} SELECT round(q1 + 1e-9, 6) AS q1, round(median + 1e-9, 6) AS median,
        round(q3 + 1e-9, 6) AS q3, round(lower + 1e-9, 6) AS lower, round(upper + 1e-9, 6) AS upper,
        outliers, total, round(outliers / total * 100 + 1e-9, 6) AS outlier_percentage
        FROM (SELECT fence.*, count(*) AS total,
                     count(*) FILTER (WHERE pm < lower OR pm > upper) AS outliers
              FROM k, fence GROUP BY ALL)""",
)
def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.outlier_report(clean.drop_missing(readings(spark, sf), "pm"), "pm"))


@query(
    "outlier_rows",
    f"""{_FENCES} SELECT event_id, round(pm + 1e-9, 6) AS pm FROM k, fence
        WHERE pm < lower OR pm > upper""",
)
def outlier_rows(spark: SparkSession, sf: str) -> DataFrame:
    flagged = profile.flag_outliers(clean.drop_missing(readings(spark, sf), "pm"), "pm")
    return flagged.filter("is_outlier").select("event_id", r6("pm"))


@query(
    "retention_report",
    f"""WITH {R} SELECT count(*) AS rows_before, count(pm) AS rows_after,
        count(*) - count(pm) AS rows_removed,
        round(count(pm) / count(*) * 100 + 1e-9, 6) AS percent_kept FROM r""",
)
def retention_report(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf)
    return rounded(profile.retention(df, clean.present(df, "pm")))


@query(
    "dedup",
    f"""WITH {R}, h AS (SELECT *, CAST(hour(ts) AS BIGINT) AS hour_of_day FROM r)
    SELECT station, hour_of_day, event_id, ts, direction, round(temp + 1e-9, 6) AS temp FROM h
    QUALIFY row_number() OVER (PARTITION BY station, hour_of_day ORDER BY event_id) = 1""",
)
def dedup(spark: SparkSession, sf: str) -> DataFrame:
    keyed = readings(spark, sf).withColumn("hour_of_day", big(F.hour("ts")))
    kept = clean.dedup(keyed, ["station", "hour_of_day"], "event_id")
    return rounded(kept.select("station", "hour_of_day", "event_id", "ts", "direction", "temp"))


@query(
    "correlations",
    f"""WITH {FILLED}, c AS (SELECT corr(pm, temp) AS a, corr(pm, CAST(station AS DOUBLE)) AS b,
        corr(pm, CAST(hour(ts) AS DOUBLE)) AS d FROM f)
    SELECT 'temp' AS feature, round(a + 1e-9, 6) AS correlation FROM c
    UNION ALL SELECT 'station', round(b + 1e-9, 6) FROM c
    UNION ALL SELECT 'hour', round(d + 1e-9, 6) FROM c""",
)
def correlations(spark: SparkSession, sf: str) -> DataFrame:
    df = filled(spark, sf).withColumn("hour", F.hour("ts"))
    return rounded(profile.correlations(df, "pm", ["temp", "station", "hour", "absent"]))


@query("distinct_values", f"WITH {R} SELECT DISTINCT station FROM r")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(readings(spark, sf), "station")


@query(
    "distinct_counts",
    f"""WITH {R} SELECT count(DISTINCT station) AS stations,
        count(DISTINCT direction) AS directions FROM r""",
)
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf).agg(
        F.count_distinct("station").alias("stations"),
        F.count_distinct("direction").alias("directions"),
    )


@query(
    "timestamp_assembly",
    """SELECT o_orderkey, date_trunc('hour', o_orderdate) AS assembled,
              date_trunc('hour', o_orderdate) AS parsed, CAST(NULL AS TIMESTAMP) AS impossible
       FROM orders""",
)
def timestamp_assembly(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    parts = [F.year(d), F.month(d), F.day(d), F.hour(d)]
    return table(spark, sf, "orders").select(
        "o_orderkey",
        assemble_timestamp(*parts).alias("assembled"),
        parse_timestamp(*parts).cast("timestamp_ntz").alias("parsed"),
        assemble_timestamp(F.year(d), F.lit(2), F.lit(30), F.hour(d)).alias("impossible"),
    )


@query(
    "calendar_features",
    """SELECT event_id, dayofweek(ts) + 1 AS day_of_week, day(ts) AS day_of_month,
        weekofyear(ts) AS week_of_year,
        CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring'
             WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
        CAST(dayofweek(ts) IN (0, 6) AS BIGINT) AS is_weekend,
        CAST(hour(ts) IN (7, 8, 9, 18, 19, 20) AS BIGINT) AS is_rush_hour,
        CAST(hour(ts) BETWEEN 8 AND 18 AND dayofweek(ts) NOT IN (0, 6) AS BIGINT) AS is_business_hours
       FROM events""",
)
def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    named = calendar_columns("ts")
    return rounded(
        table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in named.items()])
    )


@query(
    "index_piecewise",
    f"WITH {R} SELECT event_id, {BAND.format(x='pm')} AS band, round({AQI.format(x='pm')} + 1e-9, 6) AS aqi FROM r",
)
def index_piecewise(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf).select(
        "event_id", band("pm").alias("band"), r6(piecewise("pm"), "aqi")
    )


@query(
    "index_epa",
    f"""WITH {R} SELECT event_id, round(least(CASE
        WHEN pm <= 12 THEN pm / 12 * 50
        WHEN pm <= 35.4 THEN 50 + 50 / (35.4e0 - 12) * (pm - 12)
        WHEN pm <= 55.4 THEN 100 + 50 / (55.4e0 - 35.4e0) * (pm - 35.4e0)
        WHEN pm <= 150.4 THEN 150 + 50 / (150.4e0 - 55.4e0) * (pm - 55.4e0)
        WHEN pm <= 250.4 THEN 200 + 100 / (250.4e0 - 150.4e0) * (pm - 150.4e0)
        ELSE 300 + 0.4e0 * (pm - 250.4e0) END, 350) + 1e-9, 6) AS aqi
    FROM r WHERE pm IS NOT NULL""",
)
def index_epa(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.drop_missing(readings(spark, sf), "pm")
    return df.select("event_id", r6(piecewise("pm", EPA_INDEX, cap=350.0), "aqi"))


@query(
    "five_band",
    f"""WITH {R} SELECT event_id, CASE WHEN pm IS NULL THEN NULL WHEN pm <= 12 THEN 'Bueno'
        WHEN pm <= 35.4 THEN 'Moderado' WHEN pm <= 55.4 THEN 'Dañino para grupos sensibles'
        WHEN pm <= 150.4 THEN 'Dañino' ELSE 'Muy dañino' END AS categoria,
        round(CASE WHEN pm <= 12 THEN pm * 4.17e0 WHEN pm <= 35.4 THEN 50 + (pm - 12) * 2.13e0
        WHEN pm <= 55.4 THEN 100 + (pm - 35.4e0) * 2.5e0
        WHEN pm <= 150.4 THEN 150 + (pm - 55.4e0) * 1.05e0
        ELSE 200 + (pm - 150.4e0) * 0.66e0 END + 1e-9, 6) AS aqi FROM r""",
)
def five_band(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf).select(
        "event_id",
        band("pm", FIVE_BANDS).alias("categoria"),
        r6(piecewise("pm", FIVE_BAND_INDEX), "aqi"),
    )


@query(
    "coarse_label",
    f"""WITH {K}, c AS (SELECT CASE WHEN pm <= 35.4 THEN 'Good' WHEN pm <= 55.4 THEN 'Moderate'
                     ELSE 'Unhealthy' END AS category FROM k)
    SELECT category, CASE category WHEN 'Good' THEN 0.0e0 WHEN 'Moderate' THEN 1.0e0 ELSE 2.0e0 END AS label,
           count(*) AS "count" FROM c GROUP BY category""",
)
def coarse_label(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.drop_missing(readings(spark, sf), "pm")
    df = df.select(band("pm", COARSE_BANDS).alias("category"))
    df = df.withColumn("label", encode_labels("category", COARSE_CODES))
    return profile.frequency(df, "category", "label")


@query(
    "role_groups",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HOT'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'MID' ELSE 'COLD' END AS role
       FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')""",
)
def role_groups(spark: SparkSession, sf: str) -> DataFrame:
    groups = {"HOT": ["1-URGENT", "2-HIGH"], "MID": ["3-MEDIUM"], "COLD": ["5-LOW"]}
    df = table(spark, sf, "orders").select(
        "o_orderkey", group_values("o_orderpriority", groups).alias("role")
    )
    return clean.drop_missing(df, "role")


@query(
    "member_filter",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('P')""",
)
def member_filter(spark: SparkSession, sf: str) -> DataFrame:
    wanted = F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    return (
        table(spark, sf, "orders")
        .filter(wanted & ~F.col("o_orderstatus").isin("P"))
        .select("o_orderkey", "o_orderstatus")
    )


@query(
    "interactions",
    f"""WITH {FILLED} SELECT event_id,
        round(CASE WHEN temp - 40 <> 0 THEN pm / (temp - 40) ELSE 0 END + 1e-9, 6) AS ratio,
        round(pm * temp + 1e-9, 6) AS product, round(pm + temp + station + 1e-9, 6) AS total FROM f""",
)
def interactions(spark: SparkSession, sf: str) -> DataFrame:
    pm, temp = F.col("pm"), F.col("temp")
    return filled(spark, sf).select(
        "event_id",
        r6(safe_ratio(pm, temp - 40, 0.0), "ratio"),
        r6(pm * temp, "product"),
        r6(pm + temp + F.col("station"), "total"),
    )


@query(
    "hour_profile",
    f"""WITH {FILLED} SELECT CAST(hour(ts) AS BIGINT) AS "hour", round(avg(pm) + 1e-9, 6) AS avg_pm,
        count(*) AS "count" FROM f GROUP BY hour(ts)""",
)
def hour_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = filled(spark, sf).withColumn("hour", F.hour("ts"))
    return rounded(profile_by(df, "hour", avg_pm=F.avg("pm")).orderBy("hour"))


@query(
    "season_profile",
    """SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
            WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
            WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
        round(avg(o_totalprice) + 1e-9, 6) AS avg_price,
        round(avg(CAST(day(o_orderdate) AS DOUBLE)) + 1e-9, 6) AS avg_day, count(*) AS "count"
       FROM orders GROUP BY 1""",
)
def season_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("season", season(F.month("o_orderdate")))
    means = {"avg_price": F.avg("o_totalprice"), "avg_day": F.avg(F.day("o_orderdate"))}
    return rounded(profile_by(df, "season", **means).orderBy(F.desc("avg_price")))


@query(
    "station_profile",
    f"""WITH {FILLED} SELECT station, round(avg(pm) + 1e-9, 6) AS avg_pm,
        round(max(pm) + 1e-9, 6) AS max_pm FROM f GROUP BY station""",
)
def station_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = profile_by(filled(spark, sf), "station", avg_pm=F.avg("pm"), max_pm=F.max("pm"))
    return rounded(df.drop("count").orderBy(F.desc("avg_pm")))


@query(
    "prepare_clean",
    f"""WITH {CLEAN} SELECT "No", "timestamp", round(pm2_5 + 1e-9, 6) AS pm2_5,
        round("DEWP" + 1e-9, 6) AS "DEWP", round("TEMP" + 1e-9, 6) AS "TEMP",
        round("PRES" + 1e-9, 6) AS "PRES", cbwd, round("Iws" + 1e-9, 6) AS "Iws",
        round("Is" + 1e-9, 6) AS "Is", round("Ir" + 1e-9, 6) AS "Ir", aqi_category,
        round(aqi + 1e-9, 6) AS aqi FROM clean""",
)
def prepare_clean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        prepare(raw_readings(spark, sf)).select(
            "No", "timestamp", "pm2_5", "DEWP", "TEMP", "PRES", "cbwd", "Iws", "Is", "Ir",
            "aqi_category", "aqi",
        )
    )


@query(
    "rename_map",
    'SELECT c_custkey AS "Key", c_name AS "Full_Name", CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer',
)
def rename_map(spark: SparkSession, sf: str) -> DataFrame:
    names = {"c_custkey": "Key", "c_name": "Full_Name", "absent": "never"}
    df = columns.rename_present(table(spark, sf, "customer"), names)
    return df.withColumn("c_nationkey", big("c_nationkey"))


@query("select_present", "SELECT c_acctbal, c_custkey FROM customer")
def select_present(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["c_acctbal", "absent", "c_custkey"]
    return columns.select_present(table(spark, sf, "customer"), wanted, ["c_custkey"])


@query(
    "sanitize",
    "SELECT c_custkey AS cust_key, c_acctbal AS acct_bal FROM customer",
)
def sanitize(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cust.key"), F.col("c_acctbal").alias("acct.bal"), "c_name"
    )
    return columns.drop_present(columns.sanitize_columns(df), "c_name", "absent")
