"""Raw readings to the clean table, and the clean table to the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.functions.bands import band, piecewise
from airseries.functions.calendar import assemble_timestamp, calendar_columns
from airseries.functions.naming import slug
from airseries.functions.numeric import interaction_columns
from airseries.operators.clean import drop_missing, drop_warmup, fill_constant, impute_mean
from airseries.operators.columns import sanitize_columns
from airseries.operators.encode import one_hot
from airseries.operators.temporal import (
    RowFrame,
    difference,
    lag,
    rolling_mean,
    with_row_frames,
)

# Column names of the tables, and the values of the categories.
WEATHER = ["DEWP", "TEMP", "PRES", "Iws", "Is", "Ir"]
CALENDAR = [
    "hour",
    "day_of_week",
    "day_of_month",
    "week_of_year",
    "is_weekend",
    "is_rush_hour",
    "is_business_hours",
]
ROLLING = {"pm25": ("pm2_5", [3, 6, 12, 24]), "temp": ("TEMP", [6, 24]), "pres": ("PRES", [6, 24])}
LAGS = {"pm25": ("pm2_5", [1, 3, 6, 12, 24]), "temp": ("TEMP", [6, 24]), "pres": ("PRES", [6])}
DIFFERENCES = {"pm25": ("pm2_5", [1, 24])}
INTERACTIONS = [
    "humidity_ratio",
    "temp_pres_interaction",
    "temp_deviation",
    "pm25_trend",
    "wind_total",
]
WIND_DIRECTIONS = ["NE", "NW", "SE", "cv"]
SEASONS = ["Winter", "Spring", "Summer", "Fall"]
CATEGORIES = [
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
    "Hazardous",
]


def _names(groups: dict[str, tuple[str, list[int]]], kind: str) -> list[str]:
    return [f"{prefix}_{kind}_{n}h" for prefix, (_, sizes) in groups.items() for n in sizes]


FEATURES = [
    *WEATHER,
    *CALENDAR,
    *_names(ROLLING, "rolling"),
    *_names(LAGS, "lag"),
    *_names(DIFFERENCES, "diff"),
    *INTERACTIONS,
    *[f"wind_{d}" for d in WIND_DIRECTIONS],
    *[f"season_{s}" for s in SEASONS],
]
TARGETS = ["pm2_5", "aqi", "aqi_category"]
FEATURE_TABLE = [*TARGETS, "timestamp", *FEATURES]


def prepare(raw: DataFrame, impute: Sequence[str] = WEATHER) -> DataFrame:
    """Clean table: names without dots, timestamp, no missing target, filled weather, bands, index."""
    df = sanitize_columns(raw)
    df = df.withColumn("timestamp", assemble_timestamp("year", "month", "day", "hour"))
    df = drop_missing(df, "pm2_5")
    df = impute_mean(df, impute)
    df = fill_constant(df, "cbwd", "cv")
    return df.withColumns({"aqi_category": band("pm2_5"), "aqi": piecewise("pm2_5")})


def row_frames(causal: bool = False) -> dict[str, RowFrame]:
    """Rolling means, lags and differences by feature name.

    The usual frames hold the current target (``diff + lag`` gives it back), so a
    model on them sees its own label. With ``causal`` all frames end one row
    earlier, under the same names.
    """
    shift = 1 if causal else 0
    frames: dict[str, RowFrame] = {}
    for prefix, (source, sizes) in ROLLING.items():
        for n in sizes:
            frames[f"{prefix}_rolling_{n}h"] = rolling_mean(source, n, shift)
    for prefix, (source, sizes) in LAGS.items():
        for k in sizes:
            frames[f"{prefix}_lag_{k}h"] = lag(source, k)
    for prefix, (source, sizes) in DIFFERENCES.items():
        for k in sizes:
            frames[f"{prefix}_diff_{k}h"] = difference(source, k, shift)
    return frames


def build_features(
    clean: DataFrame,
    order: Sequence[str] = ("timestamp", "No"),
    by: Sequence[str] = (),
    causal: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Feature table of 48 columns (plus ``by`` and ``keep``), without the warm-up rows."""
    # Only these columns are sorted, staged and shuffled.
    needed = [*by, *keep, *order, *TARGETS, "timestamp", *WEATHER, "hour", "month", "cbwd"]
    df = with_row_frames(clean.select(*dict.fromkeys(needed)), row_frames(causal), order, by)
    df = df.withColumns(calendar_columns("timestamp", hour="hour", month="month"))
    df = df.withColumns(interaction_columns())
    df = one_hot(df, "cbwd", WIND_DIRECTIONS, "wind")
    df = one_hot(df, "season", SEASONS, "season")
    warmup = ["pm25_lag_24h", "pm25_rolling_24h"]
    # The causal difference looks one row further back than any lag.
    df = drop_warmup(df, *warmup, *(["pm25_diff_24h"] if causal else []))
    return df.select(*by, *keep, *FEATURE_TABLE)


def category_columns(df: DataFrame) -> DataFrame:
    """0/1 columns of the six bands, for classification."""
    return one_hot(df, "aqi_category", CATEGORIES, "aqi", slug)


def band_summary(df: DataFrame, value: str = "pm2_5") -> DataFrame:
    """Rows, mean value and mean index per band, most frequent first."""
    return (
        df.select(band(value).alias("band"), F.col(value).alias("v"), piecewise(value).alias("i"))
        .groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg("v").alias("avg_value"),
            F.avg("i").alias("avg_index"),
        )
        .orderBy(F.desc("n_rows"), "band")
    )


def profile_by(df: DataFrame, key: str, **measures: Column) -> DataFrame:
    """Named aggregates and the row count per key."""
    return df.groupBy(key).agg(
        *[m.alias(name) for name, m in measures.items()], F.count(F.lit(1)).alias("count")
    )
