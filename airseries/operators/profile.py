"""Profiles: null census, frequencies, summaries, quantiles, outliers, correlations.

Counts and moments take one aggregate pass with map-side partial results; the
long forms are made from the single aggregated row. Quantiles come first, as
constants (see ``quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.operators.clean import present
from airseries.operators.columns import quoted
from airseries.operators.quantiles import quantiles, quantiles_of
from airseries.session import stage


def null_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One wide row: missing values per column (null, and NaN for floats)."""
    names = list(df.columns if columns is None else columns)
    return df.agg(*[F.count_if(~present(df, c)).alias(c) for c in names])


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long form: column, null_count, null_percentage; only columns with gaps, most first."""
    names = list(df.columns if columns is None else columns)
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(~present(df, c)).alias(c) for c in names],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("null_count"))
            for c in names
        ]
    )
    return (
        row.select("_n", F.inline(pairs))
        .filter(F.col("null_count") > 0)
        .select(
            "column",
            "null_count",
            F.round(F.col("null_count") / F.col("_n") * 100, 2).alias("null_percentage"),
        )
        .orderBy(F.desc("null_percentage"), "column")
    )


def frequency(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most frequent first; ties by key."""
    return (
        df.groupBy(*[F.col(quoted(k)) for k in keys])
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), *[F.col(quoted(k)) for k in keys])
    )


def describe_numeric(
    df: DataFrame, columns: Sequence[str], shares: Sequence[tuple[str, float]] = ()
) -> DataFrame:
    """Typed summary in long form: column, count, mean, stddev, min, max and named quantiles.

    The quantiles of all columns share their passes. Columns are numeric; for
    others see ``describe_columns``.
    """
    found = {}
    if shares:
        # Staged once for the passes of the quantiles and the one of the other measures.
        df = stage(df.select(*[F.col(quoted(c)) for c in dict.fromkeys(columns)]), "described")
        found = quantiles_of(df, {c: [p for _, p in shares] for c in columns}, staged=True)

    def stats(name: str) -> Column:
        x = F.when(present(df, name), F.col(quoted(name)).cast("double"))
        parts = [
            F.lit(name).alias("column"),
            F.count(x).alias("count"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("stddev"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        ]
        values = found.get(name, [])
        parts += [_double(v).alias(label) for (label, _), v in zip(shares, values)]
        return F.struct(*parts)

    row = df.agg(F.array(*[stats(c) for c in columns]).alias("s"))
    return row.select(F.inline("s"))


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Summary of columns of any type: count of present values, smallest and largest as text.

    ``mean`` and ``stddev`` are null where a column is no number. One aggregate pass.
    """
    names = list(df.columns if columns is None else columns)

    def stats(name: str) -> Column:
        x = F.when(present(df, name), F.col(quoted(name)))
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        number = x.cast("double") if numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(x).alias("count"),
            F.avg(number).alias("mean"),
            F.stddev_samp(number).alias("stddev"),
            F.min(x).cast("string").alias("min"),
            F.max(x).cast("string").alias("max"),
        )

    row = df.agg(F.array(*[stats(c) for c in names]).alias("s"))
    return row.select(F.inline("s"))


def _double(value: Any) -> Column:
    return F.lit(None if value is None else float(value)).cast("double")


def summary_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``describe_numeric`` with the quartiles."""
    return describe_numeric(df, columns, [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)])


def approx_quantiles(
    df: DataFrame, name: str, probabilities: Sequence[float], error: float = 0.01
) -> list[float]:
    """Quantiles with a rank error of at most ``error`` of the rows, in one pass."""
    return df.approxQuantile(quoted(name), list(probabilities), error)


@dataclass(frozen=True)
class Fences:
    """Quartiles and the limits ``q1 - k*iqr`` and ``q3 + k*iqr``; all None without values."""

    q1: float | None
    median: float | None
    q3: float | None
    lower: float | None
    upper: float | None


def outlier_fences(df: DataFrame, name: str, k: float = 3.0, staged: bool = False) -> Fences:
    """Fences of a column, from its exact quartiles."""
    found = quantiles(df, name, [0.25, 0.5, 0.75], staged=staged)
    if found[0] is None:
        return Fences(None, None, None, None, None)
    q1, median, q3 = map(float, found)
    return Fences(q1, median, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))


def outside(name: str, fences: Fences) -> Column:
    """True for values beyond the fences, by constants that reach the file scan."""
    c = F.col(quoted(name))
    return (c < _double(fences.lower)) | (c > _double(fences.upper))


def flag_outliers(df: DataFrame, name: str, k: float = 3.0, out: str = "is_outlier") -> DataFrame:
    """Adds a flag for values outside the fences; no row is removed."""
    return df.withColumn(out, outside(name, outlier_fences(df, name, k)))


def outlier_report(df: DataFrame, name: str, k: float = 3.0) -> DataFrame:
    """One row: fences, rows outside and their percentage of all rows."""
    df = stage(df.select(quoted(name)), "values")
    fences = outlier_fences(df, name, k, staged=True)
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(outside(name, fences)).alias("outliers")
    )
    return counted.select(
        *[_double(v).alias(f) for f, v in vars(fences).items()],
        "outliers",
        "total",
        (F.try_divide(F.col("outliers"), F.col("total")) * 100).alias("outlier_percentage"),
    )


def retention(df: DataFrame, keep: Column) -> DataFrame:
    """One row: rows before, after and removed by a condition, and the percentage kept."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(keep).alias("rows_after")
    ).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        (F.try_divide(F.col("rows_after"), F.col("rows_before")) * 100).alias("percent_kept"),
    )


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlation of the target with each listed column that exists, strongest first."""
    names = [c for c in columns if c in df.columns]
    t = F.col(quoted(target)).cast("double")
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.corr(t, F.col(quoted(c)).cast("double")).alias("correlation"),
                )
                for c in names
            ]
        ).alias("s")
    )
    return row.select(F.inline("s")).orderBy(F.desc(F.abs("correlation")), "feature")


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(F.col(quoted(name))).distinct()
