"""Filters, imputation and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.operators.columns import quoted


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def present(df: DataFrame, name: str) -> Column:
    """True where the column holds a value: not null and, for floats, not NaN."""
    c = F.col(quoted(name))
    return c.isNotNull() & ~F.isnan(c) if _is_float(df, name) else c.isNotNull()


def drop_missing(df: DataFrame, *names: str) -> DataFrame:
    """Rows in which all named columns hold a value."""
    for name in names:
        df = df.filter(present(df, name))
    return df


def impute_mean(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Missing values replaced by the column mean over the present ones.

    All means come from one aggregate over only these columns, read by a scalar
    subquery, so the call stays lazy and adds no join. The columns become double.
    """
    values = {c: F.when(present(df, c), F.col(quoted(c)).cast("double")) for c in names}
    means = df.agg(
        F.struct(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(values.values())]).alias("m")
    ).scalar()
    return df.withColumns(
        {c: F.coalesce(v, means[f"m{i}"]) for i, (c, v) in enumerate(values.items())}
    )


def fill_constant(df: DataFrame, name: str, value: str) -> DataFrame:
    """Null replaced by a constant."""
    return df.withColumn(name, F.coalesce(F.col(quoted(name)), F.lit(value)))


def mode_of(df: DataFrame, name: str) -> DataFrame:
    """One row: the most frequent non-null value and its count; ties go to the smallest value."""
    c = F.col(quoted(name))
    return (
        df.filter(c.isNotNull())
        .groupBy(c.alias(name))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.col(quoted(name)))
        .limit(1)
    )


def fill_mode(df: DataFrame, name: str) -> DataFrame:
    """Null replaced by the most frequent value."""
    mode = mode_of(df, name).select(quoted(name)).scalar()
    return df.withColumn(name, F.coalesce(F.col(quoted(name)), mode))


def drop_warmup(df: DataFrame, *names: str) -> DataFrame:
    """Rows in which all named look-back columns are filled."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(quoted(name)).isNotNull()
    return df.filter(condition)


def dedup(df: DataFrame, keys: Sequence[str], keep_lowest: str) -> DataFrame:
    """One row per key, the one with the lowest ``keep_lowest``; null is higher than any value.

    Of rows equal in both the remaining columns decide, in their order, so the same row is kept on any
    layout (maps have no order and are left out of it). Done as an aggregate, not as a ranking window: copies of a hot key are
    reduced before the shuffle, and no task has to hold or sort them.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(rest)])
    ordered = [c for c in rest if c != keep_lowest and not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    lowest = F.col(quoted(keep_lowest))
    order = F.struct(lowest.isNull().alias("n"), lowest.alias("k"), *[F.col(quoted(c)).alias(f"o{i}") for i, c in enumerate(ordered)])
    kept = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.min_by(row, order).alias("_row"))
    fields = {c: F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(rest)}
    return kept.select(*[fields.get(c, F.col(quoted(c))) for c in df.columns])
