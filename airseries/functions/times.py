"""Points in time as numbers that can be subtracted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.operators.columns import quoted

_SECOND = 1_000_000


def time_unit(df: DataFrame, name: str) -> int:
    """Units of :func:`time_number` in a second; 1 for a column of numbers, which has its own unit."""
    return _SECOND if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) else 1


def time_number(df: DataFrame, name: str) -> Column:
    """Microseconds as long for times and dates, the value itself for numbers; NaN is missing, like null."""
    c, kind = F.col(quoted(name)), df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * 86_400 * _SECOND
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    number = c.cast("double")
    return F.when(~F.isnan(number), number)
