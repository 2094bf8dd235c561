"""Exact quantiles of columns of any size.

One sketch over the whole table would have to be merged in one task, and its
partial sketches grow with the number of files. Here columns are counted in
buckets instead: each round keeps only the buckets that hold a wanted rank, so
the span looked at shrinks about a thousandfold per round, until it holds one
value. No task or driver ever sees more than the counts of a round.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.operators.clean import present
from airseries.operators.columns import quoted
from airseries.session import stage

# Buckets per round and wanted span.
BUCKETS = 1024

# Doubles below this are scaled up, so that halves of their differences are not zero.
TINY = 1e-200


@dataclass(frozen=True)
class _Span:
    """Values from ``low`` to ``high`` (as text, exact), with ``below`` smaller ones in the table."""

    low: str
    high: str
    below: int


class _Values:
    """A column as values to compare and as numbers to cut into buckets."""

    def __init__(self, df: DataFrame, name: str):
        self.kind = df.schema[name].dataType
        self.x = F.when(present(df, name), F.col(quoted(name)))
        self.floating = isinstance(self.kind, (T.FloatType, T.DoubleType))

    def at(self, text: str) -> Column:
        return F.lit(text).cast(self.kind)

    def number(self, x: Column) -> Column:
        """Whole numbers that rise with the value; not for floats and decimals."""
        if isinstance(self.kind, T.TimestampNTZType):
            start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            return F.timestamp_diff("MICROSECOND", start, x)
        if isinstance(self.kind, T.TimestampType):
            return F.unix_micros(x)
        if isinstance(self.kind, T.DateType):
            return F.unix_date(x).cast("long")
        return x.cast("long")

    def bounds(self) -> list[Column]:
        """Rows, smallest and largest of the finite values; rows below and above all finite ones."""
        if not self.floating:
            none = F.lit(0).cast("long")
            return [F.count(self.x), *self._ends(self.x), none, none]
        low, high = F.lit(-math.inf), F.lit(math.inf)
        finite = F.when((self.x > low) & (self.x < high), self.x)
        return [F.count(finite), *self._ends(finite), F.count_if(self.x == low), F.count_if(self.x == high)]

    @staticmethod
    def _ends(x: Column) -> list[Column]:
        return [F.min(x).cast("string"), F.max(x).cast("string")]

    def bucket(self, span: _Span, buckets: int) -> Column:
        """Bucket within the span, null outside; it never falls while the value rises.

        The smallest value has the first bucket and the largest the last one, so a
        round always splits a span of two values or more.
        """
        low, high = self.at(span.low), self.at(span.high)
        if self.floating:
            # Halved, so that the difference of two huge numbers stays finite.
            top = max(abs(float(span.low)), abs(float(span.high)))
            scale = 2.0**600 if top < TINY else 0.5
            share = (self.x.cast("double") * scale - low.cast("double") * scale) / (
                high.cast("double") * scale - low.cast("double") * scale
            )
            inner = F.floor(share * buckets)
        elif isinstance(self.kind, T.DecimalType):
            with localcontext(prec=100):
                step = Decimal(1).scaleb(-self.kind.scale)
                width = ((Decimal(span.high) - Decimal(span.low)) / buckets // step + 1) * step
            wide = f"decimal({min(38, self.kind.precision + 1)},{self.kind.scale})"
            gap = self.x.cast(wide) - low.cast(wide)
            inner = F.floor(gap / F.lit(str(width)).cast(wide))
        else:
            inner = F.floor(
                (self.number(self.x).cast("decimal(38,0)") - self.number(low).cast("decimal(38,0)"))
                * buckets
                / (self.number(high).cast("decimal(38,0)") - self.number(low).cast("decimal(38,0)"))
            )
        inner = F.least(F.greatest(inner.cast("int"), F.lit(1)), F.lit(buckets - 2))
        return (
            F.when(self.x.isNull() | (self.x < low) | (self.x > high), None)
            .when(self.x == low, 0)
            .when(self.x == high, buckets - 1)
            .otherwise(inner)
        )

    def value(self, text: str) -> Any:
        if isinstance(self.kind, T.IntegralType):
            return int(text)
        if isinstance(self.kind, T.DecimalType):
            return Decimal(text)
        return float(text) if self.floating else text


def rank(p: float, rows: int) -> int:
    """Rank from 1 of the smallest value with at least the share ``p`` of all values at or below it."""
    return max(1, math.ceil(Fraction(str(p)) * rows))


def quantiles(
    df: DataFrame, name: str, probabilities: Sequence[float], buckets: int = BUCKETS, staged: bool = False
) -> list[Any]:
    """Exact quantiles of the present values of one column; see ``quantiles_of``."""
    return quantiles_of(df, {name: probabilities}, buckets, staged)[name]


def quantiles_of(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], buckets: int = BUCKETS, staged: bool = False
) -> dict[str, list[Any]]:
    """Exact quantiles of the present values of several columns.

    Integers, floats and decimals come back as such (decimals exactly), dates and
    times as text; ``None`` where a column has no value. One pass finds the bounds
    of all columns; each round is one pass over them, for all columns and ranks
    that are still open. The passes read the wanted columns from a staged table, so what they
    come from is evaluated once (``staged``: ``df`` already reads a staged table).
    """
    names = list(wanted)
    if not names:
        return {}
    columns = {name: _Values(df, name) for name in names}
    kept = df.select(*[F.col(quoted(c)) for c in names])
    kept = kept if staged else stage(kept, "values")
    first = kept.agg(*[b for name in names for b in columns[name].bounds()]).first()
    found: dict[tuple[str, int], Any] = {}
    spans: dict[tuple[str, int], _Span] = {}
    totals = {}
    for i, name in enumerate(names):
        rows, low, high, below, above = first[5 * i : 5 * i + 5]
        totals[name] = below + rows + above
        for r in {rank(p, totals[name]) for p in wanted[name]} if totals[name] else ():
            if r <= below:
                found[name, r] = -math.inf
            elif r > below + rows:
                found[name, r] = math.inf
            else:
                spans[name, r] = _Span(low, high, below)
    while True:
        for (name, r), span in list(spans.items()):
            if span.low == span.high:
                found[name, r] = columns[name].value(span.low)
                del spans[name, r]
        if not spans:
            break
        spans = _narrow(kept, columns, spans, buckets)
    return {
        name: [found[name, rank(p, totals[name])] if totals[name] else None for p in wanted[name]]
        for name in names
    }


def _narrow(
    kept: DataFrame,
    columns: Mapping[str, _Values],
    spans: Mapping[tuple[str, int], _Span],
    buckets: int,
) -> dict[tuple[str, int], _Span]:
    """For each rank the bucket of its span that holds it, from one pass over all columns."""
    distinct = list(dict.fromkeys((name, span) for (name, _), span in spans.items()))
    open_columns = list(dict.fromkeys(name for name, _ in distinct))
    keys, ends = [], []
    for name in open_columns:
        key = F.lit(None).cast("int")
        for i, (owner, span) in enumerate(distinct):
            if owner == name:
                key = F.coalesce(key, F.lit(i * buckets) + columns[name].bucket(span, buckets))
        keys.append(key)
        ends.append(columns[name].x)
    cells = F.array(*[F.struct(F.lit(i).alias("c"), k.alias("key")) for i, k in enumerate(keys)])
    exploded = kept.select(
        *[x.alias(f"x{i}") for i, x in enumerate(ends)], F.inline(cells)
    ).filter("key is not null")
    # At most BUCKETS rows per span reach the driver.
    sides = [
        side(F.when(F.col("c") == i, F.col(f"x{i}"))).cast("string")
        for i in range(len(ends))
        for side in (F.min, F.max)
    ]
    counted = exploded.groupBy("c", "key").agg(F.count(F.lit(1)).alias("rows"), *sides).collect()
    by_span: dict[int, list] = {}
    for row in sorted(counted, key=lambda x: x.key):
        by_span.setdefault(row.key // buckets, []).append(row)
    out = {}
    for (name, r), span in spans.items():
        below = span.below
        for row in by_span[distinct.index((name, span))]:
            if r <= below + row.rows:
                low, high = row[3 + 2 * row.c], row[4 + 2 * row.c]
                out[name, r] = _Span(low, high, below)
                break
            below += row.rows
    return out
