"""Interval joins: points in time with the intervals that hold them, or totals over these."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.functions.times import time_number, time_unit
from airseries.operators.columns import quoted
from airseries.session import stage

#: Cells of one level that make up a cell of the next: 8, as bits.
_BITS = 3
RADIX = 1 << _BITS
#: Levels that any span of 64-bit times needs at most.
_MOST_LEVELS = 22


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    ts: str,
    start: str,
    end: str,
    by: Sequence[str] = (),
    closed: str = "left",
    how: str = "inner",
    cell_seconds: float = 1.0,
    prefix: str = "interval_",
) -> DataFrame:
    """Every point with every interval of the same ``by`` that holds it; the interval's columns come under ``prefix``.

    ``closed`` is ``left`` (start <= time < end) or ``both`` (start <= time <= end). A null start or end is open: the interval
    has no bound there. An interval that ends before it starts holds nothing. ``how`` is ``inner`` or ``left``,
    which keeps points without an interval. Points without a time and null keys match nothing.

    Time is cut into cells of ``cell_seconds`` (numbers: units), 8 of which make a cell of the next level, and so on. An
    interval is cut into the largest cells that fit, fourteen a level at most; a point looks into its
    one cell of each level that intervals use. They meet by an equi-join on the cell, each pair once, and only
    pairs in the first or last small cell of an interval can turn out not to match. So a very
    long interval costs a few dozen rows, not one per cell, no range condition becomes a cross join, and a hot cell makes no
    pairs but those that are in the result.
    """
    if closed not in ("left", "both") or how not in ("inner", "left"):
        raise ValueError(f"closed {closed} or how {how} is not known")
    unit = cell_seconds * time_unit(points, ts)
    exact = not any(isinstance(d.schema[c].dataType, (T.FloatType, T.DoubleType, T.DecimalType)) for d, c in ((points, ts), (intervals, start), (intervals, end)))
    at = time_number(points, ts)
    lo, hi = time_number(intervals, start), time_number(intervals, end)
    marked = points.select(
        F.monotonically_increasing_id().alias("_number"),
        *[F.col(quoted(c)).alias(f"_k{i}") for i, c in enumerate(by)],
        # An infinite time is in no cell.
        F.when(F.abs(at) < F.lit(float("inf")), at).alias("_at"),
        F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(points.columns)]).alias("_point"),
    )
    # Numbered once for both uses, and read again for the bounds of the points.
    marked = stage(marked, "points")
    first, last = marked.agg(F.min("_at"), F.max("_at")).first()
    first, last = (0, 0) if first is None else (first, last)
    # Beyond the points nothing can match, so open and longer intervals end there.
    held = intervals.select(
        *[F.col(quoted(c)).alias(f"_k{i}") for i, c in enumerate(by)],
        lo.alias("_lo"),
        hi.alias("_hi"),
        _cell(F.greatest(F.coalesce(lo, F.lit(first)), F.lit(first)), unit, exact).alias("_from"),
        (_cell(F.least(F.coalesce(hi, F.lit(last)), F.lit(last)), unit, exact) + 1).alias("_to"),
        F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(intervals.columns)]).alias("_interval"),
        # A time that is there but is no number bounds nothing sensibly.
        (F.col(quoted(start)).isNotNull() & lo.isNull() | F.col(quoted(end)).isNotNull() & hi.isNull()).alias("_odd"),
    ).where("_from < _to AND NOT _odd")
    longest = held.agg(F.max(F.col("_to") - F.col("_from"))).first()[0] or 1
    levels = min(_MOST_LEVELS, next(k for k in range(_MOST_LEVELS + 1) if RADIX**k >= longest) + 1)
    cells = F.concat(*[_cells_of_level(k, k == levels - 1) for k in range(levels)])
    cut = held.select("*", F.inline(cells)).drop("_from", "_to", "_odd")
    used = sorted(r[0] for r in cut.select("_level").distinct().collect())
    looks = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright("_in", _BITS * k).alias("_cell")) for k in used or [0]])
    looking = marked.where("_at IS NOT NULL").withColumn("_in", _cell(F.col("_at"), unit, exact)).select("*", F.inline(looks)).drop("_in")
    keys = ["_level", "_cell", *[f"_k{i}" for i in range(len(by))]]
    inside = (F.col("_lo").isNull() | (F.col("_lo") <= F.col("_at"))) & (
        F.col("_hi").isNull() | (F.col("_at") < F.col("_hi") if closed == "left" else F.col("_at") <= F.col("_hi"))
    )
    found = looking.join(cut, keys).where(inside).select("_number", "_point", "_interval")
    if how == "left":
        rest = marked.join(found.select("_number"), "_number", "left_anti")
        none = F.lit(None).cast(found.schema["_interval"].dataType)
        found = found.unionByName(rest.select("_number", "_point", none.alias("_interval")))
    return found.select(
        *[F.col("_point")[f"c{i}"].alias(c) for i, c in enumerate(points.columns)],
        *[F.col("_interval")[f"c{i}"].alias(prefix + c) for i, c in enumerate(intervals.columns)],
    )


#: Totals that can be added up from parts: how a part is made of a column, and how parts meet.
_TOTALS = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def interval_totals(
    points: DataFrame,
    intervals: DataFrame,
    ts: str,
    start: str,
    end: str,
    totals: Mapping[str, tuple[str, str]],
    by: Sequence[str] = (),
    closed: str = "left",
) -> DataFrame:
    """Every point with totals over the intervals of the same ``by`` that hold it, without a row for each pair.

    ``totals`` names new columns, each ``(kind, interval column)`` with the kind ``count``, ``sum``, ``min`` or ``max``. Bounds,
    missing times and null keys are as in :func:`interval_join` with ``how="left"``: a point in no interval has counts of 0 and
    nulls. Times must be timestamps, dates or whole numbers.

    Intervals are cut as there, but down to single units of time, so no pair has to be checked: totals are added up
    per cell first, and a point adds up those of its one cell of each level. The work is that of points plus
    intervals, even where every interval holds every point.
    """
    if closed not in ("left", "both") or any(kind not in _TOTALS for kind, _ in totals.values()):
        raise ValueError(f"closed {closed} or totals {totals} are not known")
    if any(isinstance(d.schema[c].dataType, (T.FloatType, T.DoubleType, T.DecimalType)) for d, c in ((points, ts), (intervals, start), (intervals, end))):
        raise ValueError("times must be timestamps, dates or whole numbers")
    keys = [f"_k{i}" for i in range(len(by))]
    marked = points.select(
        time_number(points, ts).alias("_at"),
        *[F.col(quoted(c)).alias(k) for k, c in zip(keys, by, strict=True)],
        F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(points.columns)]).alias("_point"),
    )
    # Read for the bounds, for the times to look up, and for the result.
    marked = stage(marked, "points")
    first, last = marked.agg(F.min("_at"), F.max("_at")).first()
    first, last = (0, 0) if first is None else (first, last)
    lo, hi = time_number(intervals, start), time_number(intervals, end)
    names = [f"_t{i}" for i in range(len(totals))]
    # Times count from the first point; beyond the points nothing can match.
    spans = (
        intervals.where((hi.isNull() | (hi > first if closed == "left" else hi >= first)) & (lo.isNull() | (lo <= last)))
        .select(
            *[F.col(quoted(c)).alias(k) for k, c in zip(keys, by, strict=True)],
            (F.greatest(F.coalesce(lo, F.lit(first)), F.lit(first)) - first).alias("_from"),
            (F.least(F.coalesce(hi - 1 if closed == "left" else hi, F.lit(last)), F.lit(last)) - first + 1).alias("_to"),
            *[F.col(quoted(c)).alias(n) for n, (_, c) in zip(names, totals.values(), strict=True)],
        )
        .where("_from < _to")
    )
    kinds = [_TOTALS[kind] for kind, _ in totals.values()]
    parts = [make(n).alias(n) for n, (make, _) in zip(names, kinds, strict=True)]
    meet = [add(n).alias(n) for n, (_, add) in zip(names, kinds, strict=True)]
    spans = stage(spans.groupBy(*keys, "_from", "_to").agg(*parts), "spans")
    longest = spans.agg(F.max(F.col("_to") - F.col("_from"))).first()[0] or 1
    levels = min(_MOST_LEVELS, next(k for k in range(_MOST_LEVELS + 1) if RADIX**k >= longest) + 1)
    cells = F.concat(*[_cells_of_level(k, k == levels - 1) for k in range(levels)])
    cut = spans.select(*keys, *names, F.inline(cells)).groupBy("_level", "_cell", *keys).agg(*meet)
    looks = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright(F.col("_at") - first, _BITS * k).alias("_cell")) for k in range(levels)])
    times = marked.select("_at", *keys).dropna().distinct()
    found = times.select("*", F.inline(looks)).join(cut, ["_level", "_cell", *keys]).groupBy("_at", *keys).agg(*meet)
    out = marked.join(found, ["_at", *keys], "left")
    return out.select(
        *[F.col("_point")[f"c{i}"].alias(c) for i, c in enumerate(points.columns)],
        *[
            (F.coalesce(F.col(n), F.lit(0)) if kind == "count" else F.col(n)).alias(name)
            for n, (name, (kind, _)) in zip(names, totals.items(), strict=True)
        ],
    )


def _cell(at: Column, unit: float, whole_times: bool) -> Column:
    """The small cell of a time."""
    if whole_times and float(unit).is_integer():
        whole = F.lit(int(unit)).cast("long")
        number = at.cast("long")
        return F.call_function("div", number - F.pmod(number, whole), whole)
    return F.floor(at.cast("double") / F.lit(unit)).cast("long")


def _cells_of_level(k: int, top: bool) -> Column:
    """Cells of level ``k`` that the cover of ``_from`` to ``_to`` uses: those before the first and
    after the last whole cell of the next level; all of them where none is whole, and at the top."""

    def up(c: str, level: int) -> Column:
        return -F.shiftright(-F.col(c), _BITS * level)

    def down(c: str, level: int) -> Column:
        return F.shiftright(F.col(c), _BITS * level)

    def cells(lo: Column, hi: Column) -> Column:
        numbers = F.when(lo < hi, F.sequence(lo, F.greatest(hi - 1, lo))).otherwise(F.array().cast("array<long>"))
        return F.transform(numbers, lambda n: F.struct(F.lit(k).alias("_level"), n.alias("_cell")))

    lo, hi = up("_from", k), down("_to", k)
    if top:
        return cells(lo, hi)
    inner_lo, inner_hi = up("_from", k + 1), down("_to", k + 1)
    whole = inner_lo <= inner_hi
    return F.concat(
        cells(lo, F.when(whole, inner_lo * RADIX).otherwise(hi)),
        cells(F.when(whole, inner_hi * RADIX).otherwise(hi), hi),
    )
