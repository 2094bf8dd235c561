"""Row frames (rolling means, lags, differences) and time-range frames at any size."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from airseries.operators.columns import quoted
from airseries.operators.ordering import (
    PART,
    POS,
    ROWS_PER_TILE,
    TILE,
    Tile,
    running_start,
    sorted_tiles,
    tile_list,
)
from airseries.session import stage

# Binary orders of magnitude that share one exact running sum. A double has 53
# digits, 2^40 rows add 40 more, and a decimal holds 126.
SUM_BITS = 32


@dataclass(frozen=True)
class RowFrame:
    """A window expression, how many rows it looks back and how many ahead."""

    lookback: int
    build: Callable[[WindowSpec], Column]
    lookahead: int = 0


def rolling_mean(name: str, n: int, shift: int = 0) -> RowFrame:
    """Mean of ``n`` rows ending ``shift`` rows before the current one (0: with the current row)."""
    first, last = -(n - 1) - shift, -shift
    return RowFrame(
        n - 1 + shift, lambda w: F.avg(quoted(name)).over(w.rowsBetween(first, last))
    )


def lag(name: str, k: int) -> RowFrame:
    """The value ``k`` rows back; null where there is none."""
    return RowFrame(k, lambda w: F.lag(quoted(name), k).over(w))


def lead(name: str, k: int) -> RowFrame:
    """The value ``k`` rows ahead; null where there is none. The target of a forecast over ``k`` rows."""
    return RowFrame(0, lambda w: F.lead(quoted(name), k).over(w), k)


def centred(name: str, n: int, of: Callable[[Column], Column] = F.avg) -> RowFrame:
    """An aggregate (by default the mean) of the ``n`` rows before, the row itself and the ``n`` after it."""
    return RowFrame(n, lambda w: of(F.col(quoted(name))).over(w.rowsBetween(-n, n)), n)


def difference(name: str, k: int, shift: int = 0) -> RowFrame:
    """The value ``shift`` rows back minus the value ``k`` rows before that."""

    def build(w: WindowSpec) -> Column:
        now = F.lag(quoted(name), shift).over(w) if shift else F.col(quoted(name))
        return now - F.lag(quoted(name), k + shift).over(w)

    return RowFrame(k + shift, build)


def with_row_frames(
    df: DataFrame,
    frames: Mapping[str, RowFrame],
    order: Sequence[str],
    by: Sequence[str] = (),
    rows_per_tile: int = ROWS_PER_TILE,
) -> DataFrame:
    """Adds one column per row frame.

    ``by + order`` must be unique, else ties would make the result undefined.
    The total order is cut into sorted tiles, with or without a key and whatever the
    size of a series. A row whose longest looks back and ahead lie in its tile takes its frames there,
    without a shuffle. The first and last rows of each tile are worked on apart, together with
    copies of the rows before and after them; only these rows move. All frames share one sort.
    """
    if not frames:
        return df
    keys = [F.col(quoted(c)) for c in by]
    back = max(f.lookback for f in frames.values())
    ahead = max(f.lookahead for f in frames.values())
    tiles = sorted_tiles(df, [*by, *order], rows_per_tile)

    def framed(rows: DataFrame, stretch: Sequence[str], at: str) -> DataFrame:
        window = Window.partitionBy(*stretch, *keys).orderBy(at)
        return rows.withColumns({name: f.build(window) for name, f in frames.items()})

    names = [quoted(c) for c in [*df.columns, *frames]]
    inside = framed(tiles, [PART, TILE], POS)
    held = tile_list(tiles, rows_per_tile)
    if back == ahead == 0 or len(held) < 2:
        return inside.select(*names)
    # One row per tile.
    edges = F.broadcast(tiles.sparkSession.createDataFrame(_edges(held, back, ahead), EDGES))
    index = F.col("_start") + F.col(POS)
    copies = F.transform(
        F.filter("_groups", lambda g: index.between(g.lo, g.hi)),
        lambda g: F.struct(g.edge.alias("_edge"), index.between(g.first, g.last).alias("_own")),
    )
    near = tiles.join(edges, TILE).withColumn("_at", index)
    apart = near.select("*", F.inline(copies))
    whole = inside.join(edges, TILE).where(index.between(F.col("_first"), F.col("_last")))
    return whole.select(*names).unionByName(framed(apart, ["_edge"], "_at").where("_own").select(*names))


EDGES = (
    f"{TILE} long, _start long, _first long, _last long,"
    " _groups array<struct<edge: long, first: long, last: long, lo: long, hi: long>>"
)


def _edges(tiles: Sequence[Tile], back: int, ahead: int) -> list[tuple]:
    """Each tile with the rows that find their frames in it, and the groups at edges its rows take part in.

    A group works on the rows ``first`` to ``last`` at the front or the end of a tile
    and needs the rows ``lo`` to ``hi``, which may lie in several tiles where tiles are short.
    """
    total = tiles[-1].start + tiles[-1].size
    spans, groups = [], []
    for i, tile in enumerate(tiles):
        end = tile.start + tile.size
        first = min(tile.start + back, end) if i else tile.start
        last = max(end - ahead, first) if end < total else end
        spans.append((first, last - 1))
        for side, (a, b) in enumerate(((tile.start, first), (last, end))):
            if a < b:
                groups.append((2 * i + side, a, b - 1, max(0, a - back), b - 1 + ahead))
    # Groups and tiles are both in order; a tile's groups follow each other.
    out, begin = [], 0
    for tile, (first, last) in zip(tiles, spans, strict=True):
        end = tile.start + tile.size
        while begin < len(groups) and groups[begin][4] < tile.start:
            begin += 1
        met = []
        for group in groups[begin:]:
            if group[3] >= end:
                break
            if group[4] >= tile.start:
                met.append(group)
        out.append((tile.number, tile.start, first, last, met))
    return out


def magnitudes(df: DataFrame, value: Column) -> list[int]:
    """The groups of SUM_BITS binary orders of magnitude that the values fall into, at most 66."""
    group = _magnitude(value)
    row = df.select(group.alias("g")).agg(F.sort_array(F.collect_set("g"))).first()
    return list(row[0])


def _magnitude(value: Column) -> Column:
    """Group of a finite value other than zero; null for all others."""
    return F.when(value != 0, F.floor(F.log2(F.abs(value)) / SUM_BITS).cast("int"))


def range_mean(
    df: DataFrame,
    name: str,
    hours: int,
    ts: str,
    row_id: str,
    by: Sequence[str] = (),
    out: str = "range_mean",
) -> DataFrame:
    """Mean over the rows at most ``hours`` before each row's time, both ends included.

    Returns ``by``, ``ts``, ``row_id`` and the mean; ``row_id`` must be unique.
    Values that are null, NaN or infinite are missing: they count in no mean, and
    a frame without any value has none.

    A frame can hold any share of the table, so no frame is gathered: each row
    sends one mark to the start and one to the end of its frame, rows and marks
    are sorted together, and the mean follows from the difference of two running
    sums. Each sum is a whole number in units far below its values' last digit, one
    for each group of magnitudes that occurs, so differences lose nothing at any
    size and any mix of values.
    """
    keys = [F.col(quoted(c)) for c in by]
    cols = [*keys, F.col(quoted(ts)), F.col(quoted(row_id))]
    number = F.col(quoted(name)).cast("double")
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    value = F.col("_value")
    df = stage(df.select(*cols, finite.alias("_value")), "values")
    groups = magnitudes(df, value)

    # Marks sort before (start) or after (end) the rows with the same time.
    start, row, end = 0, 1, 2
    zero = F.lit(0).cast("decimal(38,0)")
    at = F.col(quoted(ts))
    # Scaled in two steps, as the factor itself can be beyond the range of a double.
    halves = {g: (52 - SUM_BITS * g) / 2 for g in groups}

    def weight(group: int) -> Column:
        step = F.lit(2.0 ** int(halves[group]))
        rest = F.lit(2.0 ** (52 - SUM_BITS * group - int(halves[group])))
        whole = (value * step * rest).cast("decimal(38,0)")
        return F.when(_magnitude(value) == group, whole)

    def record(kind: int, when: Column, filled: bool) -> Column:
        sums = [
            F.coalesce(weight(g) if filled else zero, zero).alias(f"_w{i}")
            for i, g in enumerate(groups)
        ]
        count = value.isNotNull().cast("long") if filled else F.lit(0).cast("long")
        return F.struct(when.alias("_at"), F.lit(kind).alias("_kind"), count.alias("_c"), *sums)

    records = F.array(
        record(start, at - F.expr(f"INTERVAL '{int(hours)}' HOUR"), False),
        record(row, at, True),
        record(end, at, False),
    )
    measures = ["_c", *[f"_w{i}" for i in range(len(groups))]]
    tiles = sorted_tiles(df.select(*cols, F.inline(records)), [*by, "_at", "_kind", row_id], staged=True)
    # Differences are taken within one series only, so the running sums may go
    # on from one series to the next; each window below holds one tile.
    sums = tiles.groupBy(PART, TILE).agg(*[F.sum(m).alias(m) for m in measures])
    totals = running_start(sums, *measures)
    # One row per tile.
    starts = F.broadcast(totals.select(TILE, *[f"{m}_start" for m in measures]))
    inside = Window.partitionBy(PART, TILE).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    summed = tiles.withColumns({f"{m}_run": F.sum(m).over(inside) for m in measures}).join(starts, TILE)

    def within(measure: str) -> Column:
        def at_mark(kind: int) -> Column:
            running = F.col(f"{measure}_run") + F.col(f"{measure}_start")
            return F.max(F.when(F.col("_kind") == kind, running))

        return at_mark(end) - at_mark(start)

    ends = summed.filter(F.col("_kind") != row).groupBy(*cols).agg(
        *[within(m).alias(m) for m in measures]
    )
    # The largest magnitudes last: small ones are added up before they meet large ones.
    total = F.lit(0.0)
    for i, g in enumerate(groups):
        step = F.lit(2.0 ** -int(halves[g]))
        rest = F.lit(2.0 ** -(52 - SUM_BITS * g - int(halves[g])))
        total = total + F.col(f"_w{i}").cast("double") / F.col("_c") * rest * step
    mean = F.when(F.col("_c") > 0, total)
    return ends.select(*cols, mean.alias(out))
