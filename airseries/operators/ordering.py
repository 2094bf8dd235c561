"""A total order over a whole table, without a task that sees more than its share.

``Window.orderBy`` without a key moves every row to one task, and a window keyed
by series moves a whole series to one task. Here the rows are range-sorted over
a key that is unique, so a hot series, hour or timestamp is cut up like any
other, and the row numbers follow from the partition sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airseries.operators.columns import quoted
from airseries.session import stage, stage_buckets

PART, TILE, POS, INDEX = "_part", "_tile", "_pos", "_index"

# Rows of one sorted tile at most, roughly; a few hundred MB of narrow rows.
ROWS_PER_TILE = 4_000_000

# Documented layout of monotonically_increasing_id: partition above, row below.
_POSITION_BITS = 33
# A tile's number: its sort partition above, its place in the partition below.
_PLACE_BITS = 32


def tile_count(rows: int, partitions: int, rows_per_tile: int = ROWS_PER_TILE) -> int:
    """Sort partitions for so many rows: as many as there are shuffle partitions, more if they would grow too large."""
    return max(partitions, -(-rows // rows_per_tile))


def sorted_tiles(
    df: DataFrame, order: Sequence[str], rows_per_tile: int = ROWS_PER_TILE, staged: bool = False
) -> DataFrame:
    """Range-sort by ``order`` (which must be unique) and keep sort partition, tile and position of each row.

    A tile is a sorted partition, or a stretch of ``rows_per_tile`` rows of one where it has more; tiles follow each
    other in order. Tiles may be small without a task, a file and a sample of sort keys for each. The input is
    staged, so that counting, range sampling and sorting read it from there instead of evaluating
    it three times (``staged``: it already reads a staged table). The rows are counted before the sort, so a sort partition has about ROWS_PER_TILE rows at most
    whatever ``spark.sql.shuffle.partitions`` says. The result is staged too,
    because a second evaluation could draw other range bounds, and bucketed by sort partition: windows
    and groups by PART and TILE read it without another shuffle.
    """
    keys = [F.col(quoted(c)) for c in order]
    spark = df.sparkSession
    source = df if staged else stage(df, "unsorted")
    parts = tile_count(
        source.count(), int(spark.conf.get("spark.sql.shuffle.partitions")), max(rows_per_tile, ROWS_PER_TILE)
    )
    number = F.monotonically_increasing_id()
    mask = (1 << _POSITION_BITS) - 1
    ranged = source.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_number", number)
    place, size = F.col("_number").bitwiseAND(F.lit(mask)), F.lit(rows_per_tile).cast("long")
    part = F.shiftright("_number", _POSITION_BITS)
    placed = ranged.withColumns(
        {
            PART: part,
            TILE: F.shiftleft(part, _PLACE_BITS) + F.call_function("div", place, size),
            POS: F.pmod(place, size),
        }
    )
    # Sort partitions meet in buckets by hash; twice as many buckets keep most of them apart.
    return stage_buckets(placed.drop("_number"), "sorted", [PART], 2 * parts)


@dataclass(frozen=True)
class Tile:
    """A tile that holds rows: its number, the rows before it, and its rows."""

    number: int
    start: int
    size: int


def tile_list(tiles: DataFrame, rows_per_tile: int = ROWS_PER_TILE) -> list[Tile]:
    """All tiles that hold rows, in order; only the sizes of the sort partitions are collected."""
    sizes = tiles.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).orderBy(PART).collect()
    out, start = [], 0
    for part, n in sizes:
        for place, at in enumerate(range(0, n, rows_per_tile)):
            size = min(rows_per_tile, n - at)
            out.append(Tile((part << _PLACE_BITS) + place, start, size))
            start += size
    return out


def running_start(totals: DataFrame, *measures: str) -> DataFrame:
    """Adds ``<measure>_start``: the sum over all earlier tiles.

    ``totals`` has one row per tile, so the unkeyed window below holds no more
    rows than there are tiles.
    """
    before = Window.orderBy(TILE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns(
        {f"{m}_start": F.coalesce(F.sum(m).over(before), F.lit(0)) for m in measures}
    )


def index_tiles(tiles: DataFrame, name: str = INDEX) -> DataFrame:
    """Dense row number from 0 over all tiles, in their order."""
    sizes = running_start(tiles.groupBy(PART, TILE).agg(F.count(F.lit(1)).alias("n")), "n")
    # One row per tile: one for each few million rows.
    starts = F.broadcast(sizes.select(TILE, "n_start"))
    return tiles.join(starts, TILE).withColumn(name, F.col("n_start") + F.col(POS)).drop(
        PART, TILE, POS, "n_start"
    )


def with_row_index(df: DataFrame, order: Sequence[str], name: str = INDEX) -> DataFrame:
    """Adds the dense row number of the total order ``order`` (which must be unique)."""
    return index_tiles(sorted_tiles(df, order), name)
