"""Sessions: stretches of rows without a longer gap between them, at any length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airseries.functions.times import time_number, time_unit
from airseries.operators.columns import quoted
from airseries.operators.ordering import PART, POS, ROWS_PER_TILE, TILE, running_start, sorted_tiles


def with_sessions(
    df: DataFrame,
    ts: str,
    row_id: str,
    gap: float,
    by: Sequence[str] = (),
    out: str = "session",
    rows_per_tile: int = ROWS_PER_TILE,
) -> DataFrame:
    """Adds the number of each row's session, from 0 in the order of ``by`` and time.

    A session ends where the next row of the same ``by`` comes more than ``gap`` seconds later (numbers: units).
    ``row_id`` must be unique. Rows without a time (null, NaN) belong to no session, their number is null;
    null is a key like any other.

    Gaps are found inside sorted tiles, where a window reads the tile as it lies. A tile's
    first row is compared with the last row before it, which the tile before hands on, and the numbers
    follow from the session starts per tile. So a session may span any number of tiles and a hot series is cut like any other.
    """
    at = time_number(df, ts)
    own = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    key = F.struct(F.lit(0).alias("k"), *[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(by)])
    rows = df.select(key.alias("_by"), at.alias("_at"), F.col(quoted(row_id)).alias("_id"), own.alias("_row"))
    tiles = sorted_tiles(rows.where("_at IS NOT NULL"), ["_by", "_at", "_id"], rows_per_tile)
    place = F.struct(F.col("_by").alias("by"), F.col("_at").alias("at"))
    inside = Window.partitionBy(PART, TILE).orderBy(POS)
    along = Window.orderBy(TILE)
    marked = tiles.withColumn("_before", F.lag(place, 1).over(inside))
    # One row per tile.
    last = tiles.groupBy(PART, TILE).agg(F.max_by(place, POS).alias("_last"))
    carried = F.broadcast(last.select(TILE, F.lag("_last", 1).over(along).alias("_carried")))
    before = F.coalesce("_before", "_carried")
    starts = _starts(F.col("_by"), F.col("_at"), before, gap * time_unit(df, ts))
    marked = marked.join(carried, TILE).select(PART, TILE, POS, "_row", starts.cast("long").alias("_starts"))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    counted = marked.withColumn("_count", F.sum("_starts").over(upto))
    totals = running_start(marked.groupBy(PART, TILE).agg(F.sum("_starts").alias("_starts")), "_starts")
    numbered = counted.join(F.broadcast(totals.select(TILE, "_starts_start")), TILE)
    number = F.col("_count") + F.col("_starts_start") - 1
    without = rows.where("_at IS NULL").select("_row", F.lit(None).cast("long").alias("_number"))
    whole = numbered.select("_row", number.alias("_number")).unionByName(without)
    return whole.select(*[F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(df.columns)], F.col("_number").alias(out))


def _starts(by: Column, at: Column, before: Column, gap: float) -> Column:
    """True where a row begins a session, given the key and time of the row before."""
    return before.isNull() | ~before.by.eqNullSafe(by) | (at - before.at > F.lit(gap))


def sessions(
    df: DataFrame,
    ts: str,
    row_id: str,
    gap: float,
    by: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
    rows_per_tile: int = ROWS_PER_TILE,
) -> DataFrame:
    """One row per session: its number, ``by``, first and last time, rows, and further aggregates by name.

    See :func:`with_sessions`; rows without a time are left out. A long session is added up in pieces before
    the shuffle.
    """
    rows = with_sessions(df, ts, row_id, gap, by, "_session", rows_per_tile).where("_session IS NOT NULL")
    return rows.groupBy(F.col("_session").alias("session")).agg(
        *[F.first(quoted(c)).alias(c) for c in by],
        F.min(quoted(ts)).alias("first"),
        F.max(quoted(ts)).alias("last"),
        F.count(F.lit(1)).alias("rows"),
        *[c.alias(name) for name, c in (measures or {}).items()],
    )
