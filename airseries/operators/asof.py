"""As-of joins: each row with the nearest earlier, later or closest row of another series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.functions.times import time_number, time_unit
from airseries.operators.columns import quoted
from airseries.operators.ordering import PART, POS, ROWS_PER_TILE, TILE, sorted_tiles


def asof_join(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    row_id: str,
    by: Sequence[str] = (),
    other_than: str | None = None,
    direction: str = "backward",
    allow_exact: bool = True,
    tolerance: float | None = None,
    prefix: str = "match_",
    rows_per_tile: int = ROWS_PER_TILE,
) -> DataFrame:
    """Every left row with the nearest right row in time, whose columns are added under ``prefix``.

    ``direction`` is ``backward`` (the last right row at or before the left row's time), ``forward`` (the first at or
    after it) or ``nearest`` (the closer of the two, the earlier if both are equally far). Without ``allow_exact``
    rows at the same time do not match; ``nearest`` always allows them. Both sides have the columns ``ts`` (times or
    numbers), ``row_id`` (unique within its side) and ``by``, whose values must be equal. ``other_than`` names a column
    whose values must differ; null is a value of its own there. Of right rows at the same time the
    largest id wins, looking forward the smallest. ``tolerance`` is the largest distance, in seconds (numbers: in their own unit).

    Both sides are merged in sorted tiles. Inside a tile the last right row is carried on by a window, which
    reads the tile where it lies; over the edges of tiles goes one right row per tile (two with
    ``other_than``). So a hot series is cut like any other, nothing is gathered per key and no side is broadcast.
    All left rows come back; where time or key is missing (NaN too), or nothing matches, the added columns are null.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"direction {direction} is not backward, forward or nearest")
    if direction == "nearest" and not allow_exact:
        raise ValueError("nearest allows exact matches")
    right_first = allow_exact == (direction != "forward")
    both = _side(left, right, True, ts, row_id, by, other_than, right_first).unionByName(
        _side(left, right, False, ts, row_id, by, other_than, right_first)
    )
    rows = sorted_tiles(both.where("_placed").drop("_placed"), ["_by", "_at", "_side", "_id"], rows_per_tile)
    ways = ["backward", "forward"] if direction == "nearest" else [direction]
    for way in ways:
        rows = _with_nearest(rows, way, other_than is not None)
    limit = None if tolerance is None else F.lit(tolerance * time_unit(left, ts))
    far = {w: F.abs(F.col(w).at - F.col("_at")) for w in ways}
    near = {w: F.col(w) if limit is None else F.when(far[w] <= limit, F.col(w)) for w in ways}
    match = near[ways[0]]
    if len(ways) == 2:
        later = near["backward"].isNull() | (far["forward"] < far["backward"])
        match = F.when(later & near["forward"].isNotNull(), near["forward"]).otherwise(near["backward"])
    matched = rows.where(F.col("_left").isNotNull()).select("_left", match.getField("row").alias("_match"))
    alone = _side(left, right, True, ts, row_id, by, other_than, right_first).where("NOT _placed")
    whole = matched.unionByName(alone.select("_left", F.col("_right.row").alias("_match")))
    return whole.select(
        *[F.col("_left")[f"c{i}"].alias(c) for i, c in enumerate(left.columns)],
        *[F.col("_match")[f"c{i}"].alias(prefix + c) for i, c in enumerate(right.columns)],
    )


def _shape(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)])


def _side(
    left: DataFrame,
    right: DataFrame,
    is_left: bool,
    ts: str,
    row_id: str,
    by: Sequence[str],
    other_than: str | None,
    right_first: bool,
) -> DataFrame:
    """One side in the common form: its place in the order, and its row under ``_left`` or ``_right``."""
    df = left if is_left else right
    at = time_number(df, ts)
    rival = F.col(quoted(other_than)) if other_than else F.lit(None).cast("int")
    row = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    placed = at.isNotNull()
    for c in by:
        placed = placed & F.col(quoted(c)).isNotNull()
    entry = F.struct(at.alias("at"), rival.alias("rival"), (F.lit(None).cast(_shape(right)) if is_left else row).alias("row"))
    return df.select(
        F.coalesce(placed, F.lit(False)).alias("_placed"),
        # A struct without fields has no order.
        F.struct(F.lit(0).alias("k"), *[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(by)]).alias("_by"),
        at.alias("_at"),
        F.lit(int(is_left == right_first)).alias("_side"),
        F.col(quoted(row_id)).alias("_id"),
        rival.alias("_rival"),
        (row if is_left else F.lit(None).cast(_shape(left))).alias("_left"),
        (F.when(F.lit(False), entry) if is_left else entry).alias("_right"),
    )


def _differ(a: Column, b: Column) -> Column:
    return ~a.rival.eqNullSafe(b.rival)


def _with_nearest(rows: DataFrame, way: str, rivals: bool) -> DataFrame:
    """Adds the nearest right row on one side under the name ``way``.

    Going along the order, ``_r1`` is the last right row met and ``_r2`` the last one whose
    rival differs from that of ``_r1``: where ``_r1`` is not allowed, ``_r2`` is.
    """

    def going(*columns: str) -> list[Column]:
        return [F.col(c) if way == "backward" else F.col(c).desc() for c in columns]

    def last(c: Column | str, window, upto: int) -> Column:
        return F.last(c, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, upto))

    names = rows.columns
    inside = Window.partitionBy(PART, TILE, "_by").orderBy(*going(POS))
    own, r1, r2 = F.col("_right"), F.col("_r1"), F.col("_r2")
    rows = rows.withColumn("_r1", last(own, inside, 0))
    if rivals:
        rows = rows.withColumn("_before", last(own, inside, -1))
        turn = F.when(own.isNotNull() & F.col("_before").isNotNull() & _differ(F.col("_before"), own), F.col("_before"))
        rows = rows.withColumn("_turn", turn).withColumn("_r2", last("_turn", inside, 0))
    else:
        rows = rows.withColumn("_r2", F.when(F.lit(False), own))

    # What a tile hands on; one row per tile, and per tile what all tiles before it hand on.
    state = F.struct(F.col("_by").alias("by"), r1.alias("r1"), r2.alias("r2"))
    end = (F.max_by if way == "backward" else F.min_by)(state, F.when(own.isNotNull(), F.col(POS)))
    along = Window.orderBy(*going(TILE))
    tiles = rows.groupBy(PART, TILE).agg(end.alias("_s")).withColumn("_p", last("_s", along, -1))
    s, p = F.col("_s"), F.col("_p")
    nothing = F.struct(F.when(F.lit(False), s.r1).alias("x"))
    turn = (
        F.when(s.isNull(), F.lit(None))
        .when(s.r2.isNotNull(), F.struct(s.r2.alias("x")))
        .when(p.isNull() | ~p.by.eqNullSafe(s.by), nothing)
        .when(_differ(p.r1, s.r1), F.struct(p.r1.alias("x")))
    )
    tiles = tiles.withColumn("_turn", turn).withColumn("_t", last("_turn", along, -1))
    carried = tiles.select(TILE, p.by.alias("_c_by"), p.r1.alias("_c1"), F.col("_t").x.alias("_c2"))

    c1, c2 = F.col("_c1"), F.col("_c2")
    same = F.col("_c_by").eqNullSafe(F.col("_by"))
    found = F.coalesce(r1, F.when(same, c1))
    if rivals:
        second = F.when(same, F.when(r1.isNotNull() & _differ(c1, r1), c1).otherwise(c2))
        other = F.coalesce(r2, second)
        found = F.when(found.isNotNull() & ~found.rival.eqNullSafe(F.col("_rival")), found).otherwise(other)
    # One row per tile.
    return rows.join(F.broadcast(carried), TILE).select(*names, found.alias(way))
