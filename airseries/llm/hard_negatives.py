"""Hard negatives by exact integer scores, from residue matrices multiplied in float32."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airseries.llm.common import lean
from airseries.session import stage

#: Balanced residues of primes below this go up to 511, and 64 of their products fit the 24 bits of a float32.
LARGEST_PRIME, TERMS = 1024, 64
#: Components are held in units of 1 / SCALE.
SCALE = 256
#: Rows whose score with itself is below this have scores that fit a long.
LARGEST_NORM = 9.2e18
#: Scores worked on at once in a task.
TILE = 1 << 20


@functools.cache
def primes() -> list[int]:
    """Odd primes below LARGEST_PRIME, the largest first."""
    sieve = np.ones(LARGEST_PRIME, bool)
    sieve[:3] = False
    sieve[4::2] = False
    for p in range(3, int(LARGEST_PRIME**0.5) + 1, 2):
        sieve[p * p :: p] = False
    return np.flatnonzero(sieve)[::-1].tolist()


def moduli_for(bound: int) -> list[int]:
    """So many of the primes that every whole number from -bound to bound has its own residues."""
    product, chosen = 1, []
    for p in primes():
        if product > 2 * bound:
            break
        product *= p
        chosen.append(p)
    return chosen


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """The residue of smallest magnitude of whole numbers in float64."""
    return x - p * np.rint(x * (1.0 / p))


def residues(components: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """One float32 matrix of balanced residues per prime; fmod is exact for whole numbers of any size."""
    return [balanced(np.fmod(components, p), p).astype(np.float32) for p in moduli]


def product(left: list[np.ndarray], right: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """All inner products as exact int64: one float32 GEMM per prime and 64 dimensions, then Chinese remaindering.

    The residues of a score give its balanced mixed-radix digits; with odd primes these digits
    are those of the signed number itself. Sums may wrap, the result does not as it fits 64 bits.
    """
    digits: list[np.ndarray] = []
    total = np.zeros((len(left[0]), len(right[0])), np.int64)
    weight = 1
    for k, p in enumerate(moduli):
        value = np.zeros(total.shape)
        for lo in range(0, left[k].shape[1], TERMS):
            value += left[k][:, lo : lo + TERMS] @ right[k][:, lo : lo + TERMS].T
        value = balanced(value, p)
        for q, digit in zip(moduli, digits, strict=False):
            value = balanced((value - digit) * pow(q, -1, p), p)
        digits.append(value)
        with np.errstate(over="ignore"):
            # The weight modulo 2^64 as a signed number.
            total += value.astype(np.int64) * np.int64((weight + (1 << 63)) % (1 << 64) - (1 << 63))
        weight *= p
    return total


def matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Components as whole numbers in float64; vectors shorter than ``dims`` end in zeros."""
    flat = pa.concat_arrays(vectors.chunks) if vectors.num_chunks else pa.array([], pa.list_(pa.float64()))
    sizes = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(flat), dims))
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(flat)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return np.floor(SCALE * out)


def best_of(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` by falling score, then id; ``ids`` must be in rising order."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        near = np.flatnonzero(scores >= least)
        return near[np.argsort(-scores[near], kind="stable")[:n]]
    return np.argsort(-scores, kind="stable")[:n]


class Cell:
    """One block of rows against one block of anchors."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, dims: int, moduli: list[int]) -> None:
        self.moduli = moduli
        ids = rows.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], rows.column("label").to_numpy()[order]
        self.rows = residues(matrix(rows.column("vector"), dims)[order], moduli)
        self.anchor = anchors.column("anchor").to_numpy()
        self.anchor_labels = anchors.column("label").to_numpy()
        self.anchors = residues(matrix(anchors.column("vector"), dims), moduli)

    def tiles(self, anchors: np.ndarray, rows: np.ndarray | slice):
        """Scores of some anchors with some rows, so many anchors at a time that a tile holds about TILE scores."""
        right = [m[rows] for m in self.rows]
        step = max(1, TILE // max(1, len(right[0])))
        for lo in range(0, len(anchors), step):
            some = anchors[lo : lo + step]
            yield some, product([m[some] for m in self.anchors], right, self.moduli)


POSITIVES = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
POSITIVES_DDL = "anchor long, id long, score long"
NEGATIVES = pa.schema([("anchor", pa.int64()), ("positive", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
NEGATIVES_DDL = "anchor long, positive int, id long, score long"


def _table(parts: list[list], schema: pa.Schema) -> pa.Table:
    arrays = [np.concatenate(c) if c else [] for c in parts]
    return pa.table([pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def nearest_same(rows: pa.Table, anchors: pa.Table, dims: int, moduli: list[int], n: int) -> pa.Table:
    """The first ``n`` rows of each anchor's label in this block, the anchor itself among them if it lies here."""
    out: list[list] = [[], [], []]
    if not rows.num_rows or not anchors.num_rows:
        return _table(out, POSITIVES)
    cell = Cell(rows, anchors, dims, moduli)
    for label in np.unique(cell.anchor_labels).tolist():
        same = np.flatnonzero(cell.labels == label)
        ids = cell.ids[same]
        for some, scores in cell.tiles(np.flatnonzero(cell.anchor_labels == label), same):
            for a, own in zip(some.tolist(), scores, strict=True):
                at = best_of(own, ids, n)
                for column, values in zip(out, (np.full(len(at), cell.anchor[a]), ids[at], own[at]), strict=True):
                    column.append(values)
    return _table(out, POSITIVES)


def nearest_other(
    rows: pa.Table, anchors: pa.Table, dims: int, moduli: list[int], n: int, low: int, high: int
) -> pa.Table:
    """For each positive of an anchor the first ``n`` rows of other labels in this block within its window of scores."""
    out: list[list] = [[], [], [], []]
    if not rows.num_rows or not anchors.num_rows:
        return _table(out, NEGATIVES)
    cell = Cell(rows, anchors, dims, moduli)
    wanted = anchors.column("positives").to_pylist()
    for some, scores in cell.tiles(np.arange(len(cell.anchor)), slice(None)):
        for a, own in zip(some.tolist(), scores, strict=True):
            # -(-x // 100) rounds up; both in whole numbers of any size.
            windows = [(-(-low * s // 100), high * s // 100) for s in wanted[a]]
            reach = [w for w in windows if w[0] <= w[1]]
            if not reach:
                continue
            near = (own >= min(w[0] for w in reach)) & (own <= max(w[1] for w in reach))
            near = np.flatnonzero(near & (cell.labels != cell.anchor_labels[a]))
            near = near[np.argsort(-own[near], kind="stable")]
            falling = -own[near]
            for k, (least, most) in enumerate(windows):
                if least > most:
                    continue
                first, last = np.searchsorted(falling, -most), np.searchsorted(falling, -least, side="right")
                at = near[first : min(last, first + n)]
                if len(at):
                    filled = (np.full(len(at), cell.anchor[a]), np.full(len(at), k), cell.ids[at], own[at])
                    for column, values in zip(out, filled, strict=True):
                        column.append(values)
    return _table(out, NEGATIVES)


def _cells(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, work, ddl: str) -> DataFrame:
    """``work`` on every pair of a block of rows and a block of anchors.

    A row goes to as many cells as there are blocks of anchors, an anchor to as many as there are blocks of rows.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("anchor_block", every(anchor_blocks))
    right = anchors.withColumn("row_block", every(row_blocks))
    keys = ["row_block", "anchor_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lean(work), ddl)


def _blocks(df: DataFrame, n: int, name: str) -> DataFrame:
    """``n`` blocks of nearly equal size, whatever the ids and labels are."""
    return df.repartition(n).withColumn(name, F.spark_partition_id())


def _whole_norm(vector: Column) -> Column:
    add = lambda sum_, x: sum_ + F.pow(F.floor(x.cast("double") * SCALE).cast("double"), 2)
    return F.aggregate(vector, F.lit(0.0), add)


def mine(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    label: Column | None = None,
    is_anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block_rows: int = 16384,
    block_anchors: int = 4096,
) -> DataFrame:
    """Hard negatives: for each anchor and each of its positives, rows of another label scored close below it.

    A score is the inner product of ``floor(256 * component)``, exact: rows are held as residues
    modulo small primes, multiplied in float32 without rounding and put together by Chinese remaindering. A higher
    score comes first, then a smaller id. Positives are an anchor's first ``positives`` other rows of its label;
    for each, the first ``negatives`` rows of another label come back whose score lies between ``low`` and ``high``
    hundredths of the positive's. ``label`` and ``is_anchor`` are expressions over the table.

    Anchors meet all rows in cells of ``block_rows`` by ``block_anchors``, cut by position, so a hot label or id is
    cut like any other. A cell hands on a few rows per anchor, which a window merges.

    A row with a null id, label, vector or component, or a component that is not finite, takes no part, nor does one
    whose score with itself is 9.2e18 or more (all other scores then fit a long). Vectors of
    different length are compared as if the shorter ended in zeros. Repeated rows are rows of their own. Other columns
    are left out; their names do not matter. Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(label_col) if label is None else label).cast("long").alias("label"),
        vector.alias("vector"),
        F.coalesce(F.col(id_col) % 50 == 0 if is_anchor is None else is_anchor, F.lit(False)).alias("is_anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.where(sound).withColumn("norm", _whole_norm(F.col("vector"))).where(F.col("norm") < LARGEST_NORM)
    count, anchor_count, dims, norm = rows.agg(
        F.count(F.lit(1)), F.count_if("is_anchor"), F.max(F.size("vector")), F.max("norm")
    ).first()
    # By Cauchy and Schwarz no score is larger; the norm was summed in floating point.
    moduli = moduli_for(int((norm or 0) * 1.001) + 1)
    width = int(dims or 0)
    row_blocks = max(1, -(-count // block_rows), min(4 * spark.sparkContext.defaultParallelism, count // 512))
    anchor_blocks = max(1, -(-anchor_count // block_anchors))
    placed = stage(_blocks(rows.drop("norm"), row_blocks, "row_block"), "rows")
    numbered = placed.where("is_anchor").select("id", "label", "vector")
    anchors = stage(
        _blocks(numbered, anchor_blocks, "anchor_block").withColumn("anchor", F.monotonically_increasing_id()), "anchors"
    )
    placed = placed.select("id", "label", "vector", "row_block")

    same = _cells(
        placed,
        anchors.select("anchor", "label", "vector", "anchor_block"),
        row_blocks,
        anchor_blocks,
        lambda r, a: nearest_same(r, a, width, moduli, positives + 1),
        POSITIVES_DDL,
    )
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    first = same.withColumn("place", rank).where(F.col("place") <= positives + 1)
    gathered = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("near"))
    # An anchor is among its own label's rows: it is left out once, by id and score, which any
    # equal row shares; where it lies beyond, the last place is one too many.
    own = F.struct(F.col("self").alias("id"), _whole_norm_exact("vector").alias("score"))
    at = F.array_position(F.transform("near", lambda x: F.struct(x.id.alias("id"), x.score.alias("score"))), own)
    others = F.filter("near", lambda x: x.place != F.when(at > 0, at).otherwise(positives + 1))
    chosen = stage(
        anchors.withColumnRenamed("id", "self").join(gathered, "anchor").withColumn("others", others).drop("near"), "positives"
    )
    other = _cells(
        placed,
        chosen.select("anchor", "label", "vector", "anchor_block", F.col("others.score").alias("positives")),
        row_blocks,
        anchor_blocks,
        lambda r, a: nearest_other(r, a, width, moduli, negatives, low, high),
        NEGATIVES_DDL,
    )
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id"))
    taken = other.withColumn("rank", rank).where(F.col("rank") <= negatives)
    told = chosen.select("anchor", "self", F.posexplode("others").alias("positive", "near"))
    return taken.join(told, ["anchor", "positive"]).select(
        F.col("self").alias("anchor_id"),
        F.col("near.id").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("near.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _whole_norm_exact(vector: str) -> Column:
    """A row's score with itself, in whole numbers."""

    def add(total: Column, x: Column) -> Column:
        whole = F.floor(x.cast("double") * SCALE).cast("long")
        return total + whole * whole

    return F.aggregate(F.col(vector), F.lit(0).cast("long"), add)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Every 50th vector is an anchor; the label of every 7th is one further, as if mislabelled."""
    own = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)
    return mine(embeddings, label=shifted)
