"""SimHash near-duplicates by covering locality-sensitive hashing, and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.llm.common import as_bytes, id_of, map_rows
from airseries.session import stage

BITS = 64


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a text: a bit is 1 if over half the shingle hashes have it; no word, no bit."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    begins = ends - sizes
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [
            digest(joined[a:b], seed)
            for a, b in zip(begins[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
        ],
        "<u8",
    )
    return vote(hashes)


def vote(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes: a bit is 1 if over half of them have it."""
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.unpackbits(hashes[at : at + 8192].view(np.uint8), bitorder="little").reshape(-1, BITS)
        votes += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """Masks such that any two words within ``radius`` bits agree on at least one.

    Bit i gets a non-zero vector of radius + 1 bits; mask v keeps the bits whose vector
    has an odd product with v. The vectors of at most ``radius`` differing bits do not span
    the space, so some non-zero v is orthogonal to all of them: its mask keeps none
    of the differing bits. Each mask keeps about half the bits.
    """
    size = (1 << (radius + 1)) - 1
    vectors = [i % size + 1 for i in range(bits)]
    return [
        sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, size + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """``doc`` (long) and ``print`` (the fingerprint as signed long) of every row."""

    def make(batch: pa.RecordBatch) -> dict:
        texts = as_bytes(batch.column(1)).to_pylist()
        values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return {"print": pa.array(values.view(np.int64))}

    source = docs.select(id_of(id_col).alias("doc"), F.col(text_col).alias("text"))
    return map_rows(source, ["doc"], [("print", "long")], make)


def _spanning(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``left``, or between ``left`` and ``right``."""
    values = left if right is None else np.concatenate([left, right])
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for i in range(len(left)):
        others = values[i + 1 :] if right is None else right
        shift = i + 1 if right is None else len(left)
        near = np.flatnonzero(np.bitwise_count(others ^ values[i]) <= radius) + shift
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                edges.append((i, j))
    return [(int(values[i]), int(values[j])) for i, j in edges]


def near_links(prints: DataFrame, radius: int = 4, block: int = 2048) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct ``print`` values within ``radius`` bits.

    Every print goes to one bucket per covering mask, so each pair within the radius
    shares a bucket. Buckets are compared in blocks of about ``block`` prints:
    a bucket of more is cut by hash, and each pair of its blocks is a group of its own, so
    that no task gets a whole hot bucket. Each group emits a spanning forest of its
    links, never all pairs: components stay the same.

    Spark sizes the exploded buckets as if each print had one, so it would broadcast all of them
    below about a million prints; the hint makes both sides meet by shuffle at any size.
    """
    masks = covering_masks(radius)
    mask_column = F.array(*[F.lit(_signed(m)) for m in masks])
    buckets = prints.select(
        "print", F.posexplode(F.transform(mask_column, lambda m: F.col("print").bitwiseAND(m)))
    ).toDF("print", "mask", "key")
    crowded = (
        buckets.groupBy("mask", "key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    )
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    grouped = (
        buckets.join(crowded.hint("merge"), ["mask", "key"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "mask",
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
            "print",
        )
    )
    spread = grouped.repartition("mask", "key", "low", "high").sortWithinPartitions(
        "mask", "key", "low", "high", "own"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None

        def links(rows: np.ndarray) -> list[tuple[int, int]]:
            prints = rows[:, 5].copy().view(np.uint64)
            low, high = rows[0, 2], rows[0, 3]
            if low == high:
                return _spanning(prints, None, radius)
            mine = rows[:, 4] == low
            return _spanning(prints[mine], prints[~mine], radius)

        def answer(rows: np.ndarray) -> pa.RecordBatch:
            edges = []
            cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            for group in np.split(rows, cuts):
                if len(group) > 1:
                    edges += links(group)
            pairs = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)])
            rows = rows if held is None else np.concatenate([held, rows])
            if not len(rows):
                continue
            # The last group may go on in the next batch.
            start = int(np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1)).max(initial=-1)) + 1
            held = rows[start:]
            if start:
                yield answer(rows[:start])
        if held is not None and len(held):
            yield answer(held)

    return spread.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of all nodes that occur in ``links``.

    Alternating large-star and small-star rounds: each node's larger neighbours, then its smaller ones,
    are linked to the smallest node seen, until no link changes. Every round is
    two grouped passes over as many links as there are nodes at most; it is written to
    the shared folder, so a lost executor costs one round at most. A hub's neighbours
    are never collected: minima come from aggregates and reach the links by a join.
    """
    current = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while True:
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_min, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
            .select(F.col("x.a").alias("a"), F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        following = stage(small, "links")
        same = following.count() == current.count() and following.join(
            current, ["a", "b"], "left_anti"
        ).isEmpty()
        current = following
        if same:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
) -> DataFrame:
    """Per row: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints link at ``radius`` or fewer differing bits; a component is what links
    reach, named by its smallest id. Copies share a fingerprint and are
    joined by it, so only distinct fingerprints are compared.

    Null and empty texts and those without words have fingerprint zero, linked like any other.
    A null id counts as the smallest id. Repeated rows come back once
    each; other columns are left out; an empty table gives an empty table.
    """
    printed = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = printed.groupBy("print").agg(F.min("doc").alias("least"))
    links = near_links(nodes.select("print"), radius)
    reached = components(links)
    member = nodes.join(reached, nodes["print"] == reached["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(least, "root").select("print", "component_id")
    return printed.join(named, "print").select(
        F.when(F.col("doc") != -(1 << 63), F.col("doc")).alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
