"""Near copies by exact Jaccard similarity of word shingles; SimHash and MinHash find the pairs to look at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.llm.common import as_bytes, id_of, map_rows, release_memory, text_key
from airseries.llm.simhash import components, covering_masks, vote
from airseries.session import stage

#: At Jaccard 0.8 a pair shares no bucket with probability (1 - 0.8 ** 5) ** 25 = 0.00005.
BANDS, ROWS = 25, 5
#: Fingerprints that differ in so many bits share a bucket of one of the masks for sure.
RADIUS = 4
MASKS = np.array(covering_masks(RADIUS), np.uint64)
#: Shingle hashes that a block of a crowded bucket holds on average (8 bytes each).
BLOCK_HASHES = 1 << 20
#: Numbers of an overlap matrix that are added up at a time.
STEP = 1 << 20
#: Parts that a text's many pairs are dealt over.
PARTS = 64


def _numbers(name: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{name}{i}") for i in range(BANDS * ROWS)], np.uint64)


FLIPS, FACTORS = _numbers("flip"), _numbers("factor") | np.uint64(1)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def run_hashes(words: list[bytes], shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Hashes of all runs of ``shingle`` words, repeats included; fewer words are one run, no words none."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    shingle = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    runs = zip(begins[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], seed) for a, b in runs], np.uint64)


def shingles(words: list[bytes], shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Distinct hashes of all runs of ``shingle`` words."""
    return np.unique(run_hashes(words, shingle, seed))


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least of ``hashes`` under each of the hash functions."""
    least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(hashes), 512):
        least = np.minimum(least, ((hashes[at : at + 512, None] ^ FLIPS) * FACTORS).min(axis=0))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def print_keys(fingerprint: int) -> np.ndarray:
    """The bits of a SimHash fingerprint that each of the covering masks keeps."""
    return (np.uint64(fingerprint) & MASKS).view(np.int64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row: ``doc``, ``key`` (hash of the text), ``node`` (hash of its words), number of shingles, buckets."""

    def make(batch: pa.RecordBatch) -> dict:
        out = {"node": [], "size": [], "bands": []}
        for text in as_bytes(batch.column(2)).to_pylist():
            words = words_of(text)
            every = run_hashes(words, shingle)
            hashes = np.unique(every)
            out["node"].append(_signed(xxhash.xxh64_intdigest(b" ".join(words))))
            out["size"].append(len(hashes))
            keys = [band_keys(min_hashes(hashes)), print_keys(vote(every))] if words else [[]]
            out["bands"].append(np.concatenate(keys))
        release_memory()
        return out

    source = docs.select(id_of(id_col).alias("doc"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    fields = [("node", "long"), ("size", "long"), ("bands", "array<long>")]
    return map_rows(source, ["doc", "key"], fields, make)


def hash_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``node`` and its distinct shingle hashes, sorted, as bytes."""

    def make(batch: pa.RecordBatch) -> dict:
        found = [shingles(words_of(t), shingle).tobytes() for t in as_bytes(batch.column(1)).to_pylist()]
        release_memory()
        return {"hashes": found}

    return map_rows(texts.select("node", "text"), ["node"], [("hashes", "binary")], make)


def _hashes_at(pairs: DataFrame, sets: DataFrame, own: str, other: str) -> DataFrame:
    """``pairs`` with the hashes of ``own``; a node with many pairs is copied to as many parts, PARTS at most."""
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
    copies = dealt.select(own, "part").distinct().join(sets.withColumnRenamed("node", own), own)
    copies = copies.withColumnRenamed("hashes", f"hashes_{own}")
    return dealt.join(copies, [own, "part"]).drop("part")


def _alike(both, size, other, least: float):
    """Jaccard similarity of ``least`` or more; in whole numbers, so that 4 of 5 is 0.8 or more."""
    return both >= least * (size + other - both) - 1e-9


def confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts have a Jaccard similarity of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            # Few sets at a time become Python objects.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for left, right in zip(*(part.column(i).to_pylist() for i in (2, 3)), strict=True):
                    own, known = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                    both = len(np.intersect1d(own, known, assume_unique=True))
                    keep.append(_alike(both, len(own), len(known), least))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            del batch
            release_memory()

    both = _hashes_at(_hashes_at(pairs.select("a", "b"), sets, "a", "b"), sets, "b", "a")
    return both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(run, "a long, b long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of hashes that each set of ``left`` shares with each of ``right``.

    Hashes that many sets have are counted by matrix products, the others pair by pair
    along the sets that have them; memory is that of the result and STEP numbers.
    """
    hashes = np.concatenate([*left, *right])
    vocabulary, codes = np.unique(hashes, return_inverse=True)
    cut = sum(map(len, left))
    owners = [np.repeat(np.arange(len(sets)), [len(x) for x in sets]) for sets in (left, right)]
    sides = []
    for own, code in zip(owners, (codes[:cut], codes[cut:]), strict=True):
        order = np.argsort(code, kind="stable")
        counts = np.bincount(code, minlength=len(vocabulary))
        sides.append((own[order], counts, np.cumsum(counts) - counts))
    (own_l, n_l, at_l), (own_r, n_r, at_r) = sides
    size = len(left) * len(right)
    work = n_l * n_r
    total = np.zeros((len(left), len(right)), np.float32)

    def entries(own, counts, begins, chosen):
        """Owner and place in ``chosen`` of every entry of the chosen hashes."""
        sizes = counts[chosen]
        place = np.repeat(np.arange(len(chosen)), sizes)
        inner = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return own[begins[chosen][place] + inner], place

    common = np.flatnonzero(work > size / 500)
    step = max(1, STEP // max(len(left), len(right)))
    for at in range(0, len(common), step):
        chosen = common[at : at + step]
        both = []
        for count, side in ((len(left), sides[0]), (len(right), sides[1])):
            own, place = entries(*side, chosen)
            dense = np.zeros((count, len(chosen)), np.float32)
            dense[own, place] = 1
            both.append(dense)
        total += both[0] @ both[1].T
    rare = np.flatnonzero((work > 0) & (work <= size / 500))
    cuts = np.flatnonzero(np.diff(np.cumsum(work[rare]) // STEP)) + 1
    for chosen in np.split(rare, cuts):
        if not len(chosen):
            continue
        own, place = entries(own_l, n_l, at_l, chosen)
        each = n_r[chosen][place]
        inner = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        facing = own_r[np.repeat(at_r[chosen][place], each) + inner]
        total += np.bincount(np.repeat(own, each) * len(right) + facing, minlength=size).reshape(total.shape)
    return total


def _fitting(pairs: DataFrame, least: float) -> DataFrame:
    """Distinct pairs, smaller node first, without those whose numbers of shingles rule the similarity out."""
    fits = F.least("size", "other_size") >= least * F.greatest("size", "other_size") - 1e-9
    return (
        pairs.where(fits & (F.col("node") != F.col("other")))
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )


def _star_pairs(placed: DataFrame, least: float) -> DataFrame:
    """Every node of a bucket with one of them, the one of the smallest hash, which tends to be that of many buckets."""
    center = F.min_by(F.struct("node", "size"), F.xxhash64("node")).alias("c")
    centers = placed.groupBy("band", "bucket").agg(center)
    return _fitting(
        placed.join(centers, ["band", "bucket"]).select(
            "node", "size", F.col("c.node").alias("other"), F.col("c.size").alias("other_size")
        ),
        least,
    )


def _joining(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], cut: int, least: float) -> list[tuple[int, int]]:
    """Links that join the components of a block (``cut`` 0) or of two (cut there), at most one less than nodes."""
    here, there = (slice(0, cut), slice(cut, None)) if cut else (slice(None), slice(None))
    sizes = np.array([len(x) for x in sets])
    shared = overlaps(sets[here], sets[there])
    linked = _alike(shared, sizes[here, None], sizes[None, there], least) & (roots[here, None] != roots[None, there])
    known, at = np.unique(roots, return_inverse=True)
    top = list(range(len(known)))

    def root_of(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    out = []
    for i in range(len(linked)):
        for j in np.flatnonzero(linked[i]).tolist():
            a, b = root_of(at[i]), root_of(at[j + cut])
            if a != b:
                top[a] = b
                out.append((int(nodes[i]), int(nodes[j + cut])))
    return out


def _block_links(rooted: DataFrame, sets: DataFrame, least: float, block: int) -> DataFrame:
    """Links of nodes that share a bucket but not a component: enough of them to join the components.

    A bucket is cut into blocks of about ``block`` nodes and BLOCK_HASHES hashes. Two
    blocks at a time lie in one task, where exact overlaps are counted; no pair leaves it but links.
    """
    mixed = (
        rooted.groupBy("band", "bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum("size").alias("hashes"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .where("low <> high and n > 2")
        .select(
            "band",
            "bucket",
            F.ceil(F.greatest(F.col("n") / block, F.col("hashes") / BLOCK_HASHES)).cast("int").alias("blocks"),
        )
    )
    dealt = (
        rooted.join(mixed, ["band", "bucket"])
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "facing"))
        .withColumn("high", F.greatest("own", "facing"))
    )
    group = ["band", "bucket", "low", "high"]
    spread = dealt.select(*group, "own", "node", "root").join(sets, "node")
    spread = spread.select(*group, "own", "node", "root", "hashes")
    spread = spread.repartition(*group).sortWithinPartitions(*group, "own", "node")

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        _, _, low, high, *_ = rows[0]
        cut = sum(r[4] == low for r in rows) if low != high else 0
        if len(rows) < 2 or (low != high and cut in (0, len(rows))):
            return []
        nodes, roots = (np.array([r[i] for r in rows], np.int64) for i in (5, 6))
        return _joining(nodes, roots, [np.frombuffer(r[7], np.uint64) for r in rows], cut, least)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if held and held[0][:4] != row[:4]:
                        yield held
                        held = []
                    held.append(row)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for rows in groups(batches):
            found += links(rows)
            if len(found) >= 1 << 16:
                yield _pairs_batch(found)
                found = []
        yield _pairs_batch(found)
        release_memory()

    return spread.mapInArrow(run, "a long, b long").distinct()


def _pairs_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    least: float = 0.8,
    block: int = 2048,
) -> DataFrame:
    """Per component of near copies: ``root`` and the ``doc`` and ``key`` (``text_key``) of its smallest row.

    Texts (A-Z in lower case, words only) are linked if their sets of ``shingle`` words have a Jaccard
    similarity of ``least`` or more; a component is what links reach. Texts of the same words are one
    node. Candidates share the bits of their SimHash fingerprints under one of the covering masks, as all within RADIUS
    bits do, or one of BANDS buckets of ROWS MinHashes each, as fingerprints of texts near ``least`` are further
    apart. Every link is confirmed by the whole sets of hashes. A bucket is first compared with one of its nodes; buckets that then still
    hold several components are compared in blocks of about ``block`` nodes, which
    give only the links that join components.

    A null id counts as the smallest id; rows with one id and different texts are different rows.
    Null and empty texts and those without words are one component. Very long texts are compared
    whole. An empty table gives an empty table; other columns are not looked at.
    """
    printed = stage(sketches(docs, id_col, text_col, shingle), "sketches")
    nodes = printed.groupBy("node").agg(
        F.min(F.struct("doc", "key")).alias("row"), F.min_by(F.struct("size", "bands"), F.struct("doc", "key")).alias("x")
    )
    nodes = stage(nodes.select("node", "row.*", "x.*"), "nodes")
    places = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = places.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = stage(places.join(shared, ["band", "bucket"], "left_semi"), "buckets")
    wanted = buckets.select("node").distinct().join(nodes.drop("bands"), "node")
    about = stage(wanted.select("node", "size"), "shared_nodes")
    source = docs.select(id_of(id_col).alias("doc"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    found = source.join(wanted.select("node", "doc", "key"), ["doc", "key"])
    sets = stage(hash_sets(found.groupBy("node").agg(F.first("text").alias("text")), shingle), "shared_sets")
    pairs = stage(_star_pairs(buckets.join(about, "node"), least), "pairs")
    links = stage(confirmed(pairs, sets, least), "confirmed")
    roots = components(links)
    rooted = about.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    joining = stage(_block_links(buckets.join(rooted, "node"), sets, least, block), "confirmed")
    if not joining.isEmpty():
        roots = components(links.union(joining))
    member = nodes.select("node", "doc", "key").join(roots, "node", "left")
    member = member.withColumn("root", F.coalesce("root", "node"))
    return member.groupBy("root").agg(F.min(F.struct("doc", "key")).alias("row")).select("root", "row.*")
