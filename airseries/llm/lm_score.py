"""Language-model scores by context-tree weighting, learned and applied over all documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.llm import context_tree as ct
from airseries.llm.chunks import in_chunks
from airseries.llm.common import lean, release_memory
from airseries.session import stage, stage_buckets

GRAMS, WORDS = 0, 1
#: Hot contexts by their number of bytes, sorted.
Hot = dict[int, np.ndarray]
#: Contexts whose nearest bytes agree in so many bytes are worked on together; more bytes where so many are hot.
SHARED = 2
#: A context that precedes more than one in so many of the bytes looked at is hot.
HOT_SHARE = 256
#: Chunks looked at for hot contexts.
HOT_CHUNKS = 8
#: Bytes of text whose grams are held at once.
PART = 1 << 20
#: The key of the end token; no word is empty.
END_KEY = xxhash.xxh3_64_intdigest(b"")


def normal_texts(texts: pa.ChunkedArray) -> list[bytes]:
    """A-Z in lower case, words joined by one space; null is empty."""
    return [b" ".join((t or b"").lower().split()) for t in texts.to_pylist()]


def parts_of(texts: list[bytes]) -> list[list[bytes]]:
    """Consecutive texts of about PART bytes together."""
    parts, size = [[]], 0
    for text in texts:
        if size > PART:
            parts.append([])
            size = 0
        parts[-1].append(text)
        size += len(text) + 1
    return parts


def part_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all bytes and ends of these texts, and where each text's grams begin."""
    pad = bytes([ct.EDGE]) * depth
    data = np.frombuffer(pad + pad.join(texts) + pad[:1], np.uint8)
    codes = ct.grams(data, depth)
    inside = ~((data[depth:] == ct.EDGE) & (data[depth - 1 : -1] == ct.EDGE))
    # An empty text is its end alone, which follows only edges.
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + depth) - depth
    inside[ends] = True
    return codes[inside], np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])


def part_words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of normal texts, coded by distinct word, and each text's number of words."""
    joined = b" ".join([t for t in texts if t])
    if not joined:
        return pa.array([], pa.binary()).dictionary_encode(), np.zeros(len(texts), np.int64)
    data = np.frombuffer(joined, np.uint8)
    cuts = np.flatnonzero(data == 32)
    # Each word but the first keeps the space before it; it is cut off from the distinct ones.
    offsets = np.concatenate([[0], cuts, [len(data)]]).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
    ).dictionary_encode()
    numbers = np.fromiter([t.count(b" ") + 1 if t else 0 for t in texts], np.int64, len(texts))
    return words, numbers


def word_keys(words: pa.DictionaryArray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w.lstrip()) for w in words.dictionary.to_pylist()], np.uint64)


def distinct(keys: list[np.ndarray]) -> np.ndarray:
    """Distinct keys in order; sorting is much faster here than numpy's hashing."""
    joined = np.sort(np.concatenate(keys))
    return joined[np.concatenate([[True], joined[1:] != joined[:-1]])] if len(joined) else joined


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not sum(map(len, keys)):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = np.concatenate(keys)
    order = np.argsort(joined)
    joined = joined[order]
    begins = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))
    return joined[begins], np.add.reduceat(np.concatenate(counts)[order], begins, dtype=np.int64)


def prefix_of(keys: np.ndarray, depth: int, size: int) -> np.ndarray:
    """The ``size`` nearest context bytes of grams."""
    return keys >> np.uint64(8 * (depth + 1 - size))


def shared_bytes(keys: np.ndarray, depth: int, hot: Hot) -> np.ndarray:
    """For each gram (in rising order) by how many nearest bytes it is worked on: one more than its longest hot context."""
    sizes = np.full(len(keys), SHARED, np.uint8)
    for size in sorted(hot):
        shift = np.uint64(8 * (depth + 1 - size))
        first = np.searchsorted(keys, hot[size] << shift)
        last = np.searchsorted(keys, (hot[size] << shift) | ((np.uint64(1) << shift) - np.uint64(1)), side="right")
        for lo, hi in zip(first.tolist(), last.tolist(), strict=True):
            sizes[lo:hi] = size + 1
    return sizes


def routes_of(kind: int, keys: np.ndarray, depth: int, routes: int, hot: Hot) -> np.ndarray:
    """The route of a key: contexts that are worked on together go together, words by hash."""
    if kind == GRAMS:
        sizes = shared_bytes(keys, depth, hot).astype(np.uint64)
        keys = keys >> (np.uint64(8) * (np.uint64(depth + 1) - sizes))
        keys = ((keys * np.uint64(8) + sizes) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return (keys % np.uint64(routes)).astype(np.int32)


def hot_contexts(placed: DataFrame, depth: int, chunks: int) -> Hot:
    """Contexts of SHARED bytes and more that precede more than one in HOT_SHARE of the bytes of some chunks.

    They decide only which grams are worked on together, so that no route gets a large share; scores do not depend on
    them. So, as for the bounds of a range partitioning, a few chunks are enough. Fewer than HOT_SHARE a size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, contexts, numbers = [], [], []
            for part in parts_of(normal_texts(pa.chunked_array([batch.column(0)]))):
                codes = part_grams(part, depth)[0]
                for size in range(SHARED, depth):
                    own, n = np.unique(prefix_of(codes, depth, size), return_counts=True)
                    often = n * (4 * HOT_SHARE) > len(codes)
                    sizes.append(np.full(often.sum(), size))
                    contexts.append(own[often].astype(np.int64))
                    numbers.append(n[often])
                sizes.append([0])
                contexts.append([0])
                numbers.append([len(codes)])
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in (sizes, contexts, numbers)]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "context", "n"])
            release_memory()

    some = placed.where(F.pmod(F.xxhash64("chunk"), F.lit(max(1, chunks))) < HOT_CHUNKS).select("text")
    counted = some.mapInArrow(count, "size long, context long, n long").groupBy("size", "context").agg(F.sum("n").alias("n"))
    total = counted.where("size = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    hot: Hot = {}
    # Fewer than HOT_SHARE rows a size.
    rows = counted.where(F.col("size") > 0).where(F.col("n") * HOT_SHARE > total).collect()
    for size in range(SHARED, depth):
        found = np.sort(np.array([r.context for r in rows if r["size"] == size], np.uint64))
        if size > SHARED:
            found = found[np.isin(found >> np.uint64(8), hot[size - 1])]
        if not len(found):
            break
        hot[size] = found
    return hot


def pack_keys(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=np.uint64(0)).tobytes()


def unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, np.uint64), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them, after one byte for its width."""
    width = next(w for w in (1, 2, 4, 8) if not counts.max(initial=0) >> (8 * w))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpack_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def chunk_keys(texts: list[bytes], train: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The distinct keys of a chunk, with their training counts."""
    found = {GRAMS: ([], []), WORDS: ([], [])}
    for learn in (True, False):
        own = [t for t, x in zip(texts, train, strict=True) if x == learn]
        for part in parts_of(own) if own else []:
            codes, _ = part_grams(part, depth)
            keys, counts = np.unique(codes, return_counts=True)
            found[GRAMS][0].append(keys)
            found[GRAMS][1].append((counts * learn).astype(np.int32))
            words, _ = part_words(part)
            found[WORDS][0].append(word_keys(words))
            found[WORDS][1].append(np.bincount(words.indices, minlength=len(words.dictionary)) * learn)
        found[WORDS][0].append(np.array([END_KEY], np.uint64))
        found[WORDS][1].append(np.array([len(own) * learn]))
    return {kind: summed(*both) for kind, both in found.items()}


def by_route(kind: int, keys: np.ndarray, depth: int, routes: int, hot: Hot) -> list[tuple[int, np.ndarray]]:
    """The routes of a chunk's keys, and the places of each route's keys in rising order."""
    route = routes_of(kind, keys, depth, routes, hot)
    order = np.argsort(route, kind="stable")
    bounds = np.searchsorted(route[order], np.arange(routes + 1))
    return [(r, order[bounds[r] : bounds[r + 1]]) for r in np.flatnonzero(np.diff(bounds)).tolist()]


def asked(table: pa.Table, depth: int, routes: int, hot: Hot) -> pa.Table:
    """What one chunk of documents asks of each route: its distinct keys, with their training counts."""
    found = chunk_keys(normal_texts(table.column("text")), table.column("train").to_numpy(), depth)
    chunk = table.column("chunk")[0].as_py()
    rows = [
        (r, chunk, kind, pack_keys(keys[chosen]), pack_counts(counts[chosen]))
        for kind, (keys, counts) in found.items()
        for r, chosen in by_route(kind, keys, depth, routes, hot)
    ]
    return pa.table(list(map(list, zip(*rows, strict=True))), schema=ASKED)


ASKED = pa.schema(
    [("route", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
)
ASKED_DDL = "route int, chunk long, kind int, keys binary, counts binary"
NODES = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_distinct", pa.int64()),
        ("bytes", pa.list_(pa.int32())),
        ("node", pa.list_(pa.int64())),
        ("zeros", pa.list_(pa.float64())),
        ("ones", pa.list_(pa.float64())),
        ("children", pa.list_(pa.float64())),
    ]
)
NODES_DDL = (
    "n_words long, n_distinct long, bytes array<int>, node array<long>, zeros array<double>, ones array<double>,"
    " children array<double>"
)


def _asks(table: pa.Table, kind: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Chunk, keys and counts of the asks of one kind."""
    own = table.filter(pc.equal(table.column("kind"), kind))
    return [
        (chunk.as_py(), unpack_keys(keys.as_buffer()), unpack_counts(counts.as_buffer().to_pybytes()))
        for chunk, keys, counts in zip(own.column("chunk"), own.column("keys"), own.column("counts"), strict=True)
    ]


def _all_asked(asks: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return summed([keys for _, keys, _ in asks], [counts for _, _, counts in asks])


def _route_levels(keys: np.ndarray, counts: np.ndarray, depth: int, size: int) -> list[ct.Level]:
    learned = counts > 0
    return ct.levels_down_to(keys[learned], counts[learned], depth, size)


def gathered(table: pa.Table, depth: int, hot: Hot) -> pa.Table:
    """One row for a route: the sums of its nodes just above, its training words and distinct words."""
    keys, counts = _all_asked(_asks(table, GRAMS))
    sizes = shared_bytes(keys, depth, hot)
    above = []
    for size in np.unique(sizes).tolist():
        own = sizes == size
        sums = ct.parent_sums(_route_levels(keys[own], counts[own], depth, size)[-1])
        above.append((np.full(len(sums[0]), size - 1), *sums))
    joined = [np.concatenate(c) for c in zip(*above, strict=True)] if above else [np.zeros(0)] * 5
    _, times = _all_asked(_asks(table, WORDS))
    kinds = (np.int32, np.int64, float, float, float)
    return pa.table(
        [[int(times.sum())], [int((times > 0).sum())], *[[x.astype(t)] for x, t in zip(joined, kinds, strict=True)]],
        schema=NODES,
    )


def answered(table: pa.Table, depth: int, hot: Hot, top: list[ct.Level]) -> pa.Table:
    """For each chunk that asked, in the order of its keys: log10 probabilities of grams, training counts of words."""
    rows = []
    route = table.column("route")[0].as_py()
    for kind in (GRAMS, WORDS):
        asks = _asks(table, kind)
        keys, values = _all_asked(asks)
        if kind == GRAMS:
            values, counts = np.zeros(len(keys), np.float32), values
            sizes = shared_bytes(keys, depth, hot)
            for size in np.unique(sizes).tolist():
                own = sizes == size
                levels = [*_route_levels(keys[own], counts[own], depth, size), *top[depth - size :]]
                values[own] = ct.log10_probability(keys[own], levels, depth)
        for chunk, own, _ in asks:
            told = values[np.searchsorted(keys, own)]
            rows.append((chunk, route, kind, told.tobytes() if kind == GRAMS else pack_counts(told)))
    return pa.table(list(map(list, zip(*rows, strict=True))), schema=ANSWERED)


ANSWERED = pa.schema([("chunk", pa.int64()), ("route", pa.int32()), ("kind", pa.int32()), ("numbers", pa.binary())])
ANSWERED_DDL = "chunk long, route int, kind int, numbers binary"


def top_nodes(rows: list[tuple], depth: int) -> list[ct.Level]:
    """Levels from ``depth - 1`` bytes to the root: all nodes of the shortest, only hot contexts of the longer ones.

    ``rows`` have bytes, node, zeros, ones and the log weight of the children that the routes summed up; a hot
    context's own node is the child of one above it.
    """
    kinds = (np.int64, np.uint64, float, float, float)
    sizes, *nodes = [np.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    levels: list[ct.Level] = []
    below: tuple[np.ndarray, ...] | None = None
    for size in range(depth - 1, -1, -1):
        parts = [tuple(x[sizes == size] for x in nodes)]
        if below is not None:
            parts.append(below)
        levels.append(ct.mixed(*ct.grouped(*[np.concatenate(c) for c in zip(*parts, strict=True)])))
        below = ct.parent_sums(levels[-1]) if size else None
    return levels


@dataclass
class Part:
    """Some texts of a chunk: their distinct grams and where each occurs, where texts begin, their words."""

    grams: np.ndarray
    places: np.ndarray
    begins: np.ndarray
    word_keys: np.ndarray
    words: np.ndarray
    numbers: np.ndarray


def part_of(texts: list[bytes], depth: int) -> Part:
    codes, begins = part_grams(texts, depth)
    grams, places = np.unique(codes, return_inverse=True)
    words, numbers = part_words(texts)
    return Part(grams, places.astype(np.int32), begins, word_keys(words), words.indices.to_numpy(), numbers)


def scored(
    docs: pa.Table, answers: pa.Table, depth: int, routes: int, hot: Hot, n_train: int, n_distinct: int
) -> pa.Table:
    """Scores of one chunk's documents; the chunk's keys are found again, as answers hold only numbers."""
    if not docs.num_rows:
        return pa.table([[]] * len(SCORED), schema=SCORED)
    parts = [part_of(part, depth) for part in parts_of(normal_texts(docs.column("text")))]
    end = np.array([END_KEY], np.uint64)
    keys_of = {
        GRAMS: distinct([p.grams for p in parts]),
        WORDS: distinct([end, *[p.word_keys for p in parts]]),
    }
    told: dict[tuple[int, int], bytes] = {
        (k.as_py(), r.as_py()): n.as_py()
        for k, r, n in zip(answers.column("kind"), answers.column("route"), answers.column("numbers"), strict=True)
    }
    got = {}
    for kind, unpack in ((GRAMS, lambda packed: np.frombuffer(packed, np.float32)), (WORDS, unpack_counts)):
        keys = keys_of[kind]
        values = np.zeros(len(keys), np.float32 if kind == GRAMS else np.int64)
        for route, chosen in by_route(kind, keys, depth, routes, hot):
            values[chosen] = unpack(told.pop((kind, route)))
        got[kind] = (keys, values)
    gram_keys, chances = got[GRAMS]
    known_keys, known_counts = got[WORDS]
    scale = np.log10(n_train + 0.1 * (n_distinct + 1))
    end_count = known_counts[np.searchsorted(known_keys, np.uint64(END_KEY))]
    columns = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
    for part in parts:
        per_gram = chances[np.searchsorted(gram_keys, part.grams)]
        columns["score"].append(np.add.reduceat(per_gram[part.places], part.begins, dtype=np.float64))
        counts = known_counts[np.searchsorted(known_keys, part.word_keys)]
        ends = np.cumsum(part.numbers)
        for name, per_word, per_end in (
            ("n_known", (counts > 0).astype(np.float64), float(end_count > 0)),
            ("base_score", np.log10(counts + 0.1) - scale, np.log10(end_count + 0.1) - scale),
        ):
            sums = np.concatenate([[0.0], np.cumsum(per_word[part.words])])
            columns[name].append(sums[ends] - sums[ends - part.numbers] + per_end)
        columns["n_tokens"].append(part.numbers + 1)
    whole = {n: np.concatenate(v) for n, v in columns.items()}
    return pa.table(
        [
            docs.column("id"),
            docs.column("train"),
            whole["n_tokens"],
            np.rint(whole["n_known"]).astype(np.int64),
            whole["base_score"],
            whole["score"],
        ],
        schema=SCORED,
    )


SCORED = pa.schema(
    [
        ("id", pa.int64()),
        ("train", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
SCORED_DDL = "id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def language_scores(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = 6,
    chunk_bytes: int = 8 << 20,
) -> DataFrame:
    """Log10 probability of every text by a context tree learned from the rows where ``train`` holds.

    A text is its words (A-Z in lower case) joined by one space, and an end. Each
    byte is eight binary decisions; each decision mixes the Krichevsky-Trofimov estimates of the
    contexts of 0 to ``depth`` bytes by their weight in the context tree of
    the training texts. ``-score * log2(10) / bytes`` is the code length per byte.
    ``base_score`` is that of a smoothed word unigram.

    The tree is never held whole. Documents are written once in chunks of about ``chunk_bytes``; a
    chunk asks for its distinct grams (context and byte) and words, with their training counts.
    Asks meet by the two nearest context bytes (words: by hash), or by more where these precede more than one in 256 of
    all bytes, so no route holds a large share of the asks. There the counts of all chunks
    add up to the tree's part below those bytes; the nodes above (at most 255 for each context of one byte or none and
    each of the hot ones, of which there are fewer than 256 a length) are summed and sent to all. Each
    chunk gets the probability of what it asked, as numbers in the order of its keys. Words are known by 64 bits of hash.

    Returns ``id_col``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (those seen in
    training), ``train_tokens``, ``base_score``, ``score``. Null is the empty text; a null id
    stays null; repeated rows count and come back each; other columns are left out. Without
    training rows every bit costs one binary digit. An empty table gives an empty table.
    """
    if not SHARED < depth < 8:
        raise ValueError(f"depth {depth} is not between {SHARED + 1} and 7")
    placed = in_chunks(
        docs,
        chunk_bytes,
        id=F.col(id_col).cast("long"),
        text=F.encode(F.col(text_col), "UTF-8"),
        train=F.coalesce(train, F.lit(False)),
    )
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = placed.select("chunk").distinct().count()
    routes = max(partitions, 2 * chunks)
    hot = hot_contexts(placed, depth, chunks)
    asks = placed.groupBy("chunk").applyInArrow(lean(lambda table: asked(table, depth, routes, hot)), ASKED_DDL)
    # Written once by route; both passes over the routes read it where it lies.
    kept = stage_buckets(asks.repartition(partitions, "route"), "asks", ["route"], partitions)
    nodes = stage(kept.groupBy("route").applyInArrow(lean(lambda table: gathered(table, depth, hot)), NODES_DDL), "nodes")
    n_train, n_distinct = nodes.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_distinct"), F.lit(0))
    ).first()
    # Contexts of one byte and of none, and the hot ones: 255 nodes each at most.
    above = (
        nodes.select(F.inline(F.arrays_zip("bytes", "node", "zeros", "ones", "children")))
        .groupBy("bytes", "node")
        .agg(F.sum("zeros"), F.sum("ones"), F.sum("children"))
        .collect()
    )
    levels = top_nodes(above, depth)
    shared = spark.sparkContext.broadcast(levels)
    answers = kept.groupBy("route").applyInArrow(
        lean(lambda table: answered(table, depth, hot, shared.value)), ANSWERED_DDL
    )
    done = (
        placed.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(lean(lambda d, a: scored(d, a, depth, routes, hot, n_train, n_distinct)), SCORED_DDL)
    )
    return done.select(
        F.col("id").alias(id_col),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def document_scores(docs: DataFrame, depth: int = 6) -> DataFrame:
    """Every document; the tenth whose crc32 of the id ends in zero is not learned from."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return language_scores(docs, train=number % 10 != 0, depth=depth)
