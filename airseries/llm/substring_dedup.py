"""Removal of passages that an earlier document has, with suffix automata of reference shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.llm.automaton import SuffixAutomaton
from airseries.llm.chunks import in_chunks
from airseries.llm.common import id_of, lean
from airseries.llm.lm_score import pack_keys, part_words, parts_of, unpack_keys, word_keys

#: Words of the k-grams of which the smallest hash is a window's anchor.
ANCHOR = 6
ODD = np.uint64(0x9E3779B97F4A7C15)


class Chunk:
    """The documents of one chunk in an order that does not depend on how they arrived."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("id").to_pylist()
        texts = [b" ".join((t or b"").split()) for t in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = [ids[i] for i in order]
        self.texts = [texts[i] for i in order]

    def parts(self):
        """Documents, their word hashes one after another, and each one's number of words."""
        at = 0
        for texts in parts_of(self.texts):
            words, sizes = part_words(texts)
            yield np.arange(at, at + len(texts)), word_keys(words)[words.indices.to_numpy()], sizes
            at += len(texts)


def anchor_runs(words: np.ndarray, sizes: np.ndarray, window: int, k: int):
    """Runs of windows with the same anchor: anchor, document, first window, last window (as places in ``words``).

    The anchor of a window is the smallest hash among its k-grams, so equal windows have
    equal anchors wherever they are.
    """
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none.astype(np.uint64), none, none, none
    grams = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        grams = grams * ODD + (words[j : j + len(grams)] ^ (words[j : j + len(grams)] >> np.uint64(29)))
    grams = (grams ^ (grams >> np.uint64(32))) * ODD
    least = grams
    span = 1
    while span < window - k + 1:
        step = min(span, window - k + 1 - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(owner[: len(least)] == owner[window - 1 :])
    if not len(starts):
        return none.astype(np.uint64), none, none, none
    anchor = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return anchor[first], owner[starts[first]], starts[first], starts[last]


def _extremes(keys: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Distinct keys with the smallest ``low`` and the largest ``high`` of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    if not len(begins):
        return keys, low, high
    return keys[begins], np.minimum.reduceat(low[order], begins), np.maximum.reduceat(high[order], begins)


def ask(table: pa.Table, window: int, k: int, routes: int) -> pa.Table:
    """A chunk's distinct anchors by route, each marked if two documents of the chunk have it."""
    chunk = Chunk(table)
    ids = np.array(chunk.ids, np.int64)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for docs, words, sizes in chunk.parts():
        anchor, doc, _, _ = anchor_runs(words, sizes, window, k)
        own = ids[docs[doc]]
        found.append(_extremes(anchor, own, own))
    keys, low, high = _extremes(*(np.concatenate(x) for x in zip(*found, strict=True)))
    twice = (low != high).astype(np.uint8)
    route = (keys % np.uint64(routes)).astype(np.int32)
    order = np.argsort(route, kind="stable")
    bounds = np.searchsorted(route[order], np.arange(routes + 1))
    rows = []
    for r in np.flatnonzero(np.diff(bounds)).tolist():
        chosen = order[bounds[r] : bounds[r + 1]]
        rows.append((r, table.column("chunk")[0].as_py(), pack_keys(keys[chosen]), twice[chosen].tobytes()))
    return _table(rows, ASK)


def answer(table: pa.Table) -> pa.Table:
    """To each chunk that asked, those of its anchors that at least two documents have."""
    columns = table.to_pydict()
    asked = [unpack_keys(k) for k in columns["keys"]]
    weight = np.concatenate([np.frombuffer(t, np.uint8) for t in columns["twice"]]) + 1
    keys, where = np.unique(np.concatenate(asked), return_inverse=True)
    repeated = keys[np.bincount(where, weight, len(keys)) > 1]
    rows = []
    for chunk, own in zip(columns["chunk"], asked, strict=True):
        kept = own[np.isin(own, repeated, assume_unique=True)]
        if len(kept):
            rows.append((chunk, pack_keys(kept)))
    return _table(rows, ANSWER)


def segments(table: pa.Table, answers: pa.Table, window: int, k: int, shards: int) -> pa.Table:
    """A chunk's runs of windows with repeated anchors, each distinct run once, by shard of the anchor."""
    if not table.num_rows or not answers.num_rows:
        return _table([], SEGMENT)
    repeated = np.sort(np.concatenate([unpack_keys(x) for x in answers.column("keys").to_pylist()]))
    chunk = Chunk(table)
    distinct: dict[int, dict[bytes, list]] = {}
    for docs, words, sizes in chunk.parts():
        anchor, doc, first, last = anchor_runs(words, sizes, window, k)
        at = np.minimum(np.searchsorted(repeated, anchor), len(repeated) - 1)
        kept = np.flatnonzero(repeated[at] == anchor)
        begins = np.cumsum(sizes) - sizes
        shard = (anchor >> np.uint64(17)) % np.uint64(shards)
        for s, d, a, b in zip(
            shard[kept].tolist(), doc[kept].tolist(), first[kept].tolist(), last[kept].tolist(), strict=True
        ):
            body = words[a : b + window].tobytes()
            distinct.setdefault(s, {}).setdefault(body, []).append((int(docs[d]), a - int(begins[d])))
    number = table.column("chunk")[0].as_py()
    rows = []
    for s, bodies in sorted(distinct.items()):
        places = np.array([p for own in bodies.values() for p in own], np.int32)
        rows.append(
            (
                s,
                number,
                b"".join(bodies),
                np.array([len(b) // 8 for b in bodies], np.int32).tobytes(),
                np.array([len(own) for own in bodies.values()], np.int32).tobytes(),
                places.tobytes(),
                np.array([chunk.ids[d] for d in places[:, 0].tolist()], np.int64).tobytes(),
            )
        )
    return _table(rows, SEGMENT)


def match(table: pa.Table, window: int) -> pa.Table:
    """Stream a shard's runs through its automaton in rising order of document; covered words by chunk.

    The automaton holds the runs of the documents before. Wherever at least ``window`` words match,
    the state of the last ``window`` tells the first document that has them. Runs
    with windows not seen before are added.
    """
    columns = table.to_pydict()
    # Small numbers in place of hashes: the automaton's steps are looked up by them.
    _, codes = np.unique(
        np.concatenate([np.frombuffer(w, np.uint64) for w in columns["words"]]), return_inverse=True
    )
    runs = []
    at = 0
    for row, (sizes, numbers, places, ids) in enumerate(
        zip(*(columns[c] for c in ("sizes", "numbers", "places", "ids")), strict=True)
    ):
        sizes, numbers = np.frombuffer(sizes, np.int32), np.frombuffer(numbers, np.int32)
        places, ids = np.frombuffer(places, np.int32).reshape(-1, 2), np.frombuffer(ids, np.int64)
        upto = np.cumsum(numbers)
        for size, till, number in zip(sizes.tolist(), upto.tolist(), numbers.tolist(), strict=True):
            own = slice(till - number, till)
            runs.append((int(ids[own].min()), row, codes[at : at + size], places[own], ids[own]))
            at += size
    runs.sort(key=lambda run: run[:2])
    automaton = SuffixAutomaton()
    covered: dict[int, list[tuple[int, int, int]]] = {}
    known: dict[bytes, np.ndarray] = {}
    for least, row, words, places, ids in runs:
        # What a run's windows first belong to is settled once it was streamed: later runs are of later documents.
        first = known.get(words.tobytes())
        if first is None:
            tokens = words.tolist()
            found = automaton.firsts(tokens, window, None)
            if None in found:
                automaton.add(tokens, least)
            first = np.array([least if f is None else f for f in found], np.int64)
            known[words.tobytes()] = first
        for (doc, start), own in zip(places.tolist(), ids.tolist(), strict=True):
            earlier = np.flatnonzero(first < own)
            if not len(earlier):
                continue
            cuts = np.flatnonzero(np.diff(earlier) > 1)
            begins, ends = earlier[np.append(0, cuts + 1)], earlier[np.append(cuts, len(earlier) - 1)]
            spans = covered.setdefault(row, [])
            for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                spans.append((doc, start + a, start + b + window))
    return _table(
        [(columns["chunk"][row], np.array(s, np.int32).tobytes()) for row, s in covered.items()], COVERED
    )


def cut(table: pa.Table, spans: pa.Table) -> pa.Table:
    """A chunk's documents without their covered words."""
    if not table.num_rows:
        return _table([], CUT)
    chunk = Chunk(table)
    covered: dict[int, list[tuple[int, int]]] = {}
    for packed in spans.column("spans").to_pylist():
        for doc, begin, end in np.frombuffer(packed, np.int32).reshape(-1, 3).tolist():
            covered.setdefault(doc, []).append((begin, end))
    rows = []
    for doc, (own, text) in enumerate(zip(chunk.ids, chunk.texts, strict=True)):
        words = text.split()
        kept, at, merged = [], 0, []
        for begin, end in sorted(covered.get(doc, ())):
            if begin > at or not merged:
                kept += words[at:begin]
                merged.append([begin, end])
            else:
                merged[-1][1] = max(end, merged[-1][1])
            at = max(at, end)
        kept += words[at:]
        rows.append((own, len(words), len(words) - len(kept), b" ".join(kept), merged))
    return _table(rows, CUT)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(*fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema(list(fields))


INT, LONG, BLOB = pa.int32(), pa.int64(), pa.binary()
ASK = _schema(("route", INT), ("chunk", LONG), ("keys", BLOB), ("twice", BLOB))
ANSWER = _schema(("chunk", LONG), ("keys", BLOB))
SEGMENT = _schema(
    ("shard", INT), ("chunk", LONG), ("words", BLOB), ("sizes", BLOB), ("numbers", BLOB), ("places", BLOB), ("ids", BLOB)
)
COVERED = _schema(("chunk", LONG), ("spans", BLOB))
CUT = _schema(
    ("id", pa.int64()),
    ("n_words", pa.int64()),
    ("n_removed", pa.int64()),
    ("kept_text", BLOB),
    ("removed_spans", pa.list_(pa.list_(INT))),
)
DDL = {
    "ask": "route int, chunk long, keys binary, twice binary",
    "answer": "chunk long, keys binary",
    "segment": "shard int, chunk long, words binary, sizes binary, numbers binary, places binary, ids binary",
    "covered": "chunk long, spans binary",
    "cut": "id long, n_words long, n_removed long, kept_text binary, removed_spans array<array<int>>",
}


def dedup_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 13,
    chunk_bytes: int = 16 << 20,
    shard_bytes: int = 4 << 20,
) -> DataFrame:
    """Remove every word inside a window of words that a document with a smaller id also has.

    Documents that follow each other share a chunk of at most ``chunk_bytes`` (or one longer text), whatever
    their ids and texts are. Each window has an anchor, the
    smallest hash of its k-grams. A chunk asks which of its anchors occur in two documents; only
    runs of windows with such anchors go on, each distinct run once per chunk, to the
    reference shard of their anchor. There they stream through the shard's suffix automaton in
    rising order of id: matching statistics of at least ``window`` words give the first document
    with the same words. A passage that a third of all documents share reaches its shard
    once per chunk. Automata grow with the corpus, so runs are sent to shards of bounded size
    instead of sending the automata to all documents. Words are known by 64 bits of hash.

    Returns ``id_col``, ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space),
    ``removed_spans`` (from, to in words; maximal). Null and empty texts have no words. A null
    id counts as the smallest; rows with one id are one document and remove nothing from each
    other. Rows come back once each; other columns are left out.
    """
    if window < ANCHOR:
        raise ValueError(f"a window has at least {ANCHOR} words")
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    chunks = total // chunk_bytes + 1
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    routes, shards = max(least, 2 * chunks), max(least, total // shard_bytes + 1)
    # Written once; all three passes over the texts read the chunks where they lie.
    placed = in_chunks(docs, chunk_bytes, id=id_of(id_col), text=F.encode(F.col(text_col), "UTF-8"))
    asks = placed.groupBy("chunk").applyInArrow(lean(lambda t: ask(t, window, ANCHOR, routes)), DDL["ask"])
    answers = asks.groupBy("route").applyInArrow(lean(answer), DDL["answer"])
    runs = (
        placed.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(lean(lambda t, a: segments(t, a, window, ANCHOR, shards)), DDL["segment"])
    )
    spans = runs.groupBy("shard").applyInArrow(lean(lambda t: match(t, window)), DDL["covered"])
    done = placed.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(lean(cut), DDL["cut"])
    return done.select(
        F.when(F.col("id") != -(1 << 63), F.col("id")).alias(id_col),
        "n_words",
        "n_removed",
        F.decode("kept_text", "UTF-8").alias("kept_text"),
        "removed_spans",
    )


def passage_digest(docs: DataFrame) -> DataFrame:
    """Per document: words, removed words, and the digest of what stays."""
    return dedup_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
