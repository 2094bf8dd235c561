"""Benchmark decontamination with a generalised suffix automaton of normalised test items."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.llm.automaton import SuffixAutomaton
from airseries.llm.common import as_bytes, free_names, map_rows
from airseries.session import stage

#: Bytes as normalised: letters and digits of ASCII in lower case, bytes beyond ASCII as they are, else a space.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z."""
    return text.translate(NORMAL).split()


class ItemIndex:
    """Automaton of test items with, for each window's state, the items that hold it.

    A window is ``size`` consecutive words of an item; an item of fewer words,
    but not none, is one window.
    """

    def __init__(self, items: list[tuple[str, bytes]], size: int) -> None:
        self.size = size
        self.words: dict[bytes, int] = {}
        self.automaton = SuffixAutomaton()
        self.long: dict[int, set[str]] = {}
        self.short: dict[tuple[int, int], set[str]] = {}
        coded = []
        for item, text in items:
            own = [self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)]
            if own:
                coded.append((item, own))
                self.automaton.add(own, item)
        for item, own in coded:
            state = matched = 0
            for code in own:
                state, matched = self.automaton.advance(state, matched, code)
                if matched >= size:
                    self.long.setdefault(self.automaton.capped(state, size), set()).add(item)
            if len(own) < size:
                at = self.automaton.capped(state, len(own))
                self.short.setdefault((at, len(own)), set()).add(item)
        self.short_sizes = sorted({n for _, n in self.short})
        self.least = min([size, *self.short_sizes])

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str], int]:
        """Hit flag per word (None: no hit), items with occurring windows, longest match."""
        codes = np.fromiter(map(self.words.get, words, [0] * len(words)), np.int32, len(words))
        # Only runs of words that items use, as long as the shortest window, can hold one.
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (codes != 0).view(np.int8), [0]])))
        begins, ends = edges[::2], edges[1::2]
        long_enough = ends - begins >= self.least
        hits, found, longest = None, set(), 0
        for begin, end in zip(begins[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            state = matched = 0
            for place, code in enumerate(codes[begin:end].tolist(), begin + 1):
                state, matched = self.automaton.advance(state, matched, code)
                longest = max(longest, matched)
                sizes = [n for n in self.short_sizes if n <= matched]
                if matched >= self.size:
                    sizes.append(self.size)
                for n in sizes:
                    at = self.automaton.capped(state, n)
                    items = self.long.get(at) if n == self.size else self.short.get((at, n))
                    if items:
                        hits = np.zeros(len(words), bool) if hits is None else hits
                        hits[place - n : place] = True
                        found |= items
        return hits, found, longest


def cut_spans(text: bytes, hits: np.ndarray) -> bytes:
    """The text without its runs of hit words, each from its first word's start to its last word's end."""
    places = [m.span() for m in WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hits.view(np.int8), [0]])))
    kept, at = [], 0
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        kept.append(text[at : places[begin][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    max_coverage: float = 0.5,
    shard_words: int = 4_000_000,
    keep: list[str] | None = None,
) -> DataFrame:
    """Scan documents for windows of test items and cut what they hit.

    The columns in ``keep`` (all by default) come back with these, which replace columns
    of the same name: ``n_words``, ``n_hit`` (words inside any occurrence of
    a window), ``hit_items`` (sorted item ids as strings), ``longest_match`` (words), ``clean_text``
    (hit spans cut out; the text itself if none) and ``covered`` (hit share above
    ``max_coverage``: the document is mostly test material).

    The automata of the items are broadcast in shards of at most about
    ``shard_words`` words (an item is never split), which bounds the memory at
    any number of items; documents are streamed once per shard, the hits of the
    shards before riding along. Items are read to the driver one shard at a time.

    Null and empty texts have no words and no hits, items without words
    and null items match nothing, repeated items share their windows. A null item
    id is the empty string. Empty tables give empty results. Other columns may have any name.
    """
    keep = list(docs.columns) if keep is None else keep
    keep = [c for c in keep if c.lower() not in {name for name, _ in FOUND}]
    carry = list(zip(free_names(docs, *[name for name, _ in CARRIED]), [kind for _, kind in CARRIED], strict=True))
    named = items.select(
        F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("item"),
        F.col(item_text_col).cast("binary").alias("body"),
    ).where(F.col("body").isNotNull())
    # A word takes two bytes at least with its separator.
    size = named.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0] // 2
    shards = max(1, -(-size // shard_words))
    scanned = docs
    for number in range(shards):
        own = named.where(F.pmod(F.xxhash64("item"), F.lit(shards)) == number)
        index = docs.sparkSession.sparkContext.broadcast(
            ItemIndex([(r.item, bytes(r.body)) for r in own.sort("item").toLocalIterator()], window)
        )
        last = number == shards - 1
        scanned = _scan(scanned, index, keep, text_col, max_coverage, carry, number > 0, last)
        if not last:
            scanned = stage(scanned, "decontaminate")
    return scanned


#: What the scan says of a document.
FOUND = [
    ("n_words", "long"),
    ("n_hit", "long"),
    ("hit_items", "array<string>"),
    ("longest_match", "long"),
    ("clean_text", "string"),
    ("covered", "boolean"),
]
#: What goes from one shard's pass to the next: hit flags as bytes, items, longest match.
CARRIED = [("__hits", "binary"), ("__items", "array<string>"), ("__longest", "long")]


def _scan(
    docs: DataFrame,
    index,
    keep: list[str],
    text_col: str,
    max_coverage: float,
    carry: list[tuple[str, str]],
    carried: bool,
    last: bool,
) -> DataFrame:
    columns = list(docs.columns)
    places = {c: columns.index(c) for c in [text_col, *(n for n, _ in carry if carried)]}

    def make(batch: pa.RecordBatch) -> dict:
        texts = as_bytes(batch.column(places[text_col])).to_pylist()
        old = [batch.column(places[n]).to_pylist() for n, _ in carry] if carried else [[None] * len(texts)] * 3
        out = {n: [] for n, _ in (FOUND if last else carry)}
        for text, flags, items, longest in zip(texts, *old, strict=True):
            words = words_of(text or b"")
            hits, found, most = index.value.scan(words)
            if flags is not None:
                before = np.frombuffer(flags, bool)
                hits = before.copy() if hits is None else hits | before
            found = sorted(found.union(items or ()))
            most = max(most, longest or 0)
            if not last:
                row = (None if hits is None else hits.tobytes(), found, most)
            else:
                n_hit = 0 if hits is None else int(hits.sum())
                clean = text if hits is None else cut_spans(text, hits)
                row = (len(words), n_hit, found, most, clean, n_hit > max_coverage * len(words))
            for name, value in zip(out, row, strict=True):
                out[name].append(value)
        if last:
            out["clean_text"] = pa.array(out["clean_text"], pa.binary()).cast(pa.string())
        return out

    kept = keep if last else list(dict.fromkeys([*keep, text_col]))
    return map_rows(docs, kept, FOUND if last else carry, make)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, hit words, and the digest of the items that occur."""
    found = decontaminate(docs.select("doc_id", "text"), items, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
