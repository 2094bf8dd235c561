"""How two tokenizers cut the same bytes, and how often their ids end together over a corpus."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.llm import tokens
from airseries.llm.common import release_memory
from airseries.session import stage

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k", "piece_bpe_32k"
#: The mark a piece vocabulary writes for a space, and its pieces for single bytes.
MARK, BYTE_PIECE = "▁", re.compile(r"<0x([0-9A-F]{2})>")
#: A pair with more than one in so many of all links is hot; there are fewer such pairs than this.
HOT_SHARE = 1 << 16
#: Bytes of text that are aligned at once; a longer text is aligned alone.
PART = 4 << 20


def byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: printable ones as they are, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.cache
def plain_a():
    """Vocabulary A's own encoder; strings that name a special token are ordinary text."""
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokens.vocabulary_path(f"{A_VOCABULARY}.json"))
    encoder.encode_special_tokens = True
    return encoder


@functools.cache
def piece_encoder():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary_path(f"{B_VOCABULARY}.model"))


@functools.cache
def a_bytes() -> list[bytes]:
    """The bytes of every id of A."""
    letters = byte_letters()
    encoder = plain_a()
    names = [encoder.id_to_token(i) or "" for i in range(encoder.get_vocab_size())]
    return [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names]


@functools.cache
def b_bytes() -> list[bytes]:
    """The bytes of every id of B."""
    encoder = piece_encoder()
    names = [encoder.id_to_piece(i) for i in range(encoder.get_piece_size())]
    return [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(n)) else n.replace(MARK, " ").encode() for n in names]


@functools.cache
def sizes_of(which: str) -> np.ndarray:
    return np.array([len(b) for b in (a_bytes() if which == "a" else b_bytes())], np.int64)


@functools.cache
def identity_map() -> np.ndarray:
    """For every id of A the B id with the same bytes, -1 where there is none.

    Where several ids of B have these bytes, one that is no single-byte piece is taken, and of those the smallest.
    """
    encoder = piece_encoder()
    same: dict[bytes, int] = {}
    for i in sorted(range(len(b_bytes())), key=lambda i: (bool(encoder.is_byte(i)), i)):
        same.setdefault(b_bytes()[i], i)
    return np.array([same.get(b, -1) for b in a_bytes()], np.int64)


def encode_a(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A one after another, where each text's ids begin and end, and whether they spell the text."""
    odd = {i for i, t in enumerate(texts) if tokens.ODD.search(t)}
    usual, _ = [t for i, t in enumerate(texts) if i not in odd], None
    flat, ends = tokens.encode_texts(usual)
    parts, own, right = [], iter(range(len(usual))), np.ones(len(texts), bool)
    for i, text in enumerate(texts):
        if i in odd:
            ids = np.array(plain_a().encode(text.decode(), add_special_tokens=False).ids, np.int64)
            right[i] = b"".join([a_bytes()[x] for x in ids.tolist()]) == text
        else:
            k = next(own)
            ids = flat[ends[k] : ends[k + 1]].astype(np.int64)
            right[i] = sizes_of("a")[ids].sum() == len(text)
        parts.append(ids)
    return _joined(parts), np.cumsum([0, *map(len, parts)]), right


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def encode_b(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of B for texts that begin with the space B would add, as :func:`encode_a` gives those of A.

    No piece of B holds a space after another character (checked below), so merges never cross the start of a
    run of spaces: texts are cut before every space that follows a non-space, and each distinct piece is encoded once.
    """
    encoder = piece_encoder()
    pieces: dict[bytes, int] = {}
    cuts = [re.findall(rb"\x20*[^\x20]+|\x20+", t) for t in texts] if _cut_at_spaces() else [[t] for t in texts]
    numbers = [np.array([pieces.setdefault(p, len(pieces)) for p in own], np.int64) for own in cuts]
    found, right = [], np.zeros(len(pieces), bool)
    # Each piece begins with a space, which the encoder adds.
    for k, ids in enumerate(encoder.encode([p[1:].decode() for p in pieces], num_threads=1)):
        found.append(np.array(ids, np.int64))
    lone = pieces.get(b" ")
    if lone is not None:
        found[lone] = np.array([encoder.piece_to_id(MARK)], np.int64)
    for k, (piece, ids) in enumerate(zip(pieces, found, strict=True)):
        right[k] = b"".join([b_bytes()[x] for x in ids.tolist()]) == piece
    lengths = np.array([len(ids) for ids in found], np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat, which = _joined(found), _joined(numbers)
    counts = lengths[which] if len(which) else np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    ids = flat[np.repeat(bounds[which] - before[:-1], counts) + np.arange(before[-1])] if len(which) else flat
    ends = before[np.cumsum([0, *map(len, numbers)])]
    return ids, ends, np.array([bool(right[own].all()) for own in numbers], bool)


@functools.cache
def _cut_at_spaces() -> bool:
    return not any(b" " in b.lstrip(b" ") for b in b_bytes())


class Aligned:
    """The groups of a batch of texts: ids of both sides, and the bounds of every group and text."""

    def __init__(self, texts: list[bytes | None]) -> None:
        spelled = [b" " + t if t else b"" for t in texts]
        filled = [i for i, t in enumerate(spelled) if t]
        a, a_ends, a_right = encode_a([spelled[i] for i in filled])
        b, b_ends, b_right = encode_b([spelled[i] for i in filled])
        right = a_right & b_right
        if not right.all():
            # Without tokens: taken out and aligned as empty texts.
            keep = np.flatnonzero(right)
            a, a_ends = _picked(a, a_ends, keep)
            b, b_ends = _picked(b, b_ends, keep)
            filled = [filled[i] for i in keep.tolist()]
        self.a, self.b = a, b
        self.n_a, self.n_b, self.n_groups = (np.zeros(len(texts), np.int64) for _ in range(3))
        self.n_a[filled], self.n_b[filled] = np.diff(a_ends), np.diff(b_ends)
        a_stops, b_stops = np.cumsum(sizes_of("a")[a]), np.cumsum(sizes_of("b")[b])
        common = np.intersect1d(a_stops, b_stops, assume_unique=True)
        #: One past the last token of each group, on both sides.
        self.a_upto = np.searchsorted(a_stops, common, side="right")
        self.b_upto = np.searchsorted(b_stops, common, side="right")
        text_of = np.searchsorted(a_ends, self.a_upto, side="left") - 1
        self.n_groups[filled] = np.bincount(text_of, minlength=len(filled))[: len(filled)]
        a_many, b_many = np.diff(self.a_upto, prepend=0), np.diff(self.b_upto, prepend=0)
        self.last_a, self.last_b = a[self.a_upto - 1], b[self.b_upto - 1]
        self.regular = (a_many == 1) & (b_many == 1) & (identity_map()[self.last_a] == self.last_b)
        self.a_many, self.b_many = a_many, b_many
        self.first_group = np.concatenate([[0], np.cumsum(self.n_groups)])

    def names(self) -> list[str]:
        """Every group as written in the digest: ids of A, a bar, ids of B."""
        names = np.array(_regular_names(), object)[self.last_a]
        a, b, seen = self.a, self.b, {}
        for g in np.flatnonzero(~self.regular).tolist():
            own_a = a[self.a_upto[g] - self.a_many[g] : self.a_upto[g]]
            own_b = b[self.b_upto[g] - self.b_many[g] : self.b_upto[g]]
            key = (own_a.tobytes(), own_b.tobytes())
            name = seen.get(key)
            if name is None:
                name = ",".join(map(str, own_a.tolist())) + "|" + ",".join(map(str, own_b.tolist()))
                seen[key] = name
            names[g] = name
        return names.tolist()


def _picked(ids: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = [ids[ends[i] : ends[i + 1]] for i in keep.tolist()]
    return _joined(own), np.cumsum([0, *map(len, own)])


@functools.cache
def _regular_names() -> list[str]:
    return [f"{a}|{b}" for a, b in enumerate(identity_map().tolist())]


ALIGNED_DDL = (
    "id long, n_a long, n_b long, n_groups long, groups_sha256 string, regular binary, pairs array<long>, times array<int>"
)


def _aligned_batch(ids: pa.Array, texts: list[bytes | None], schema: pa.Schema) -> pa.RecordBatch:
    found = Aligned(texts)
    names, first = found.names(), found.first_group.tolist()
    codes = found.last_a * len(b_bytes()) + found.last_b
    shas, regular, pairs, times = [], [], [], []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        shas.append(hashlib.sha256(";".join(names[lo:hi]).encode()).hexdigest() if hi > lo else "")
        same = found.regular[lo:hi]
        regular.append(found.last_a[lo:hi][same].astype(np.uint32).tobytes())
        own, often = np.unique(codes[lo:hi][~same], return_counts=True)
        pairs.append(own)
        times.append(often.astype(np.int32))
    columns = [ids, found.n_a, found.n_b, found.n_groups, shas, regular, pairs, times]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _arrow(ddl: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T._parse_datatype_string(ddl)
    return schema, to_arrow_schema(schema)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The groups of every text, staged: ``row``, ``id``, counts, digest, regular A ids, irregular pairs and their times.

    A pair is written as ``a * (ids of B) + b``. No shuffle; a task holds PART bytes of text, or one longer text.
    """
    schema, arrow = _arrow(ALIGNED_DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            start, held = 0, 0
            for i in range(batch.num_rows + 1):
                size = len(texts[i].as_buffer()) if i < batch.num_rows and texts[i].is_valid else 0
                if i > start and (i == batch.num_rows or held + size > PART):
                    part = texts[start:i].to_pylist()
                    yield _aligned_batch(batch.column(0)[start:i], part, arrow)
                    start, held = i, 0
                    release_memory()
                held += size

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    found = source.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    return stage(found, "aligned")


def regular_counts(aligned: DataFrame) -> np.ndarray:
    """Corpus-wide links of every A id with its same-bytes B id: a vector as long as the vocabulary."""
    size = len(a_bytes())
    schema, arrow = _arrow("a long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), np.uint32), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], schema=arrow)

    # One row per id of the vocabulary comes back, whatever the corpus.
    rows = aligned.select("regular").mapInArrow(run, schema).groupBy("a").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    for a, n in rows:
        counts[a] = n
    return counts


def aligned_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document how its tokens of A and B line up, and how common its links are over the corpus.

    A encodes a space and the text, B the text (it adds the space). Byte offsets where both end a token cut
    them into groups; the two tokens that end there are linked. A link of an A id with the B id of the same bytes
    that is a group by itself is regular: it is counted in a vector as long as the vocabulary. All other links are
    pairs, which are summed by shuffle. Pairs that hold more than one in 65,536 of all links (fewer than 65,536,
    whatever the corpus) are looked up from a broadcast table like the vectors; the others meet their counts in a
    join, in which a key therefore never holds more than that share.

    Returns ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is the commonest of
    its B id, ties included), ``count_sum`` (of the pairs' counts, over links), ``groups_sha256``. Texts that are null,
    empty, or not spelled by their tokens (B writes a space for U+2581) have no tokens: zeros and an empty digest.
    A null id stays null, repeated rows count and come back each, other columns are left out, and an empty table
    gives an empty table.
    """
    aligned = align(docs, id_col, text_col)
    spark, width = docs.sparkSession, len(b_bytes())
    by_a = regular_counts(aligned)
    totals = stage(
        aligned.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs").agg(F.sum("times").alias("n")), "pairs"
    )
    # One row per id of B comes back.
    highest = totals.groupBy((F.col("pairs") % width).alias("b")).agg(F.max("n").alias("n"), F.sum("n").alias("all")).collect()
    best, links = np.zeros(width, np.int64), int(by_a.sum())
    np.maximum.at(best, identity_map()[by_a > 0], by_a[by_a > 0])
    for b, n, together in highest:
        best[b] = max(best[b], n)
        links += together
    hot = totals.where(F.col("n") > links // HOT_SHARE).collect()
    hot_pairs = np.array(sorted((r.pairs, r.n) for r in hot), np.int64).reshape(-1, 2)
    known = spark.sparkContext.broadcast((by_a, best, hot_pairs))
    schema, arrow = _arrow("row long, sum long, best long, pairs array<long>, times array<int>")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, highest, hot_table = known.value
        is_best = counts == highest[identity_map()]
        for batch in batches:
            rows = []
            for row, regular, pairs, times in zip(*batch.columns, strict=True):
                ids = np.frombuffer(regular.as_buffer(), np.uint32)
                own, often = pairs.values.to_numpy(), times.values.to_numpy().astype(np.int64)
                at = np.searchsorted(hot_table[:, 0], own)
                is_hot = at < len(hot_table)
                is_hot[is_hot] = hot_table[at[is_hot], 0] == own[is_hot]
                n = hot_table[at[is_hot], 1]
                top = n == highest[own[is_hot] % width]
                rows.append(
                    (
                        row.as_py(),
                        int(counts[ids].sum() + (n * often[is_hot]).sum()),
                        int(is_best[ids].sum() + often[is_hot][top].sum()),
                        own[~is_hot],
                        often[~is_hot],
                    )
                )
            columns = list(zip(*rows, strict=True)) or [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    looked_up = stage(aligned.select("row", "regular", "pairs", "times").mapInArrow(look_up, schema), "looked_up")
    tops = spark.createDataFrame([(int(b), int(n)) for b, n in enumerate(best)], "b long, top long")
    cold = (
        looked_up.select("row", F.inline(F.arrays_zip("pairs", "times")))
        .join(totals, "pairs")
        .withColumn("b", F.col("pairs") % width)
        # One row per id of B.
        .join(F.broadcast(tops), "b")
        .select(
            "row",
            (F.col("n") * F.col("times")).alias("sum"),
            F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0).cast("long").alias("best"),
        )
    )
    sums = (
        looked_up.select("row", "sum", "best").unionByName(cold).groupBy("row").agg(F.sum("sum").alias("sum"), F.sum("best").alias("best"))
    )
    return aligned.join(sums, "row").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.col("best").alias("n_best"),
        F.col("sum").alias("count_sum"),
        "groups_sha256",
    )


def alignment_digest(docs: DataFrame) -> DataFrame:
    return aligned_links(docs)
