"""Token counts that follow edits: only what an edit touches is encoded again."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.llm.common import as_bytes, id_of, map_rows, release_memory
from airseries.llm.token_tree import TokenTree, pack_leaves, piece_starts
from airseries.llm.tokens import VOCABULARY, encode_pieces

#: (first byte, number of bytes, new bytes), in places of the text before any edit.
Edit = tuple[int, int, bytes]

#: What the registered query masks: (what to find, what to put there).
MASKS = [
    (re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), b"<EMAIL>"),
    (re.compile(rb"https?://[^\x00-\x20]+"), b"<URL>"),
    (re.compile(rb"[0-9][0-9().-]{2,}[0-9]|[0-9]+"), b"0"),
    (re.compile(rb"([!#$%&*|])\1+"), b""),
]

#: Texts whose pieces are encoded together.
TEXTS_AT_ONCE = 1000


def leaves_of(texts: list[bytes], vocabulary: str = VOCABULARY) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bytes and tokens of the pieces of each text; every distinct piece is encoded once."""
    starts = [piece_starts(t) for t in texts]
    first = np.cumsum([0, *map(len, texts)])
    offsets = np.append(np.concatenate([s + f for s, f in zip(starts, first[:-1], strict=True)]), first[-1])
    joined = b"".join(texts)
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]
    ).dictionary_encode()
    _, bounds = encode_pieces(pieces.dictionary, vocabulary)
    counts, sizes = np.diff(bounds)[pieces.indices.to_numpy()], np.diff(offsets)
    ends = np.cumsum([len(s) for s in starts]).tolist()
    return [(sizes[a:b], counts[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def tree_of(text: bytes, vocabulary: str = VOCABULARY) -> TokenTree:
    return TokenTree(*leaves_of([text], vocabulary)[0])


def count_tokens(
    docs: DataFrame,
    keep: list[str] | None = None,
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """The columns in ``keep`` (all by default), ``tree`` (packed segment tree) and ``n_tokens`` of every row.

    A leaf is a piece of the text up to the next space after a non-space, a few pre-tokens. Null
    and empty texts have an empty tree and no tokens; strings that name special tokens
    are ordinary text. Kept columns of the new names are replaced. Nothing is shuffled.
    """
    keep = list(docs.columns) if keep is None else keep
    place = docs.columns.index(text_col)

    def make(batch: pa.RecordBatch) -> dict:
        trees, totals = [], []
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            texts = as_bytes(batch.column(place).slice(at, TEXTS_AT_ONCE)).to_pylist()
            for sizes, counts in leaves_of([t or b"" for t in texts], vocabulary):
                trees.append(pack_leaves(sizes, counts))
                totals.append(int(counts.sum()))
        release_memory()
        return {"tree": trees, "n_tokens": totals}

    return map_rows(docs, keep, [("tree", "binary"), ("n_tokens", "long")], make)


def regions_of(text: bytes, tree: TokenTree, edits: list[Edit]) -> tuple[list[tuple[int, int, int, int, bytes]], int]:
    """Regions (first leaf, last leaf, first byte, last byte, new bytes) to encode again; edits applied.

    A region runs from the last piece start before its edit to the first after it, so the
    characters that make those places piece starts stay. Regions that meet are one. An edit that
    begins before the end of the one before, reaches beyond the text or cuts a
    character is left out.
    """
    kept, done = [], 0
    for start, length, new in sorted(edits):
        end = start + length
        inside = text[start : start + 1] + text[end : end + 1]
        if start >= done and length >= 0 and end <= len(text) and not any(0x80 <= b < 0xC0 for b in inside):
            kept.append((start, end, new))
            done = end
    if not kept:
        return [], 0
    starts, ends = np.array([k[0] for k in kept]), np.array([k[1] for k in kept])
    first, begin = tree.find(np.maximum(starts - 1, 0))
    last, after = tree.find(ends)
    # The piece with the first byte after the edit is the region's last, unless the text ends there.
    within = last < tree.n_leaves
    after = np.where(within, after + tree.bytes[0][np.minimum(last, max(0, tree.n_leaves - 1))], after) if tree.n_leaves else after
    last = last + within
    out: list[list] = []
    for (start, end, new), a, b, p, q in zip(
        kept, first.tolist(), last.tolist(), begin.tolist(), after.tolist(), strict=True
    ):
        if out and (p < out[-1][3] or not text):
            own = out[-1]
            own[1], own[3] = max(own[1], b), max(own[3], q)
        else:
            own = [a, b, p, q, [], p]
            out.append(own)
        own[4] += [text[own[5] : start], new]
        own[5] = end
    return [(a, b, p, q, b"".join([*parts, text[at:q]])) for a, b, p, q, parts, at in out], len(kept)


def edited(
    texts: list[bytes], trees: list[TokenTree], edits: list[list[Edit]], vocabulary: str = VOCABULARY
) -> list[tuple[bytes, int, int]]:
    """Apply the edits to each text and its tree: new text, number of edits applied, bytes encoded again.

    Only the regions around edits are encoded, those of all texts together; the trees' sums
    change along their paths.
    """
    found = [regions_of(*row) for row in zip(texts, trees, edits, strict=True)]
    bodies = [region[4] for regions, _ in found for region in regions]
    fresh = iter(leaves_of(bodies, vocabulary) if bodies else [])
    out = []
    for text, tree, (regions, applied) in zip(texts, trees, found, strict=True):
        parts, at = [], 0
        for _, _, begin, after, body in regions:
            parts += [text[at:begin], body]
            at = after
        if regions:
            tree.replace([(first, last, *next(fresh)) for first, last, *_ in regions])
        out.append((b"".join([*parts, text[at:]]), applied, sum(len(r[4]) for r in regions)))
    return out


def attach_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``trees`` with a column ``edits`` from a table of ``id_col``, ``start``, ``length`` (bytes) and ``replacement``.

    Edits with a null place are left out, a null replacement deletes. Rows with one id all get
    its edits; a null id counts as the smallest. The edits of one document are collected
    with its text, which bounds them.
    """
    own = (
        edits.where("start is not null and length is not null")
        .groupBy(id_of(id_col).alias("__doc"))
        .agg(
            F.collect_list(
                F.struct(
                    F.col("start").cast("long").alias("start"),
                    F.col("length").cast("long").alias("length"),
                    F.coalesce(F.col("replacement").cast("binary"), F.lit(b"")).alias("new"),
                )
            ).alias("edits")
        )
    )
    joined = trees.drop("edits").withColumn("__doc", id_of(id_col)).join(own, "__doc", "left")
    return joined.drop("__doc")


def recount(
    trees: DataFrame,
    keep: list[str],
    find: Callable[[bytes], list[Edit]] | None = None,
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Edit counted texts and carry their counts along.

    Edits come from the column ``edits`` (see ``attach_edits``) or from ``find``, which names
    the edits of a text. Returns ``keep``, ``text_col``, ``tree`` and ``n_tokens`` after the edits,
    and ``tokens_before``, ``n_edits``, ``encoded_bytes``. Rows without edits stay as they are.
    Nothing is shuffled.
    """
    places = {n: trees.columns.index(n) for n in [text_col, "tree", "n_tokens", *([] if find else ["edits"])]}

    def make(batch: pa.RecordBatch) -> dict:
        texts = as_bytes(batch.column(places[text_col])).to_pylist()
        packed = batch.column(places["tree"]).to_pylist()
        before = batch.column(places["n_tokens"]).to_pylist()
        if find:
            changes = [find(t or b"") for t in texts]
        else:
            changes = [
                [(e["start"], e["length"], e["new"]) for e in own or ()]
                for own in batch.column(places["edits"]).to_pylist()
            ]
        after, n_edits, encoded = list(before), [0] * len(texts), [0] * len(texts)
        rows = [i for i, own in enumerate(changes) if own]
        for at in range(0, len(rows), TEXTS_AT_ONCE):
            some = rows[at : at + TEXTS_AT_ONCE]
            own = [TokenTree.unpack(packed[i]) for i in some]
            done = edited([texts[i] or b"" for i in some], own, [changes[i] for i in some], vocabulary)
            for i, tree, (text, applied, again) in zip(some, own, done, strict=True):
                if applied:
                    texts[i], n_edits[i], encoded[i] = text, applied, again
                    packed[i], after[i] = tree.pack(), tree.n_tokens
        release_memory()
        return {
            text_col: pa.array(texts, pa.binary()).cast(pa.string()),
            "tree": packed,
            "n_tokens": after,
            "tokens_before": before,
            "n_edits": n_edits,
            "encoded_bytes": encoded,
        }

    fields = [
        (text_col, "string"),
        ("tree", "binary"),
        ("n_tokens", "long"),
        ("tokens_before", "long"),
        ("n_edits", "long"),
        ("encoded_bytes", "long"),
    ]
    return map_rows(trees, keep, fields, make)


def masking(masks: list[tuple[re.Pattern, bytes]]) -> Callable[[bytes], list[Edit]]:
    """Edits for all matches of the masks; of matches that overlap the first counts, then the first mask's."""

    def find(text: bytes) -> list[Edit]:
        matches = sorted(
            (m.start(), rank, m.end(), new) for rank, (mask, new) in enumerate(masks) for m in mask.finditer(text)
        )
        edits, done = [], 0
        for start, _, end, new in matches:
            if start >= done:
                edits.append((start, end - start, new))
                done = end
        return edits

    return find


def masked_counts(docs: DataFrame) -> DataFrame:
    """Token counts of all documents before and after masking personal data, numbers and runs of symbols."""
    done = recount(count_tokens(docs.select("doc_id", "text")), ["doc_id"], masking(MASKS))
    return done.select(
        "doc_id",
        "n_edits",
        "tokens_before",
        F.col("n_tokens").alias("tokens_after"),
        "encoded_bytes",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes_after"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )
