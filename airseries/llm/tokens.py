"""Byte-level BPE ids for batches of texts, equal to those of the ``tokenizers`` library."""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa

VOCABULARY = "byte_bpe_50k"

#: Texts with these take the plain path: white space beyond ASCII, separators that
#: regex engines judge differently, and strings that name a special token.
ODD = re.compile(
    rb"<\||[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


def vocabulary_path(name: str) -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def fast_encoder(name: str = VOCABULARY):
    """The vocabulary as ranks, and the number of bytes of every id."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        sizes[rank] = len(piece)
    encoder = tiktoken.Encoding(
        name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return encoder, sizes


@functools.cache
def plain_encoder(name: str = VOCABULARY):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(f"{name}.json"))


def encode_plain(text: str, name: str = VOCABULARY) -> list[int]:
    return plain_encoder(name).encode(text, add_special_tokens=False).ids


def encode_texts(texts: list[bytes], name: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another (uint32) and where each text's ids begin and end.

    A pre-token never crosses the start of a run of white space, so texts are cut
    before every space that follows a non-space. Each distinct piece is encoded
    once per call, and its ids are copied to all its places.
    """
    if not texts:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    odd = [i for i, t in enumerate(texts) if ODD.search(t)]
    if odd:
        apart = {i: np.array(encode_plain(texts[i].decode(), name), np.uint32) for i in odd}
        usual = [i for i in range(len(texts)) if i not in apart]
        ids, ends = encode_texts([texts[i] for i in usual], name)
        parts: list[np.ndarray] = [None] * len(texts)
        for k, i in enumerate(usual):
            parts[i] = ids[ends[k] : ends[k + 1]]
        for i, own in apart.items():
            parts[i] = own
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate([[0], np.cumsum(sizes)])
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == 32) & ~space[:-1]
    cut[first[:-1][sizes > 0]] = True
    starts = np.flatnonzero(cut)
    offsets = np.append(starts, len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
    ).dictionary_encode()
    flat, bounds = encode_pieces(pieces.dictionary, name)
    which = pieces.indices.to_numpy()
    counts = np.diff(bounds)[which]
    before = np.concatenate([[0], np.cumsum(counts)])
    ids = flat[np.repeat(bounds[which] - before[:-1], counts) + np.arange(before[-1])]
    ends = before[np.searchsorted(starts, first)]
    return ids, ends


def encode_pieces(pieces: pa.Array, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct pieces: those cut off from both neighbours by a space in one call, others singly."""
    encoder, sizes = fast_encoder(name)
    values = pieces.to_pylist()
    together = [v[0] == 32 and (32 < v[-1] < 127 or v[-1] > 127 and not ODD.search(v)) for v in values]
    text = b"".join([v for v, t in zip(values, together, strict=True) if t])
    shared = np.array(encoder.encode_ordinary(text.decode()), np.uint32)
    token_ends = np.cumsum(sizes[shared])
    piece_ends = np.cumsum([len(v) for v, t in zip(values, together, strict=True) if t], dtype=np.int64)
    upto = np.searchsorted(token_ends, piece_ends, side="right") if len(piece_ends) else np.zeros(0, np.int64)
    counts = np.zeros(len(values), np.int64)
    mask = np.array(together, bool)
    counts[mask] = np.diff(upto, prepend=0)
    single = {i: encoder.encode_ordinary(values[i].decode()) for i in np.flatnonzero(~mask)}
    for i, own in single.items():
        counts[i] = len(own)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    flat = np.empty(bounds[-1], np.uint32)
    flat[np.repeat(mask, counts)] = shared
    for i, own in single.items():
        flat[bounds[i] : bounds[i + 1]] = own
    return flat, bounds
