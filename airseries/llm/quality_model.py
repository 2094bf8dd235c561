"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

import dataclasses
import operator
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.llm.common import as_bytes, free_names, map_rows, text_key

#: Upper ends of the bins a share or mean falls into.
SHARES = np.array([0, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])
BINS = 32
STATISTICS = 12
SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]=_^~@\\/", np.uint8)
MARKS = np.frombuffer(b".,;:!?", np.uint8)


@dataclasses.dataclass(frozen=True)
class Machine:
    """bias + sum of w x + half of (sum of v x)^2 - sum of (v x)^2 over the factors."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    word_buckets: int

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Probability of label 1 for each row of features and values; every row has a feature."""
        sizes = [len(f) for f, _ in rows]
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        features = np.concatenate([f for f, _ in rows])
        values = np.concatenate([v for _, v in rows]).astype(np.float64)
        taken = self.factors[features] * values[:, None]
        pairs = 0.5 * (np.add.reduceat(taken, begins) ** 2 - np.add.reduceat(taken**2, begins)).sum(axis=1)
        margin = self.bias + np.add.reduceat(self.weights[features] * values, begins) + pairs
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def features_of(text: bytes | None, metadata: list[float | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text.

    Each distinct word (A-Z in lower case) is a feature by hash, all together of length one.
    Each statistic, and each metadata number by its logarithm, is one feature for
    its bin. Missing metadata has no feature.
    """
    text = text or b""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.lower().split()
    distinct = set(words)
    lines = text.split(b"\n")
    n_words, n_lines, size = max(1, len(words)), len(lines), max(1, len(text))
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    shares = [
        counts[SYMBOLS].sum() / size,
        counts[33] / size,
        counts[65:91].sum() / max(1, letters),
        counts[48:58].sum() / size,
        counts[MARKS].sum() / n_words,
        len(distinct) / n_words,
        sum(map(operator.eq, words, islice(words, 1, None))) / n_words,
        1 - len(set(lines)) / n_lines,
        min(1.0, n_lines / n_words),
        counts[124] / n_words,
    ]
    places = np.searchsorted(SHARES, shares)
    logs = [len(words).bit_length(), (len(text) // n_words).bit_length()]
    own = [*(k * BINS + int(b) for k, b in enumerate(places)), *((len(shares) + k) * BINS + b for k, b in enumerate(logs))]
    for k, number in enumerate(metadata):
        if number is not None:
            own.append((STATISTICS + k) * BINS + min(BINS - 1, max(0, int(number)).bit_length()))
    hashed = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) % buckets
    features = np.concatenate([hashed, buckets + np.array(own, np.int64)])
    values = np.ones(len(features), np.float32)
    values[: len(hashed)] = 1 / np.sqrt(max(1, len(hashed)))
    return features, values


def fit(
    examples: list[tuple[int, np.ndarray, np.ndarray]],
    buckets: int,
    metadata: int,
    rank: int = 8,
    seen: int = 60_000,
    batch: int = 128,
    rate: float = 0.1,
    decay: float = 1e-5,
    seed: int = 7,
) -> Machine:
    """AdaGrad on the logistic loss; the order of the examples and the seed fix the result.

    Few examples are gone through more often, until about ``seen`` were looked at. Without
    examples all weights are zero, so that every score is one half.
    """
    size = buckets + (STATISTICS + metadata) * BINS
    random = np.random.default_rng(seed)
    weights = np.zeros(size, np.float32)
    factors = random.normal(0, 0.05 if examples else 0, (size, rank)).astype(np.float32)
    ones = sum(label for label, _, _ in examples)
    bias = float(np.log((ones + 1) / (len(examples) - ones + 1)))
    seen_w, seen_v, seen_b = np.full(size, 1e-6, np.float32), np.full((size, rank), 1e-6, np.float32), 1e-6
    rounds = min(40, max(6, seen // len(examples))) if examples else 0
    for _ in range(rounds):
        order = random.permutation(len(examples))
        for at in range(0, len(order), batch):
            chosen = [examples[i] for i in order[at : at + batch]]
            sizes = [len(f) for _, f, _ in chosen]
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            features = np.concatenate([f for _, f, _ in chosen])
            values = np.concatenate([v for _, _, v in chosen])
            labels = np.array([y for y, _, _ in chosen], np.float32)
            taken = factors[features] * values[:, None]
            sums = np.add.reduceat(taken, begins)
            pairs = 0.5 * (sums**2 - np.add.reduceat(taken**2, begins)).sum(axis=1)
            margin = bias + np.add.reduceat(weights[features] * values, begins) + pairs
            error = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels
            slope = np.repeat(error, sizes) * values
            touched, where = np.unique(features, return_inverse=True)
            step_w = np.bincount(where, slope, len(touched)) / len(chosen) + decay * weights[touched]
            inner = slope[:, None] * (np.repeat(sums, sizes, axis=0) - taken)
            step_v = np.column_stack([np.bincount(where, inner[:, k], len(touched)) for k in range(rank)])
            step_v = step_v / len(chosen) + decay * factors[touched]
            seen_w[touched] += step_w**2
            seen_v[touched] += step_v**2
            weights[touched] -= rate * step_w / np.sqrt(seen_w[touched])
            factors[touched] -= 0.3 * rate * step_v / np.sqrt(seen_v[touched])
            step_b = float(error.mean())
            seen_b += step_b**2
            bias -= rate * step_b / np.sqrt(seen_b)
    return Machine(bias, weights, factors, buckets)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    metadata: tuple[str, ...] = ("n_chars",),
    max_examples: int = 12_000,
    buckets: int = 1 << 16,
) -> Machine:
    """Fit the machine on at most ``max_examples`` labelled rows, taken by hash of the id.

    That bound is the only sample: it limits what reaches the driver, however many documents have
    a labelled id. Rows with a null label or id teach nothing; a document with both labels is one
    example of each, documents equal in id, text and metadata are one example. Without
    any example all scores are one half.
    """
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(max_examples)
    )
    numbers = [f"number_{k}" for k in range(len(metadata))]
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *_numbers(docs, metadata))
    key = F.xxhash64(text_key("text"), *numbers).alias("key")
    # Ids first, then rows: one id may be that of any number of documents.
    rows_of = source.join(F.broadcast(chosen), "id").select("id", "label", key).distinct()
    picked = rows_of.orderBy(F.xxhash64("id"), "id", "label", "key").limit(max_examples)
    picked = picked.withColumnsRenamed({"id": "picked_id", "key": "picked_key"})
    same = (F.col("id") == F.col("picked_id")) & (key == F.col("picked_key"))
    texts = source.join(F.broadcast(picked), same).select("id", "text", *numbers, "label", "picked_key")

    def make(batch: pa.RecordBatch) -> dict:
        rows = list(_feature_rows(batch, 1, 2, len(metadata), buckets))
        return {"f": [f.astype(np.int32).tobytes() for f, _ in rows], "v": [v.tobytes() for _, v in rows]}

    found = map_rows(texts, ["id", "label", "picked_key"], [("f", "binary"), ("v", "binary")], make)
    found = found.dropDuplicates(["id", "label", "picked_key"])
    rows = sorted(found.collect(), key=lambda r: (zlib.crc32(str(r.id).encode()), r.id, r.label, bytes(r.f)))
    examples = [(r.label, np.frombuffer(r.f, np.int32).astype(np.int64), np.frombuffer(r.v, np.float32)) for r in rows]
    return fit(examples, buckets, len(metadata))


def _numbers(docs: DataFrame, metadata: tuple[str, ...]):
    return [F.col(m).cast("double").alias(f"number_{k}") for k, m in enumerate(metadata)]


def _feature_rows(batch: pa.RecordBatch, text_at: int, numbers_at: int, n_numbers: int, buckets: int):
    texts = as_bytes(batch.column(text_at)).to_pylist()
    numbers = [
        [None if x is None or x != x else min(x, 2.0**40) for x in batch.column(numbers_at + k).to_pylist()]
        for k in range(n_numbers)
    ]
    for i, text in enumerate(texts):
        yield features_of(text, [column[i] for column in numbers], buckets)


def score(
    docs: DataFrame,
    machine: Machine,
    keep: list[str],
    text_col: str = "text",
    metadata: tuple[str, ...] = ("n_chars",),
    score_col: str = "score",
) -> DataFrame:
    """The columns in ``keep`` and ``score_col``, the probability of label 1, for every row.

    The machine is broadcast; its size is fixed by its buckets and rank. Null and empty texts
    have the features of an empty text; null metadata is left out of the sum.
    Nothing is shuffled; a kept column of the score's name is replaced, others may have any name.
    An empty table gives an empty table.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def make(batch: pa.RecordBatch) -> dict:
        own = model.value
        rows = _feature_rows(batch, len(keep), len(keep) + 1, len(metadata), own.word_buckets)
        scores = []
        while part := list(islice(rows, 256)):
            scores.append(own.score(part))
        return {score_col: pa.array(np.concatenate(scores))}

    text, *numbers = free_names(docs, "__text", *[f"__{k}" for k in range(len(metadata))])
    source = docs.select(
        *keep,
        F.col(text_col).alias(text),
        *[c.alias(n) for n, c in zip(numbers, _numbers(docs, metadata), strict=True)],
    )
    return map_rows(source, keep, [(score_col, "double")], make)


def held_out(id_col: str = "doc_id", of: int = 5):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % of == 0


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a machine that never saw the labels of the held-out fifth."""
    machine = train(docs, labels.where(~held_out()))
    scored = score(docs, machine, ["doc_id"])
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
