"""Quality rules: hashed n-gram likelihood ratio of trusted target to raw corpus, DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.llm.common import SPACE, SPACE_CLASS


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, although the body names it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) > 0, F.split(trimmed, SPACE_CLASS + "+")).otherwise(
        F.array().cast("array<string>")
    )


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def ngram_buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of all words and all pairs of neighbouring words, given the words' hashes."""
    return F.concat(
        F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")),
        F.when(
            F.size(hashes) > 1,
            F.zip_with(
                F.slice(hashes, 1, F.size(hashes) - 1),
                F.slice(hashes, 2, F.size(hashes)),
                lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"),
            ),
        ).otherwise(F.array().cast("array<int>")),
    )


def repeat_words(hashes: Column, window: int) -> Column:
    """Words inside windows that occur twice or more in the text, all occurrences included."""
    zero = F.lit(0).cast("long")

    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            marked = F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(
                        (x["h"] == F.get(s, k + 1)["h"]) | (x["h"] == F.try_element_at(s, F.when(k > 0, k))["h"]),
                        x["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return F.array_sort(marked)

        def union(p: Column) -> Column:
            gaps = F.transform(
                p, lambda x, k: F.when(k == 0, window).otherwise(F.least(F.lit(window), x - F.try_element_at(p, F.when(k > 0, k))))
            )
            return F.aggregate(gaps, zero, lambda a, g: a + g)

        return let(let(pairs, starts), union)

    def of(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(window)))
        )
        return let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), zero).otherwise(covered(w)),
        )

    return F.when(F.size(hashes) < window, zero).otherwise(let(hashes, of))


def bucket_counts(
    docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int
) -> DataFrame:
    """``raw`` and ``target`` n-gram counts by bucket, over all documents and over the trusted ones.

    Counts are summed in each task before the shuffle: at most ``buckets`` rows leave a task.
    """
    ids = trusted.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    marked = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        # Always by shuffle: trusted ids grow with the corpus, so they are not broadcast at any size.
        .join(ids.withColumn("target", F.lit(1)).hint("merge"), "id", "left")
        .select("target", hashes_of(words_of(F.col("text"))).alias("hashes"))
    )
    return (
        marked.select("target", F.explode(ngram_buckets(F.col("hashes"), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("target").alias("target"))
    )


def log_ratios(counts: DataFrame, buckets: int, smoothing: float = 1.0) -> list[float]:
    """log(target share / raw share) of every bucket, both smoothed; zeros without a target."""
    found = {r.bucket: (r.raw, r.target) for r in counts.collect()}
    if not any(t for _, t in found.values()):
        return [0.0] * buckets
    raw_all = sum(r for r, _ in found.values()) + smoothing * buckets
    target_all = sum(t for _, t in found.values()) + smoothing * buckets
    return [
        math.log((found.get(b, (0, 0))[1] + smoothing) / target_all)
        - math.log((found.get(b, (0, 0))[0] + smoothing) / raw_all)
        for b in range(buckets)
    ]


def judge_quality(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 1 << 14,
    threshold: float = -0.15,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    window: int = 8,
) -> DataFrame:
    """Counts of each text, its mean log-likelihood ratio per n-gram, and the verdict.

    Two multinomials over hashed words and word pairs are counted over the whole tables, one
    over the documents whose id is in ``trusted``, one over all. A document's ratio is
    the sum over its n-grams, divided by their number; it fails below ``threshold``. The
    table of ratios is ``buckets`` numbers whatever the input, so it goes into
    the plan as a constant. If no document is trusted, every ratio is zero and only the
    base rules judge.

    Returns ``id_col``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``llr`` and ``kept`` for every row; other columns
    are left out. Null and empty texts have no words and fail the base. Null ids
    are judged like others and are never trusted.
    """
    counts = bucket_counts(docs, trusted, id_col, text_col, buckets)
    ratios = log_ratios(counts, buckets)
    # Parsed once, when the plan's constants are folded.
    constant = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    prepared = docs.select(
        F.col(id_col),
        text.alias("text"),
        words_of(F.col(text_col)).alias("words"),
    ).select(
        id_col,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        hashes_of(F.col("words")).alias("hashes"),
    )
    total = F.aggregate(
        ngram_buckets(F.col("hashes"), buckets), F.lit(0.0), lambda a, b: a + F.get(constant, b)
    )
    measured = prepared.select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeat_words(F.col("hashes"), window).alias("n_repeat_words"),
        F.when(F.col("n_words") > 0, total / (2 * F.col("n_words") - 1)).otherwise(F.lit(0.0)).alias("llr"),
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= threshold)
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document against the target of those labelled good."""
    return judge_quality(docs.select("doc_id", "text"), labels.where("quality = 1"))
