"""From raw documents to packed training sequences, in five stages of the training-data operators.

All stages take any documents: a null text stays null where the stage keeps its row, empty and very long
texts are judged whole, repeated rows are judged alike, a null id counts as the smallest, an
empty table gives an empty table, and columns of any name come back as they were.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.llm import decontaminate, line_dedup, near_copies, packing, quality_model
from airseries.llm.common import free_names, id_of, reach_workers, table, text_key
from airseries.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _new_text(docs: DataFrame, change: Callable[[DataFrame], DataFrame], text: str, made: list[str]) -> DataFrame:
    """``docs`` with the column ``text`` of their change as text, ``n_chars`` (where there is one) following it.

    Columns of the documents that are named like one the change makes are put aside meanwhile.
    """
    clashing = [c for c in docs.columns if c.lower() in made]
    aside = dict(zip(clashing, free_names(docs, *[f"own_{c}" for c in clashing]), strict=True))
    changed = change(docs.withColumnsRenamed(aside))
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return changed.select(*[new[c].alias(c) if c in new else F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects (score under 0.3) go.

    A null text has the score of an empty one. Without labelled documents all scores are one half, so all stay.
    """
    reach_workers(spark)
    labels = table(spark, sf_dir, "labels").where(~quality_model.held_out())
    machine = quality_model.train(docs, labels)
    (score,) = free_names(docs, "__score")
    scored = quality_model.score(docs, machine, docs.columns, score_col=score)
    return scored.where(F.col(score) >= 0.3).drop(score)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id has too are cut; the document stays, if with an empty text."""
    return _new_text(docs, line_dedup.dedup_lines, "text", ["n_lines", "n_dropped", "lines_changed"])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies (five words, Jaccard 0.8 or more) stays, that with the smallest id.

    Candidates come from SimHash fingerprints under covering masks and from MinHash bands: at this similarity most
    fingerprints of 64 bits are too far apart to meet by themselves. Every link is confirmed by the exact similarity. Of
    equal ids the smaller text hash decides; of rows equal in id and text that
    with the smallest hash of the other columns (all but maps) stays.
    """
    reach_workers(spark)
    own_id, own_key, row = free_names(docs, "__id", "__key", "__row")
    keepers = near_copies.near_copies(docs).select(F.col("doc").alias(own_id), F.col("key").alias(own_key))
    keyed = docs.withColumn(own_id, id_of("doc_id")).withColumn(own_key, text_key("text"))
    kept = keyed.join(keepers, [own_id, own_key], "left_semi")
    hashed = [F.col(f.name) for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*hashed)).alias(row)
    return kept.groupBy(own_id, own_key).agg(one).select(*[F.col(f"{row}.{c}") for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut; documents that are mostly test items go. Texts without words stay."""
    reach_workers(spark)
    items = table(spark, sf_dir, "benchmark")

    def change(named: DataFrame) -> DataFrame:
        return decontaminate.decontaminate(named, items).where("not covered")

    return _new_text(docs, change, "clean_text", [name for name, _ in decontaminate.FOUND])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, packed into sequences of 1024 tokens; a text without ids is its end id."""
    reach_workers(spark)
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack_sequences),
]

#: A trained machine, fingerprints and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
