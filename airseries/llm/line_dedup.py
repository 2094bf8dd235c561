"""Line deduplication over all documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.llm.common import SPACE, free_names, id_of, lower_ascii, text_key


def line_key(line: Column) -> Column:
    """A line without white space at both ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """Keep a repeated line only in the document with the smallest id.

    Lines are exploded, normalised and hashed; the documents of each hash are
    counted by aggregate (partial sums first, so a line that a third of all
    documents share meets in one row per task); lines of hashes in at least
    ``min_docs`` documents are dropped by position and the rest is reassembled.

    All columns come back, ``text_col`` replaced by the kept lines, and three more
    (replacing columns of the same name): ``n_lines``, ``n_dropped`` and
    ``lines_changed``. A null or empty text is one empty line; it is never
    dropped, and a null text stays null. A null id counts as the smallest id. Rows
    with the same id are one document: its own repeated lines all stay. Equal
    rows get equal results. An empty table gives an empty table. Other columns may have any name.
    """
    out = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "lines_changed")]
    own_doc, own_row, own_drops, own_lines = free_names(docs, "__doc", "__row", "__drops", "__lines")
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    found = (
        docs.select(id_of(id_col).alias("doc"), text_key(text_col).alias("row"), lines.alias("all"))
        .select("doc", "row", F.posexplode("all").alias("pos", "line"))
        .select("doc", "row", "pos", line_key(F.col("line")).alias("norm"))
        .where(F.length("norm") >= min_chars)
        .select("doc", "row", "pos", F.unhex(F.md5(F.col("norm"))).alias("key"))
    )
    if min_docs == 2:
        counted = found.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        repeated = counted.where(F.col("first") < F.col("last"))
    else:
        counted = (
            found.select("key", "doc")
            .distinct()
            .groupBy("key")
            .agg(F.min("doc").alias("first"), F.count("*").alias("n"))
        )
        repeated = counted.where(F.col("n") >= min_docs)
    dropped = (
        found.join(repeated.select("key", "first"), "key")
        .where(F.col("doc") != F.col("first"))
        .groupBy("doc", "row")
        .agg(F.collect_set("pos").alias("drops"))
        .select(F.col("doc").alias(own_doc), F.col("row").alias(own_row), F.col("drops").alias(own_drops))
    )
    joined = (
        docs.select(*out, id_of(id_col).alias(own_doc), text_key(text_col).alias(own_row))
        .join(dropped, [own_doc, own_row], "left")
        .withColumn(own_lines, lines)
    )
    # The difference of two position lists keeps the order and is linear in the lines.
    places = F.array_except(
        F.sequence(F.lit(0), F.size(own_lines) - 1), F.coalesce(F.col(own_drops), F.array().cast("array<int>"))
    )
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col(own_lines), i)), "\n")
    changed = F.col(own_drops).isNotNull()
    return joined.select(
        *[F.when(changed, kept).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in out],
        F.size(own_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(own_drops), F.lit(0)).cast("long").alias("n_dropped"),
        changed.alias("lines_changed"),
    )


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """Per document: lines before, lines dropped, and the digest of what stays."""
    done = dedup_lines(docs.select("doc_id", "text"))
    return done.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
