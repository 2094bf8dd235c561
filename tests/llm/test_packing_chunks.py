"""Packing over many small partitions and batches; passages of many equal rows."""

import collections

import numpy as np
import pytest

from airseries.llm import packing, substring_dedup
from airseries.llm.chunks import in_chunks


def filling(rows, capacity=1024):
    used = collections.defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(r.length for r in rows) / (capacity * len(used))


def test_small_partitions_fill_their_sequences(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "'a few words of no weight' AS text").repartition(200)
    rows = packing.pack(df).collect()
    assert sorted(r.doc_id for r in rows if r.start == 0) == list(range(1000))
    # All but the last sequence are full.
    assert len({r.sequence_id for r in rows}) == -(-sum(r.length for r in rows) // 1024)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_sequences_stay_open_from_batch_to_batch(spark, size):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        df = spark.range(300).selectExpr("id AS doc_id", "repeat('so many words ', cast(id * 37 % 400 as int)) AS text")
        rows = packing.pack(df.coalesce(1)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert len({r.sequence_id for r in rows}) == -(-sum(r.length for r in rows) // 1024)
    filling(rows)


def test_begun_sequences_are_filled_first():
    begun = packing.Begun()
    first = packing.balance(np.array([1000, 500]), 1024, begun=begun)
    assert begun.room.sum() == 548
    second = packing.balance(np.array([500]), 1024, begun=begun)
    assert {s for *_, s, _ in first} == {0, 1} and {s for *_, s, _ in second} <= {0, 1}
    assert begun.room.sum() == 48


def test_chunks_of_equal_rows_are_bounded(spark):
    text = "one phrase that is the same in all of these rows and is long enough for a window"
    df = spark.range(5000).selectExpr("cast(null AS long) AS doc_id", f"'{text}' AS text")
    sizes = in_chunks(df, 50_000, id=df.doc_id, text=df.text).selectExpr("chunk", "length(text) n").groupBy("chunk").sum("n")
    assert max(r[1] for r in sizes.collect()) <= 50_000
    got = substring_dedup.dedup_passages(df, chunk_bytes=50_000).collect()
    assert len(got) == 5000 and {(r.n_words, r.n_removed) for r in got} == {(len(text.split()), 0)}


def test_phrase_of_a_third_of_all_documents(spark):
    phrase = " ".join(f"common{i}" for i in range(20))
    df = spark.range(3000).selectExpr(
        "id AS doc_id",
        f"concat('own', id, ' start', id, if(id % 3 = 0, ' {phrase}', ''), ' end', id, ' last', id) AS text",
    ).repartition(7)
    got = {r.doc_id: r.n_removed for r in substring_dedup.dedup_passages(df, chunk_bytes=20_000).collect()}
    assert got == {i: 20 if i % 3 == 0 and i else 0 for i in range(3000)}
