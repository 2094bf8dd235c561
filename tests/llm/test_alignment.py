"""Groups and links of two tokenizers against plain Python."""

import brute_new
import pytest
from pyspark.sql import functions as F
from test_operators import ODD

from airseries.llm import alignment, common

SF = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    common.reach_workers(spark)


def want_of(docs):
    return brute_new.alignment(
        docs,
        lambda t: alignment.plain_a().encode(t, add_special_tokens=False).ids,
        lambda t: alignment.piece_encoder().encode(t),
        alignment.a_bytes(),
        alignment.b_bytes(),
    )


def checked(df):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = [(r.doc_id, *(r[c] for c in COLUMNS)) for r in alignment.aligned_links(df).collect()]
    want = [(d, *w) for (d, _), w in zip(docs, want_of(docs), strict=True)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


def test_table(spark):
    checked(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_rows(spark):
    more = [
        (30, " "),
        (31, "two  spaces "),
        (32, "   "),
        (33, "a▁b"),  # B writes a space for the mark: not spelled
        (34, "<s> </s> <unk> <0x41> <|endoftext|>"),
        (35, "𝔘𝔫𝔦 ① ﬁ é 　x"),
        (36, "\r\n\t tabs\n\n  lines \n"),
        (37, "nul\x00 \x7f ﻿"),
        (38, "x" * 5000),
    ]
    df = spark.createDataFrame([*ODD, *more], "doc_id long, text string").repartition(3)
    for name in ("id", "row", "pairs", "times", "n", "b", "sum", "best", "n_a", "regular"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r[0]: r for r in checked(df)}
    assert got[33] == (33, 0, 0, 0, 0, 0, 0, "")


def test_no_pair_is_hot_or_all_are(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for share in (1, 1 << 40):
        monkeypatch.setattr(alignment, "HOT_SHARE", share)
        checked(df)


def test_texts_are_split_over_parts(spark, monkeypatch):
    texts = [b" some words of a text", b" x", b" \xc3\xa9t\xc3\xa9 " * 50]
    ids, ends, right = alignment.encode_b(texts)
    plain = [alignment.piece_encoder().encode(t[1:].decode()) for t in texts]
    assert right.all()
    assert [ids[lo:hi].tolist() for lo, hi in zip(ends[:-1], ends[1:], strict=True)] == plain


def test_same_bytes(spark):
    a, b = alignment.a_bytes(), alignment.b_bytes()
    for i, j in enumerate(alignment.identity_map().tolist()):
        assert (a[i] in set(b)) == (j >= 0) if i < 300 else True
        assert j < 0 or a[i] == b[j]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned_links(df).collect() == []
