"""The registered scores use contexts of six bytes."""

import brute
import pytest

from airseries.llm import queries


def test_query_mixes_contexts_of_six_bytes(spark, tmp_path):
    docs = [(d, f"abcdef{d % 3} xbcdef{d % 4} qbcdefg zbcdefh") for d in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    learned = [t for d, t in docs if brute.crc(d) % 10]
    six, five = brute.ContextTree(learned, 6), brute.ContextTree(learned, 5)
    got = {r.doc_id: r.score for r in queries.queries()["op1_lm_scoring"](spark, str(tmp_path)).collect()}
    for d, t in docs:
        assert got[d] == pytest.approx(six.log10(t), rel=1e-5)
    assert any(abs(six.log10(t) - five.log10(t)) > 1e-3 for _, t in docs)
