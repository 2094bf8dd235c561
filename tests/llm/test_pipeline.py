"""Each stage of the pipeline against its plain version, on what the stage before kept."""

import brute
import pytest
from test_near_copies import components

import corpus_pipeline
from airseries.llm import common, quality_model, tokens
from airseries.session import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    common.reach_workers(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], SF), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_return_documents(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing",
    ]
    for df in results[1:-1]:
        assert df.dtypes == results[0].dtypes
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_quality_stage(spark, results):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    machine = quality_model.train(results[0], labels.where(~quality_model.held_out()))
    scored = quality_model.score(results[0], machine, ["doc_id"]).collect()
    assert texts(results[1]).keys() == {r.doc_id for r in scored if r.score >= 0.3}
    bad = {r.doc_id for r in labels.collect() if r.quality == 0 and brute.crc(r.doc_id) % 5}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    assert not bad & texts(results[1]).keys()
    assert len(good & texts(results[1]).keys()) >= 0.97 * len(good)


def test_line_stage(results):
    before, after = texts(results[1]), texts(results[2])
    want = {d: s for d, _, _, s in brute.lines(list(before.items()))}
    assert {d: brute.sha(t) for d, t in after.items()} == want


def test_near_duplicate_stage(results):
    before, after = texts(results[2]), texts(results[3])
    assert sorted(after.items()) == [(d, before[d]) for d in components(list(before.items()))]


def test_decontamination_stage(spark, results):
    before, after = texts(results[3]), texts(results[4])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {d: (n, hit) for d, n, hit, *_ in brute.contamination(list(before.items()), items)}
    assert any(hit for _, hit in found.values())
    assert after.keys() == {d for d, (n, hit) in found.items() if hit <= 0.5 * n}
    assert all(after[d] == before[d] for d in after if not found[d][1])
    for _, n, hit, *_ in brute.contamination([(d, after[d]) for d in after if found[d][1]], items):
        assert hit == 0
    for d in after:
        assert len(brute.contamination([(d, after[d])], [])[0]) == 6


def test_packing_stage(results):
    after, rows = texts(results[4]), results[5].collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.start):
        by_doc.setdefault(r.doc_id, []).extend(r.ids)
    assert {d: [*tokens.encode_plain(t), 0] for d, t in after.items()} == by_doc


def test_run_gives_the_last_stage(spark, results):
    got = corpus_pipeline.run(spark, SF)
    pick = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, got.select(*pick).collect())) == sorted(map(tuple, results[5].select(*pick).collect()))


def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing names: every stage takes them and keeps the columns."""
    long = " ".join(f"w{i * i % 9973}" for i in range(40_000))
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    shared = "a line that two documents have"
    rows = [
        (1, None), (2, ""), (3, " \n "), (4, "one"), (5, long), (5, long), (None, "nothing of an id here"), (None, None),
        (6, shared + "\nmore of six"), (7, shared + "\nand seven"), (8, f"{long[:2000]} {leak} {long[2000:4000]}"),
    ]
    made = ["n_lines", "covered", "n_words", "clean_text", "__score", "__id", "__row", "__text", "own_n_lines"]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "cast(length(text) as long) as n_chars", *[f"'{c}' as `{c}`" for c in made])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for table in (docs, docs.limit(0)):
        for name, apply in corpus_pipeline.STAGES:
            got = stage(apply(spark, table, str(tmp_path)), "odd")
            found = got.collect()
            assert bool(found) == bool(table.take(1)), name
            if name == "packing":
                continue
            assert got.dtypes == docs.dtypes, name
            assert all(r[c] == c for r in found for c in made), name
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found), name
            if name == "line_dedup" and found:
                want = [(d, "and seven" if d == 7 else t) for d, t in rows]
                assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(want, key=repr)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
