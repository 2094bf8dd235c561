"""Near copies of the pipeline against all pairs by exact Jaccard."""

import random

import numpy as np

import corpus_pipeline
from airseries.llm import near_copies, simhash


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def planted(count, seed=7):
    """Texts of 200 words and copies with one to four words changed: Jaccard 0.8 to 0.95."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        copy = list(base)
        for i in rng.sample(range(200), rng.randrange(1, 5)):
            copy[i] = f"x{rng.randrange(10**9)}"
        out.append((" ".join(base), " ".join(copy)))
    return [p for p in out if jaccard(*p) >= 0.8]


def kept_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, "").collect()), key=repr)


def test_planted_copies_go(spark):
    pairs = planted(150)
    assert min(jaccard(*p) for p in pairs) < 0.83
    rows = [(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)]
    assert kept_rows(spark, rows) == sorted([r for r in rows if r[0] % 2 == 0], key=repr)


def test_pairs_below_the_limit_stay_and_hot_buckets_are_whole(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(120):
        text = list(base)
        for i in rng.sample(range(150), rng.choice([1, 3, 6, 12])):
            text[i] = f"x{rng.randrange(10**9)}"
        rows.append((d, " ".join(text)))
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(rows[i][1], rows[j][1]) >= 0.8:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if x == old else x for x in root]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(set(root))
    assert 1 < len(want) < 120
    for block in (2048, 16):
        assert sorted(r.doc for r in near_copies.near_copies(docs, block=block).collect()) == want


def test_one_id_and_null_ids_with_other_texts(spark):
    texts = [" ".join(f"t{k}_{i}" for i in range(40)) for k in range(5)]
    near = texts[0] + " more"
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (9, near), (10, None), (11, " ")]
    want = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (10, None)]
    assert kept_rows(spark, rows) == sorted(want, key=repr)


def test_share_of_pairs_that_meet():
    pairs = planted(2000, 1)
    keys = [[near_copies.band_keys(near_copies.min_hashes(near_copies.shingles(t.encode().split()))) for t in p] for p in pairs]
    assert sum(bool(np.any(a == b)) for a, b in keys) >= len(pairs) - 3


def test_simhash_finds_copies_by_itself(spark, monkeypatch):
    """Without MinHash bands: all copies within 4 bits go, and no others but those that share a mask's bits."""
    pairs = planted(300, 11)
    rows = [(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)]
    prints = [[simhash.fingerprint(t.encode(), 5) for t in p] for p in pairs]
    near = {2 * i + 1 for i, (a, b) in enumerate(prints) if (a ^ b).bit_count() <= 4}
    met = {2 * i + 1 for i, (a, b) in enumerate(prints) if any(a & m == b & m for m in simhash.covering_masks(4))}
    assert near <= met and len(near) > 20 and len(met) < len(pairs)
    monkeypatch.setattr(near_copies, "band_keys", lambda least: np.zeros(0, np.int64))
    assert sorted(d for d, _ in kept_rows(spark, rows)) == [d for d, _ in rows if d not in met]


def components(rows):
    """Smallest id of each component by exact Jaccard over all pairs."""
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(rows[i][1], rows[j][1]) >= 0.8:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if x == old else x for x in root]
    return sorted({rows[r][0] for r in root})


def test_templates_confirm_few_pairs(spark, monkeypatch):
    """400 texts of one template, most pairs near 0.66: components are exact, pairs sent to a check few."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for d in range(400):
        text = list(base)
        for i in rng.sample(range(100), 4 if d % 20 else 1):
            text[i] = f"x{rng.randrange(10**9)}"
        rows.append((d, " ".join(text)))
    sent = []
    confirmed = near_copies.confirmed
    monkeypatch.setattr(near_copies, "confirmed", lambda pairs, *rest: sent.append(pairs.count()) or confirmed(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = components(rows)
    assert 1 < len(want) < 400
    for block in (2048, 64):
        sent.clear()
        assert sorted(r.doc for r in near_copies.near_copies(docs, block=block).collect()) == want
        assert sum(sent) < 10 * len(rows), sent


def test_overlaps_equal_set_sizes():
    rng = np.random.default_rng(2)
    for left, right, top in ((1, 1, 5), (30, 50, 60), (40, 7, 100_000), (3, 200, 900)):
        a, b = ([np.unique(rng.integers(0, top, rng.integers(0, 80)).astype(np.uint64)) for _ in range(n)] for n in (left, right))
        a[0] = b[0]
        want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
        for step in (8, near_copies.STEP):
            near_copies.STEP, old = step, near_copies.STEP
            try:
                assert near_copies.overlaps(a, b).tolist() == want
            finally:
                near_copies.STEP = old


def test_empty_table_long_text_and_clashing_names(spark):
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    rows = [(3, long, "a"), (1, long + " end", "b"), (2, "other text", "c"), (2, "other text", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string")
    docs = docs.withColumn("__key", docs["__id"]).withColumn("node", docs["__id"])
    for table, ids in ((docs, [1, 2]), (docs.limit(0), [])):
        got = corpus_pipeline.near_dedup(spark, table, "")
        assert got.dtypes == docs.dtypes
        found = got.collect()
        assert sorted(r.doc_id for r in found) == ids
        assert all(r["__id"] == r["__key"] == r.node and r.node in "bcd" for r in found)
    # Rows equal in id and text: which one stays does not depend on their order.
    first = {r.node for r in corpus_pipeline.near_dedup(spark, docs.repartition(4), "").collect()}
    assert first == {r.node for r in corpus_pipeline.near_dedup(spark, docs.coalesce(1), "").collect()}
