"""Exact scores from residues, and the mined rows against brute force."""

import random

import brute_new
import numpy as np
import pytest
from pyspark.sql import functions as F

from airseries.llm import common, hard_negatives

SF = "/root/testdata/sf0.001"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    common.reach_workers(spark)


def mined(df, **how):
    return sorted(tuple(r[c] for c in COLUMNS) for r in hard_negatives.hard_negatives(df, **how).collect())


@pytest.mark.parametrize("largest", [3, 300, 40_000, 2**30])
@pytest.mark.parametrize("dims", [1, 64, 150])
def test_products_are_exact(largest, dims):
    rng = random.Random(largest + dims)
    limit = int(min(largest, (9.1e18 / dims) ** 0.5))
    left = [[rng.randint(-limit, limit) for _ in range(dims)] for _ in range(7)] + [[limit] * dims, [-limit] * dims]
    bound = dims * limit * limit
    moduli = hard_negatives.moduli_for(bound)
    cut = hard_negatives.residues(np.array(left, float), moduli)
    assert max(np.abs(c).max() for c in cut) <= 511
    want = [[sum(x * y for x, y in zip(a, b, strict=True)) for b in left] for a in left]
    assert hard_negatives.product(cut, cut, moduli).tolist() == want


def test_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = sorted(brute_new.hard_negatives([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]))
    assert want
    assert mined(df) == want


def odd_rows():
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, 0.25, 0.5, 1.0, 2.0]) for _ in range(3)], rng.randrange(3)) for i in range(160)]
    rows += [(50, [0.5, 1.0, 2.0], 1), (50, [0.5, 1.0, 2.0], 1), (50, [2.0, 1.0, 0.5], 1)]  # repeated and hot ids
    rows += [(100, rows[100][1], rows[100][2])] * 3
    rows += [(None, [1.0, 1.0, 1.0], 1), (200, None, 1), (250, [1.0, 1.0, 1.0], None), (300, [1.0, None, 1.0], 1)]
    rows += [(350, [float("nan"), 1.0, 1.0], 1), (400, [float("inf"), 0.0, 0.0], 1), (450, [], 1), (500, [3.0], 1)]
    rows += [(550, [1e300, 0.0, 0.0], 1), (600, [1e7, 1e6, 0.0], 1), (601, [1e7, -1e6, 0.0], 2), (602, [9e6, 0.0, 0.0], 2)]
    rows += [(-50, [1.0, 1.0, 2.0], 9), (701, [0.0, 0.0, 0.0], 2), (702, [2.0, 2.0, 2.0, 2.0], 2), (800, [1.0], 2**31 - 1)]
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("id", "vector", "is_anchor", "norm", "row_block", "anchor", "near", "self", "score", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    assert mined(df.repartition(5)) == sorted(brute_new.hard_negatives(rows))


def test_blocks_change_nothing(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    cut = hard_negatives.mine(df, label=label, block_rows=20, block_anchors=3)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in cut.collect()) == sorted(brute_new.hard_negatives(rows))


def test_one_label_for_all(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], 4) for i in range(60)], "vec_id long, embedding array<float>, label int")
    got = mined(df)
    assert got == sorted(brute_new.hard_negatives([tuple(r) for r in df.collect()]))


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(df).columns == COLUMNS
    assert mined(df) == []
