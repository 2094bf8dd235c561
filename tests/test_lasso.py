"""The Lasso path against Spark ML's own fits, and the grid built on it."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from airseries.operators import encode, lasso, one_vs_rest
from airseries.operators.clean import dedup

NAMES = ["a", "b", "c", "same", "far"]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(21)
    rows = []
    for i in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(2, 3)
        c = 0.7 * a + rng.gauss(0, 0.3)
        label = 0.0 if a + 0.2 * b > 0.8 else 1.0 if b > 1 else 2.0
        rows.append((i, a, b, c, 7.0, 1e5 + a * 3 + rng.gauss(0, 1), label))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, same double, far double, label double")
    return encode.assemble(df, NAMES).select("id", "features", "label").repartition(4).cache()


@pytest.mark.parametrize("strength", [1e-4, 1e-2, 0.1, 0.3, 5.0])
def test_path_is_that_of_spark_ml(points, strength):
    path = lasso.ovr_path(points, ["x", "y", "z"], [0.3, 1e-4, strength, 0.05])[2]
    for i, line in enumerate(path.values()):
        target = points.withColumn("y", (F.col("label") == float(i)).cast("double"))
        fit = LinearRegression(labelCol="y", elasticNetParam=1.0, regParam=strength, maxIter=2000, tol=1e-12).fit(target)
        scale = np.array([1, 3, 1, 1, 3])
        assert line.coefficients * scale == pytest.approx(fit.coefficients.toArray() * scale, abs=1e-4)
        for row in points.limit(5).collect():
            want = float(fit.predict(row.features))
            assert float(line.coefficients @ row.features.toArray() + line.intercept) == pytest.approx(want, abs=1e-4)


def test_optimum(points):
    """At the optimum every weight pulls at the limit, or less where it is zero."""
    found = lasso.moments(points, [(F.col("label") == 1.0).cast("double")])
    keep = [0, 1, 2, 4]
    square, wanted = found.correlations[np.ix_(keep, keep)], found.correlations[keep, 5]
    for limit in (0.01, 0.2, 2.0):
        w = lasso.descend(square, wanted, limit, np.zeros(4))
        pull = wanted - square @ w
        assert np.all(np.abs(pull) <= limit + 1e-7)
        assert pull[w != 0] == pytest.approx(limit * np.sign(w[w != 0]), abs=1e-7)


def test_a_feature_far_from_zero(points):
    """Moved by 1e8, where squares have no digits left for the deviations, nothing changes."""
    moved = encode.assemble(
        points.withColumn("x", vector_to_array("features")).select(
            "label", *[(F.col("x")[i] + (1e8 if name == "far" else 0)).alias(name) for i, name in enumerate(NAMES)]
        ),
        NAMES,
    )
    for near, far in zip(*[lasso.ovr_path(df, ["x", "y"], [1e-3])[0].values() for df in (points, moved)], strict=True):
        assert near.coefficients == pytest.approx(far.coefficients, abs=1e-6)


def test_scores_in_one_expression(points):
    path = lasso.ovr_path(points, ["x", "y", "z"], [0.01])[0]
    x = vector_to_array(F.col("features"))
    for r in points.select("features", lasso.best_class(path, x).alias("guess")).limit(20).collect():
        scores = [line.coefficients @ r.features.toArray() + line.intercept for line in path.values()]
        assert r.guess == float(np.argmax(scores))


def test_chosen_strength_is_in_the_table(spark, points):
    found = one_vs_rest.grid_search(points, ["x", "y", "z"], [1e3, 1e-3, 1e-2])
    rows = found.table(spark).orderBy("place").collect()
    assert [r.reg for r in rows] == [1e3, 1e-3, 1e-2]
    assert [r.reg for r in rows if r.chosen] == [found.reg]
    assert found.f1 == max(r.f1 for r in rows) and found.reg != 1e3
    assert set(found.lines) == {"x", "y", "z"}


def test_a_class_that_never_occurs(points):
    path = lasso.ovr_path(points, ["x", "y", "z", "none"], [0.01])[0]
    assert not path["none"].coefficients.any() and path["none"].intercept == 0.0


def test_too_few_rows(points):
    with pytest.raises(ValueError):
        lasso.moments(points.limit(0), [F.lit(1.0)])


def test_dedup_ties_are_the_same_on_any_layout(spark):
    rows = [(k, v, s, float(x)) for k in range(5) for v, s, x in ((1, "b", 2), (1, "a", 9), (1, "a", 3), (2, "a", 0), (None, "", 0))]
    rows += [(9, None, "z", 1.0), (9, None, "y", 1.0)]
    want = sorted([(k, 1, "a", 3.0) for k in range(5)] + [(9, None, "y", 1.0)])
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k long, v long, s string, x double").repartition(4)
        assert sorted(tuple(r) for r in dedup(df, ["k"], "v").collect()) == want
