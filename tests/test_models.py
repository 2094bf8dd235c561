"""Metrics, vectors, models, one-vs-rest and run records."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from airseries.operators import encode, metrics, models, one_vs_rest, runs
from airseries.operators.sampling import hash_split
from airseries.plans.roles import role_vectors
from airseries.plans.training import coarse_labels, train_and_score
from airseries.plans.training import one_vs_rest as search
from airseries.session import stage_path


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = [(float(rng.randrange(4)), float(rng.randrange(4)), rng.gauss(0, 1), rng.gauss(0, 1))
            for _ in range(500)]
    return spark.createDataFrame(rows, "label double, prediction double, y double, p double").cache()


def test_regression_metrics_equal_evaluator(scored):
    got = metrics.regression_metrics(scored, "y", "p").first()
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(scored)
        assert got[name] == pytest.approx(want)
    assert got.n == 500


def test_regression_metrics_pass_over_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (9.0, None), (3.0, 3.0)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert (row.n, row.mae, row.rmse, row.r2) == (2, 0.5, pytest.approx(0.5**0.5), 0.5)
    constant = metrics.regression_metrics(df.filter("p = 2"), "y", "p").first()
    assert constant.r2 is None


def test_compare_predictions_is_one_pass(scored):
    got = metrics.compare_predictions(scored, "y", {"a": "p", "same": "y"})
    rows = got.collect()
    assert [r.model for r in rows] == ["same", "a"] and rows[0].rmse == 0.0
    assert rows[1].r2 == pytest.approx(metrics.regression_metrics(scored, "y", "p").first().r2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1


def test_classification_metrics_equal_evaluator(scored):
    got = metrics.classification_metrics(scored, "label", "prediction").first()
    names = {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall"}
    for ours, theirs in names.items():
        want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored)
        assert got[ours] == pytest.approx(want)


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (2.0, 1.0)], "label double, prediction double")
    got = metrics.classification_metrics(df, "label", "prediction").first()
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert got.f1 == pytest.approx(want) and got.accuracy == pytest.approx(1 / 3)


def test_confusion_equals_brute_force(spark, scored):
    want = np.zeros((5, 5), dtype=int)
    for r in scored.collect():
        want[int(r.label), int(r.prediction)] += 1
    classes = [0.0, 1.0, 2.0, 3.0, 4.0]  # the last one never occurs
    names = dict(zip(classes, "abcde"))
    got = metrics.confusion_matrix(scored, "label", "prediction", classes, names)
    assert got.columns == ["actual", *[f"pred_{n}" for n in "abcde"], "pred_other"]
    padded = np.pad(want, (0, 1))
    assert [list(r)[1:] for r in got.collect()] == padded.tolist()
    long = metrics.confusion_long(scored, "label", "prediction", classes).collect()
    assert [r.n for r in long] == padded.flatten().tolist()


def test_confusion_keeps_labels_that_are_not_listed(spark):
    rows = [("a", "a"), ("b", "unseen"), ("new", "a"), (None, "b"), ("a", None)]
    df = spark.createDataFrame(rows, "y string, p string")
    long = metrics.confusion_long(df, "y", "p", ["a", "b"])
    cells = {(r.actual, r.predicted): r.n for r in long.collect()}
    assert sum(cells.values()) == 5 and len(cells) == 9
    assert cells["other", "a"] == cells["other", "b"] == cells["a", "other"] == cells["b", "other"] == 1
    plan = metrics.confusion_matrix(df, "y", "p", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2


def test_one_hot_and_assemble(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("b", None, 3), (None, 4.0, None)], "s string, x double, n int")
    hot = encode.one_hot(df, "s", ["a", "b"], "s").select("s_a", "s_b").collect()
    assert [tuple(r) for r in hot] == [(1, 0), (0, 1), (0, 0)]
    zero = encode.assemble(df, ["x", "n"], missing="zero").select(vector_to_array("features")).collect()
    assert [r[0] for r in zero] == [[1.0, 2.0], [0.0, 3.0], [4.0, 0.0]]
    with pytest.raises(Exception, match="(?i)null"):
        encode.assemble(df, ["x", "n"]).collect()
    with pytest.raises(ValueError):
        encode.assemble(df, ["x"], missing="skip")


def test_label_index_orders_and_unseen(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "b", "a", "c", "c"]], "s string")
    assert encode.label_indexer("s").fit(df).labels == ["b", "c", "a"]
    alphabet = encode.label_indexer("s", alphabetical=True).fit(df)
    assert alphabet.labels == ["a", "b", "c"]
    new = spark.createDataFrame([("a",), ("zz",)], "s string")
    indexed = alphabet.transform(new)
    assert [r.label for r in indexed.collect()] == [0.0, 3.0]
    back = encode.label_names("label", "back", [*alphabet.labels, "unseen"]).transform(indexed)
    assert [r.back for r in back.collect()] == ["a", "unseen"]
    strict = encode.label_indexer("s", unseen="error").fit(df)
    with pytest.raises(Exception):
        strict.transform(new).collect()


@pytest.fixture(scope="module")
def blobs(spark):
    """Three classes around three centres."""
    rng = random.Random(2)
    centres = [(0.0, 0.0), (6.0, 0.0), (0.0, 6.0)]
    rows = [(i, float(c), *(x + rng.gauss(0, 0.7) for x in centres[c]), rng.gauss(0, 1))
            for i in range(600) for c in [rng.randrange(3)]]
    df = spark.createDataFrame(rows, "id long, label double, a double, b double, noise double")
    return hash_split(encode.assemble(df, ["a", "b", "noise"]), "id").cache()


CLASSES = ["x", "y", "z"]


def test_one_vs_rest(blobs):
    found = search(blobs, CLASSES, grid=[1e-3, 1e-1], validation=0.25)
    assert found.grid.reg in (1e-3, 1e-1) and len(found.grid.tried) == 2
    rows = found.scored.collect()
    for r in rows:
        scores = [r[f"score_{c}"] for c in CLASSES]
        assert r.prediction == float(np.argmax(scores))
        for c, s in zip(CLASSES, scores):
            m = found.models[c]
            assert s == pytest.approx(float(np.dot(m.coefficients.toArray(), r.features.toArray()) + m.intercept))
    assert sum(r.prediction == r.label for r in rows) / len(rows) > 0.9
    ranking = one_vs_rest.linear_importance(found.models, ["a", "b", "noise"], 2).collect()
    assert {r.feature for r in ranking} == {"a", "b"}
    want = sum(abs(m.coefficients.toArray()[0]) for m in found.models.values())
    assert {r.feature: r.importance for r in ranking}["a"] == pytest.approx(float(want))


def test_grid_on_training_rows_and_ties(blobs):
    train = blobs.filter("split = 'train'")
    found = one_vs_rest.grid_search(train, CLASSES, [1e-3, 1e-3])
    assert found.reg == 1e-3 and found.tried[0] == found.tried[1]
    # Strong Lasso sets every coefficient to zero, so one class gets all rows.
    weak = one_vs_rest.grid_search(train, CLASSES, [1e3, 1e-3])
    assert weak.reg == 1e-3 and weak.f1 > weak.tried[0][1]


def test_argmax_ties_take_first_class(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0), (0.0, 2.0, 2.0), (0.0, 0.0, 5.0)], "score_x double, score_y double, score_z double")
    assert [r.prediction for r in one_vs_rest.predict_class(df, CLASSES).collect()] == [0.0, 1.0, 2.0]


def test_trees_beat_the_mean(spark):
    rng = random.Random(9)
    rows = [(i, a, b, 3 * a + (10.0 if b > 0 else 0.0) + rng.gauss(0, 0.2))
            for i in range(800) for a, b in [(rng.uniform(0, 5), rng.uniform(-1, 1))]]
    df = spark.createDataFrame(rows, "id long, a double, b double, pm2_5 double")
    data = hash_split(encode.assemble(df, ["a", "b"]), "id").cache()
    for estimator in (
        models.forest_regressor(numTrees=10, maxDepth=5),
        models.boosted_regressor(maxIter=10, maxDepth=3),
        models.linear_regressor(),
    ):
        model, scored = models.fit_on_train(estimator, data)
        rows = {r.split: r for r in models.split_metrics(scored, "pm2_5").collect()}
        assert rows["test"].r2 > 0.7 and rows["train"].n + rows["test"].n == 800
        assert models.score_example(model, data, "id").count() == 1
    forest, _ = models.fit_on_train(models.forest_regressor(numTrees=5, maxDepth=3), data)
    top = models.tree_importance(forest, ["a", "b"], 5).collect()
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)
    assert sum(r.importance for r in top) == pytest.approx(1.0)


def test_default_parameters():
    forest, boosted = models.forest_regressor(), models.boosted_regressor()
    assert (forest.getMaxDepth(), forest.getNumTrees(), forest.getMaxBins(), forest.getSeed()) == (10, 100, 32, 42)
    assert (boosted.getMaxDepth(), boosted.getMaxIter(), boosted.getMaxBins(), boosted.getSeed()) == (5, 50, 32, 42)
    assert models.forest_classifier(minInstancesPerNode=2).getMinInstancesPerNode() == 2


def test_train_and_score(spark):
    rng = random.Random(4)
    start = 1_704_067_200
    rows = []
    for i in range(400):
        x = rng.uniform(0, 1)
        pm = 5 + 100 * x + rng.gauss(0, 1)
        category = "Good" if pm < 40 else "Moderate" if pm < 80 else "Unhealthy"
        rows.append((start + 3600 * i, pm, pm * 2, category, x, 50.0))
    df = spark.createDataFrame(rows, "t long, pm2_5 double, aqi double, aqi_category string, x double, mean double")
    df = df.withColumn("timestamp", F.timestamp_seconds("t").cast("timestamp_ntz"))
    small = {"numTrees": 5, "maxDepth": 4}
    out = train_and_score(
        df, ["x"], forecast="mean",
        params={"forest": small, "boosted": {"maxIter": 5, "maxDepth": 3}, "classifier": small},
    )
    regression = {(r.split, r.model): r for r in out.regression.collect()}
    assert len(regression) == 6
    for name in ("random_forest", "boosted_trees"):
        assert regression["test", name].rmse < regression["test", "baseline"].rmse
    classes = {r.split: r for r in out.classification.collect()}
    assert classes["test"].accuracy > 0.8 and classes["train"].n + classes["test"].n == 400
    assert out.scored.filter("predicted_category = aqi_category").count() > 320
    last = out.scored.filter("split = 'train'").agg(F.max("timestamp")).first()[0]
    assert out.scored.filter("split = 'test'").agg(F.min("timestamp")).first()[0] > last
    assert isinstance(out.models["classifier"], RandomForestClassificationModel)


def test_runs(spark, blobs):
    path = stage_path(spark, "runs-test")
    model, scored = models.fit_on_train(
        models.forest_regressor("a", numTrees=2, maxDepth=2), blobs.select("features", "a", "split")
    )
    measured = metrics.regression_metrics(scored, "a", "prediction")
    first = runs.log_run(spark, path, "forest", {"trees": 2}, measured, model)
    second = runs.log_run(spark, path, "mean", metrics={"rmse": 99.0, "mae": None})
    table = runs.read_runs(spark, path)
    assert {r.kind for r in table.filter(F.col("run_id") == first).collect()} == {"param", "metric", "artifact"}
    order = runs.compare_runs(table, ["rmse", "mae"], "rmse").collect()
    assert [r.run_id for r in order] == [first, second] and order[1].mae is None
    assert runs.best_run(table, "rmse").first().run_id == first
    assert runs.best_run(table, "rmse", ascending=False).first().run_id == second
    saved = table.filter("kind = 'artifact'").first().text
    again = runs.load_model(RandomForestRegressionModel, saved)
    assert again.transform(blobs).agg(F.sum("prediction")).first()[0] == pytest.approx(
        scored.agg(F.sum("prediction")).first()[0]
    )


def test_roles(spark):
    rows = [
        ("Liverpool", 80, 10, "GK"), ("Liverpool", 20, None, "CB"), ("Nowhere", 1, 1, "CB"),
        ("Inter", 50, 60, "ST"), ("Inter", 50, 60, "SUB"), ("Inter", 40, 50, None),
    ]
    players = spark.createDataFrame(rows, "Club string, `GK Diving` int, `Ball Control` int, BP string")
    vectors, skills = role_vectors(players)
    assert skills == ["Ball_Control", "GK_Diving"]
    got = {(r.RoleGroup, r.label, tuple(r.features.toArray())) for r in vectors.collect()}
    assert got == {("GK", 0.0, (10.0, 80.0)), ("DEF", 1.0, (0.0, 20.0)), ("OFF", 3.0, (60.0, 50.0))}
    with pytest.raises(ValueError):
        role_vectors(players.drop("BP"))


def test_coarse_labels(spark):
    df = spark.createDataFrame([(35.4,), (55.4,), (55.5,)], "pm2_5 double")
    got = [(r.air_quality_category, r.label) for r in coarse_labels(df).collect()]
    assert got == [("Good", 0.0), ("Moderate", 1.0), ("Unhealthy", 2.0)]


def test_training_rows_are_dealt_out_evenly(spark):
    """Rows in order of time, split by time: each task of a fit gets its share of the training rows."""
    from airseries.session import stage, stage_even

    df = spark.range(0, 8000, 1, 8).withColumn("split", F.when(F.col("id") < 4000, "train").otherwise("test"))

    def sizes(staged):
        return staged.filter("split = 'train'").groupBy(F.input_file_name()).count().select("count").collect()

    cores = spark.sparkContext.defaultParallelism
    assert len(sizes(stage(df, "in_order"))) < cores
    even = [r[0] for r in sizes(stage_even(df, "even"))]
    assert len(even) % cores == 0 and max(even) <= 1.1 * min(even)


def test_kept_node_ids_give_the_same_forest(spark, monkeypatch):
    df = spark.range(600).select(F.col("id").cast("double").alias("x"), (F.col("id") * 7 % 11).cast("double").alias("y"))
    data = encode.assemble(df.withColumn("split", F.lit("train")), ["x"])
    seen = []
    for limit in (0, 1 << 30):
        monkeypatch.setattr(models, "NODE_ID_BYTES", limit)
        model, _ = models.fit_on_train(models.forest_regressor("y", numTrees=4, maxDepth=4), data)
        seen.append((model.getOrDefault("cacheNodeIds"), model.toDebugString.split("\n", 1)[1]))
    assert [s[0] for s in seen] == [False, True] and seen[0][1] == seen[1][1]


def test_the_bound_of_node_ids_follows_the_cores(spark, monkeypatch):
    df = spark.range(600).select(F.col("id").cast("double").alias("x"), (F.col("id") * 7 % 11).cast("double").alias("y"))
    data = encode.assemble(df.withColumn("split", F.lit("train")), ["x"])
    ids = 600 * 4 * 2 * 4
    monkeypatch.setattr(models, "NODE_ID_BYTES", ids // spark.sparkContext.defaultParallelism)
    model, _ = models.fit_on_train(models.forest_regressor("y", numTrees=4, maxDepth=4), data)
    assert model.getOrDefault("cacheNodeIds")


def test_scans_of_evenly_dealt_rows_have_full_rounds(spark):
    """Files that Spark packs into 9 tasks on 8 cores would leave 7 of them idle in the second round."""
    from airseries.session import scan_tasks, stage, stage_even

    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 96_000, 1, 8).selectExpr("id", "hex(xxhash64(id)) AS a", "hex(xxhash64(id, 1)) AS b")
    settings = {"spark.sql.shuffle.partitions": 6 * cores, "spark.sql.files.maxPartitionBytes": "400k", "spark.sql.files.openCostInBytes": "8k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        packed = stage(df.repartition(6 * cores), "packed")
        even = stage_even(df, "even")
        assert scan_tasks(packed) % cores, scan_tasks(packed)
        assert scan_tasks(even) % cores == 0
        assert even.count() == 96_000 and even.selectExpr("sum(id)").first()[0] == df.selectExpr("sum(id)").first()[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
