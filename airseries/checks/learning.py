"""Queries on vectors, label indices, models and one-vs-rest."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.checks.fixture import AQI, BAND, FILLED, K, R, filled, raw_readings, readings, table
from airseries.checks.registry import query, r6, rounded
from airseries.checks.sources import scratch_database
from airseries.functions.bands import COARSE_BANDS, COARSE_CODES, ROLE_CODES, band, encode_labels, piecewise
from airseries.operators import metrics, models
from airseries.operators.clean import drop_missing
from airseries.operators.columns import PLAYER_SKILLS
from airseries.operators.encode import assemble, label_indexer, label_names
from airseries.operators.one_vs_rest import (
    add_scores,
    fit_ovr_lasso,
    grid_search,
    linear_importance,
    predict_class,
)
from airseries.operators.runs import load_model, save_model
from airseries.operators.sampling import hash_split, temporal_split, time_cut
from airseries.operators.temporal import rolling_mean, with_row_frames
from airseries.plans.readings import FEATURES, build_features, prepare
from airseries.plans.roles import TOP_CLUBS, role_vectors
from airseries.plans.training import one_vs_rest, train_and_score
from airseries.session import stage, stage_even, stage_path
from airseries.sources.sinks import write_checked

def _model_table(spark: SparkSession, sf: str) -> DataFrame:
    """Leak-free features, with vectors, split by time."""
    features = build_features(prepare(raw_readings(spark, sf)), causal=True)
    columns = ["timestamp", "pm2_5", "aqi", "aqi_category", "features"]
    vectors = stage_even(assemble(features, FEATURES).select(*columns), "model-input")
    return temporal_split(vectors, "timestamp", cut=time_cut(vectors, "timestamp"))


@query(
    "assemble_vectors",
    f"""WITH {FILLED} SELECT event_id, round(pm + 1e-9, 6) AS x0, round(temp + 1e-9, 6) AS x1,
        CAST(station AS DOUBLE) AS x2 FROM f""",
)
def assemble_vectors(spark: SparkSession, sf: str) -> DataFrame:
    df = assemble(filled(spark, sf), ["pm", "temp", "station"])
    x = vector_to_array("features")
    return df.select("event_id", *[r6(x[i], f"x{i}") for i in range(3)])


@query(
    "assemble_zero",
    f"""WITH {R} SELECT event_id, round(coalesce(pm, 0) + 1e-9, 6) AS x0,
        round(coalesce(temp, 0) + 1e-9, 6) AS x1 FROM r""",
)
def assemble_zero(spark: SparkSession, sf: str) -> DataFrame:
    df = assemble(readings(spark, sf), ["pm", "temp"], missing="zero")
    x = vector_to_array("features")
    return df.select("event_id", *[r6(x[i], f"x{i}") for i in range(2)])


_INDEX = f"""WITH {K}, n AS (SELECT coalesce(direction, 'cv') AS direction, event_id FROM k),
g AS (SELECT direction, count(*) AS c FROM n GROUP BY direction),
i AS (SELECT direction, CAST(row_number() OVER (ORDER BY c DESC, direction) - 1 AS DOUBLE) AS by_frequency,
             CAST(row_number() OVER (ORDER BY direction) - 1 AS DOUBLE) AS by_alphabet FROM g)"""


@query(
    "label_index",
    f"{_INDEX} SELECT event_id, by_frequency, by_alphabet, direction AS label_back FROM n JOIN i USING (direction)",
)
def label_index(spark: SparkSession, sf: str) -> DataFrame:
    df = drop_missing(readings(spark, sf), "pm").select(
        "event_id", F.coalesce("direction", F.lit("cv")).alias("direction")
    )
    frequency = label_indexer("direction", "by_frequency").fit(df)
    alphabet = label_indexer("direction", "by_alphabet", alphabetical=True).fit(df)
    indexed = alphabet.transform(frequency.transform(df))
    back = label_names("by_alphabet", "label_back", alphabet.labels).transform(indexed)
    return back.select("event_id", "by_frequency", "by_alphabet", "label_back")


@query(
    "argmax_class",
    """SELECT vec_id, CAST(list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS DOUBLE) AS prediction
       FROM embeddings""",
)
def argmax_class(spark: SparkSession, sf: str) -> DataFrame:
    classes = [str(i) for i in range(10)]
    df = table(spark, sf, "embeddings")
    scores = {f"score_{c}": F.col("embedding")[i].cast("double") for i, c in enumerate(classes)}
    return predict_class(df.withColumns(scores), classes).select("vec_id", "prediction")


@query(
    "linear_regression",
    f"""WITH {FILLED}, c AS (SELECT regr_slope(pm, temp) AS slope, regr_intercept(pm, temp) AS intercept FROM f)
    SELECT round(min(slope) + 1e-9, 6) AS slope, round(min(intercept) + 1e-9, 6) AS intercept, count(*) AS n,
        round(sqrt(avg(pow(pm - intercept - slope * temp, 2))) + 1e-9, 6) AS rmse,
        round(avg(abs(pm - intercept - slope * temp)) + 1e-9, 6) AS mae,
        round(1 - avg(pow(pm - intercept - slope * temp, 2)) / var_pop(pm) + 1e-9, 6) AS r2 FROM f, c""",
)
def linear_regression(spark: SparkSession, sf: str) -> DataFrame:
    # Fitting reads its input more than once.
    df = stage(assemble(filled(spark, sf), ["temp"]).select("pm", "features"), "line")
    model = models.linear_regressor("pm").fit(df)
    measured = metrics.regression_metrics(model.transform(df), "pm", "prediction")
    return rounded(
        measured.select(
            F.lit(float(model.coefficients[0])).alias("slope"),
            F.lit(float(model.intercept)).alias("intercept"),
            "*",
        )
    )


@query(
    "linear_scoring",
    f"""WITH {FILLED}, c AS (SELECT regr_slope(pm, temp) AS slope, regr_intercept(pm, temp) AS intercept FROM f)
    SELECT event_id, round(intercept + slope * temp + 1e-9, 6) AS prediction FROM f, c""",
)
def linear_scoring(spark: SparkSession, sf: str) -> DataFrame:
    df = stage(assemble(filled(spark, sf), ["temp"]).select("event_id", "pm", "features"), "line")
    path = stage_path(spark, "model")
    save_model(models.linear_regressor("pm").fit(df), path)
    model = load_model(LinearRegressionModel, path)
    return model.transform(df).select("event_id", r6("prediction"))


# Two yes/no features split the rows into four groups. A tree of depth two that
# sees all rows and features then gives each group its own leaf, so the models
# below can be checked in SQL: a leaf holds the group's mean, or its most
# frequent class.
_GROUPS = f"""{FILLED}, m3 AS (SELECT *, avg(pm) OVER (ORDER BY ts, event_id ROWS 2 PRECEDING) AS mean_3 FROM f),
    g AS (SELECT event_id, pm, CAST(mean_3 > 50.0005 AS INT) AS high,
        CAST(hour(ts) BETWEEN 8 AND 18 AS INT) AS daytime,
        CASE WHEN pm <= 35.4 THEN 'Good' WHEN pm <= 55.4 THEN 'Moderate' ELSE 'Unhealthy' END AS category,
        CASE WHEN (((event_id % 2147483647) * 2654435761) % 4294967296) / 4294967296.0e0 < 0.8
             THEN 'train' ELSE 'test' END AS split FROM m3)"""
FULL_TREE = {"numTrees": 3, "maxDepth": 2, "bootstrap": False, "featureSubsetStrategy": "all"}


def _grouped(spark: SparkSession, sf: str) -> DataFrame:
    df = filled(spark, sf).select("event_id", "ts", "pm")
    df = with_row_frames(df, {"mean_3": rolling_mean("pm", 3)}, ["ts", "event_id"]).select(
        "event_id",
        "pm",
        (F.col("mean_3") > 50.0005).cast("int").alias("high"),
        F.hour("ts").between(8, 18).cast("int").alias("daytime"),
        band("pm", COARSE_BANDS).alias("category"),
    )
    return stage(hash_split(assemble(df, ["high", "daytime"]), "event_id"), "groups")


_GROUP_MEANS = f"""WITH {_GROUPS},
l AS (SELECT high, daytime, avg(pm) AS leaf FROM g WHERE split = 'train' GROUP BY high, daytime)
SELECT event_id, split, round(leaf + 1e-9, 6) AS prediction FROM g JOIN l USING (high, daytime)"""


@query("rf_group_means", _GROUP_MEANS)
def rf_group_means(spark: SparkSession, sf: str) -> DataFrame:
    data = _grouped(spark, sf)
    _, scored = models.fit_on_train(models.forest_regressor("pm", **FULL_TREE), data)
    return rounded(scored.select("event_id", "split", "prediction"))


@query("gbt_group_means", _GROUP_MEANS)
def gbt_group_means(spark: SparkSession, sf: str) -> DataFrame:
    # After the first tree the residual of every group has the mean zero.
    data = _grouped(spark, sf)
    _, scored = models.fit_on_train(models.boosted_regressor("pm", maxDepth=2, maxIter=3), data)
    return rounded(scored.select("event_id", "split", "prediction"))


@query(
    "rf_group_classes",
    f"""WITH {_GROUPS},
    i AS (SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS label
          FROM g WHERE split = 'train' GROUP BY category),
    c AS (SELECT high, daytime, category, label, count(*) AS n
          FROM g JOIN i USING (category) WHERE split = 'train' GROUP BY ALL),
    l AS (SELECT high, daytime, category AS predicted
          FROM c QUALIFY row_number() OVER (PARTITION BY high, daytime ORDER BY n DESC, label) = 1)
    SELECT event_id, split, category, predicted
    FROM g JOIN l USING (high, daytime)""",
)
def rf_group_classes(spark: SparkSession, sf: str) -> DataFrame:
    data = _grouped(spark, sf)
    indexer = label_indexer("category").fit(data.filter(F.col("split") == "train"))
    _, scored = models.fit_on_train(
        models.forest_classifier(**FULL_TREE), indexer.transform(data)
    )
    named = label_names("prediction", "predicted", [*indexer.labels, "unseen"]).transform(scored)
    return named.select("event_id", "split", "category", "predicted")


@query("rf_regression")
def rf_regression(spark: SparkSession, sf: str) -> DataFrame:
    data = _model_table(spark, sf)
    _, scored = models.fit_on_train(models.forest_regressor("pm2_5"), data)
    return rounded(models.split_metrics(scored, "pm2_5").orderBy("split"))


@query("gbt_regression")
def gbt_regression(spark: SparkSession, sf: str) -> DataFrame:
    data = _model_table(spark, sf)
    _, scored = models.fit_on_train(models.boosted_regressor("pm2_5"), data)
    return rounded(models.split_metrics(scored, "pm2_5").orderBy("split"))


@query(
    "feature_importance",
    f"""WITH {_GROUPS}, t AS (SELECT * FROM g WHERE split = 'train'),
    v AS (SELECT (SELECT count(*) * var_pop(pm) FROM t) AS whole,
        (SELECT sum(v) FROM (SELECT count(*) * var_pop(pm) AS v FROM t GROUP BY high)) AS by_high,
        (SELECT sum(v) FROM (SELECT count(*) * var_pop(pm) AS v FROM t GROUP BY daytime)) AS by_day,
        (SELECT sum(v) FROM (SELECT count(*) * var_pop(pm) AS v FROM t GROUP BY high, daytime)) AS by_both),
    w AS (SELECT whole - by_both AS gained,
        CASE WHEN by_high <= by_day THEN whole - by_high ELSE by_day - by_both END AS high FROM v)
    SELECT 'high' AS feature, round(high / gained + 1e-9, 6) AS importance FROM w
    UNION ALL SELECT 'daytime', round(1 - high / gained + 1e-9, 6) FROM w""",
)
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    # A feature's importance is the variance its splits take away, as a share of all that is taken.
    data = _grouped(spark, sf)
    model, _ = models.fit_on_train(models.forest_regressor("pm", **FULL_TREE), data)
    return rounded(models.tree_importance(model, ["high", "daytime"]))


_LINE = f"""WITH {FILLED}, c AS (SELECT regr_slope(pm, temp) AS slope, regr_intercept(pm, temp) AS intercept FROM f)"""


@query(
    "score_example",
    f"""{_LINE} SELECT event_id, round(pm + 1e-9, 6) AS pm,
        round(intercept + slope * temp + 1e-9, 6) AS prediction FROM f, c ORDER BY event_id LIMIT 1""",
)
def score_example(spark: SparkSession, sf: str) -> DataFrame:
    df = stage(assemble(filled(spark, sf), ["temp"]).select("event_id", "pm", "features"), "line")
    model = models.linear_regressor("pm").fit(df)
    scored = models.score_example(model, df, "event_id")
    return rounded(scored.select("event_id", "pm", "prediction"))


@query(
    "scored_table",
    f"""{_LINE}, s AS (SELECT event_id, ts, pm, intercept + slope * temp AS prediction FROM f, c)
    SELECT event_id, ts, round(pm + 1e-9, 6) AS pm, round(prediction + 1e-9, 6) AS prediction,
        round({AQI.format(x='pm')} + 1e-9, 6) AS aqi, {BAND.format(x='pm')} AS category FROM s""",
)
def scored_table(spark: SparkSession, sf: str) -> DataFrame:
    # Predictions saved as a checked table with time, actual value, index and category, and read back.
    df = filled(spark, sf).select("event_id", "ts", "pm", "temp")
    df = df.withColumns({"aqi": piecewise("pm"), "category": band("pm")})
    vectors = stage(assemble(df, ["temp"]).drop("temp"), "line")
    model = models.linear_regressor("pm").fit(vectors)
    with scratch_database(spark) as name:
        saved = write_checked(model.transform(vectors).drop("features"), f"{name}.predictions")
    return rounded(saved.select("event_id", "ts", "pm", "prediction", "aqi", "category"))


@query("rf_classifier")
def rf_classifier(spark: SparkSession, sf: str) -> DataFrame:
    data = _model_table(spark, sf)
    train = data.filter(F.col("split") == "train")
    indexer = label_indexer("aqi_category").fit(train)
    _, scored = models.fit_on_train(
        models.forest_classifier(), indexer.transform(data)
    )
    test = label_names("prediction", "predicted", [*indexer.labels, "unseen"]).transform(
        scored.filter(F.col("split") == "test")
    )
    return metrics.confusion_long(test, "aqi_category", "predicted", indexer.labels)


@query(
    "rf_probabilities",
    f"""WITH {_GROUPS},
    l AS (SELECT high, avg(CAST(pm > 50.0005 AS INT)) AS share FROM g WHERE split = 'train' GROUP BY high)
    SELECT event_id, split, round(greatest(share, 1 - share) + 1e-9, 6) AS probability FROM g JOIN l USING (high)""",
)
def rf_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    # A leaf's probability of a class is the class's share of the leaf's rows. A high mean goes
    # with a high value, so the two leaves name different classes and are not merged.
    grouped = _grouped(spark, sf).drop("features")
    grouped = grouped.withColumn("side", F.when(F.col("pm") > 50.0005, "above").otherwise("below"))
    data = assemble(grouped, ["high"])
    indexer = label_indexer("side").fit(data.filter(F.col("split") == "train"))
    _, scored = models.fit_on_train(models.forest_classifier(**FULL_TREE), indexer.transform(data))
    best = F.array_max(vector_to_array("probability"))
    return rounded(scored.select("event_id", "split", best.alias("probability")))


@query("train_and_score")
def train_and_score_all(spark: SparkSession, sf: str) -> DataFrame:
    features = build_features(prepare(raw_readings(spark, sf)), causal=True)
    trained = train_and_score(features)
    return rounded(
        trained.scored.select(
            "timestamp", "pm2_5", "rf_prediction", "gb_prediction", "aqi", "aqi_category",
            "predicted_category", "split",
        )
    )


def _lasso_vectors(spark: SparkSession, sf: str) -> DataFrame:
    features = build_features(prepare(raw_readings(spark, sf)), causal=True, keep=["No"])
    df = features.withColumn("air_quality_category", band("pm2_5", COARSE_BANDS))
    df = df.withColumn("label", encode_labels("air_quality_category", COARSE_CODES))
    df = hash_split(assemble(df, FEATURES, missing="zero"), "No")
    return df.select(
        "features", "label", "pm2_5", "timestamp", "air_quality_category", "split"
    )


@query(
    "ovr_lasso_line",
    f"""WITH {FILLED}, w AS (SELECT event_id, pm, avg(pm) OVER (ORDER BY ts, event_id ROWS 5 PRECEDING) AS x,
        CASE WHEN pm <= 35.4 THEN 0 WHEN pm <= 55.4 THEN 1 ELSE 2 END AS label FROM f),
    c AS (SELECT t.c, corr(CAST(label = t.c AS INT), x) AS rho, stddev_pop(CAST(label = t.c AS INT)) AS sy,
                 stddev_pop(x) AS sx, avg(CAST(label = t.c AS INT)) AS my, avg(x) AS mx
          FROM w, (VALUES (0), (1), (2)) t(c) GROUP BY t.c),
    b AS (SELECT c, sign(rho) * greatest(abs(rho) - 0.05e0 / sy, 0) * sy / sx AS slope, my, mx FROM c),
    s AS (SELECT event_id, CAST(label AS DOUBLE) AS label,
                 max(CASE WHEN c = 0 THEN my + slope * (x - mx) END) AS s0,
                 max(CASE WHEN c = 1 THEN my + slope * (x - mx) END) AS s1,
                 max(CASE WHEN c = 2 THEN my + slope * (x - mx) END) AS s2 FROM w, b GROUP BY event_id, label)
    SELECT event_id, label, round(s0 + 1e-9, 4) AS "score_Good", round(s1 + 1e-9, 4) AS "score_Moderate",
        round(s2 + 1e-9, 4) AS "score_Unhealthy",
        CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0.0e0 WHEN s1 >= s2 THEN 1.0e0 ELSE 2.0e0 END AS prediction FROM s""",
)
def ovr_lasso_line(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _line_vectors(spark, sf)
    classes = list(COARSE_CODES)
    fitted = fit_ovr_lasso(vectors, classes, 0.05)
    scored = predict_class(add_scores(vectors, fitted), classes)
    scores = [F.round(F.col(f"score_{c}") + 1e-9, 4).alias(f"score_{c}") for c in classes]
    return scored.select("event_id", "label", *scores, "prediction")


def _line_vectors(spark: SparkSession, sf: str) -> DataFrame:
    # With one feature the Lasso has a closed form: the correlation is pulled
    # towards zero by the strength over the spread of the target.
    df = filled(spark, sf).select("event_id", "ts", "pm")
    df = with_row_frames(df, {"x": rolling_mean("pm", 6)}, ["ts", "event_id"])
    df = df.withColumn("label", encode_labels(band("pm", COARSE_BANDS), COARSE_CODES))
    return stage(assemble(df, ["x"]).select("event_id", "label", "features"), "line")


_LASSO = f"""WITH {FILLED}, w AS (SELECT event_id, pm, avg(pm) OVER (ORDER BY ts, event_id ROWS 5 PRECEDING) AS x,
        CASE WHEN pm <= 35.4 THEN 0 WHEN pm <= 55.4 THEN 1 ELSE 2 END AS label FROM f),
    c AS (SELECT t.c, corr(CAST(label = t.c AS INT), x) AS rho, stddev_pop(CAST(label = t.c AS INT)) AS sy,
                 stddev_pop(x) AS sx, avg(CAST(label = t.c AS INT)) AS my, avg(x) AS mx
          FROM w, (VALUES (0), (1), (2)) t(c) GROUP BY t.c),
    grid(reg) AS (VALUES (1e-4), (1e-3), (1e-2), (1e-1), (3e-1)),
    b AS (SELECT reg, c, sign(rho) * greatest(abs(rho) - reg / sy, 0) * sy / sx AS slope, my, mx FROM c, grid)"""


@query(
    "ovr_lasso_importance",
    f"""{_LASSO} SELECT 'x' AS feature, round(sum(abs(slope)) + 1e-9, 4) AS importance FROM b WHERE reg = 0.01""",
)
def ovr_lasso_importance(spark: SparkSession, sf: str) -> DataFrame:
    fitted = fit_ovr_lasso(_line_vectors(spark, sf), list(COARSE_CODES), 1e-2)
    found = linear_importance(fitted, ["x"])
    return found.select("feature", F.round(F.col("importance") + 1e-9, 4).alias("importance"))


@query(
    "ovr_lasso_grid",
    f"""{_LASSO},
    s AS (SELECT reg, event_id, label, max(CASE WHEN c = 0 THEN my + slope * (x - mx) END) AS s0,
              max(CASE WHEN c = 1 THEN my + slope * (x - mx) END) AS s1,
              max(CASE WHEN c = 2 THEN my + slope * (x - mx) END) AS s2 FROM w, b GROUP BY reg, event_id, label),
    p AS (SELECT reg, label, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS guess FROM s),
    tally AS (SELECT reg, t.c, count(*) FILTER (label = t.c) AS actual, count(*) FILTER (guess = t.c) AS guessed,
              count(*) FILTER (label = t.c AND guess = t.c) AS hit
          FROM p, (VALUES (0), (1), (2)) t(c) GROUP BY reg, t.c),
    scored AS (SELECT CAST(reg AS DOUBLE) AS reg, sum(actual * CASE WHEN hit > 0 THEN 2.0e0 * hit / (actual + guessed) ELSE 0 END)
        / sum(actual) AS f1 FROM tally GROUP BY reg)
    SELECT reg, round(f1 + 1e-9, 6) AS f1, row_number() OVER (ORDER BY round(f1, 9) DESC, reg) = 1 AS chosen FROM scored""",
)
def ovr_lasso_grid(spark: SparkSession, sf: str) -> DataFrame:
    found = grid_search(_line_vectors(spark, sf), list(COARSE_CODES))
    # One row per strength tried; the first of the best is chosen.
    return rounded(found.table(spark).drop("place"))


@query("ovr_lasso")
def ovr_lasso(spark: SparkSession, sf: str) -> DataFrame:
    found = one_vs_rest(_lasso_vectors(spark, sf), list(COARSE_CODES))
    return rounded(
        found.scored.select(
            "timestamp", "pm2_5", "label", "prediction", "air_quality_category",
            *[f"score_{c}" for c in COARSE_CODES],
        )
    )


@query("ovr_lasso_metrics")
def ovr_lasso_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = one_vs_rest(
        _lasso_vectors(spark, sf), list(COARSE_CODES), validation=0.25
    )
    measured = metrics.classification_metrics(found.scored, "label", "prediction")
    return rounded(measured.select(F.lit(found.grid.reg).alias("reg"), "*"))


@query("ovr_lasso_embeddings")
def ovr_lasso_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "embeddings").select(
        "vec_id",
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").cast("double").alias("label"),
    )
    classes = [str(i) for i in range(10)]
    found = one_vs_rest(hash_split(df, "vec_id"), classes)
    names = [f"e{i}" for i in range(64)]
    return rounded(linear_importance(found.models, names, 15))


@query(
    "role_vectors",
    """WITH p AS (SELECT vec_id, embedding AS e, CASE WHEN label = 0 THEN 'GK' WHEN label IN (1, 2) THEN 'DEF'
        WHEN label IN (3, 4) THEN 'MID' WHEN label IN (5, 6, 7) THEN 'OFF' END AS role
        FROM embeddings WHERE vec_id % 3 <> 0)
    SELECT role, CASE role WHEN 'GK' THEN 0.0e0 WHEN 'DEF' THEN 1.0e0 WHEN 'MID' THEN 2.0e0 ELSE 3.0e0 END AS label,
        count(*) AS n, round(avg(CAST(e[3] AS DOUBLE)) + 1e-9, 6) AS heading,
        round(avg(CASE WHEN vec_id % 2 = 0 THEN CAST(e[30] AS DOUBLE) ELSE 0 END) + 1e-9, 6) AS diving
    FROM p WHERE role IS NOT NULL GROUP BY role""",
)
def role_path(spark: SparkSession, sf: str) -> DataFrame:
    # Vectors seen as players: a third plays for clubs not listed, two labels have no role, half the
    # players have no value for one skill.
    e, v = F.col("embedding"), F.col("vec_id")
    clubs = F.array(*[F.lit(c) for c in TOP_CLUBS])
    positions = F.array(*[F.lit(x) for x in ("GK", "CB", "LB", "CDM", "CM", "ST", "CAM", "LW", "SUB", None)])
    skills = {name: e[i].cast("double") for i, name in enumerate(PLAYER_SKILLS)}
    skills["GK Diving"] = F.when(v % 2 == 0, skills["GK Diving"])
    players = table(spark, sf, "embeddings").select(
        F.when(v % 3 != 0, clubs[(v % len(TOP_CLUBS)).cast("int")]).otherwise("Elsewhere").alias("Club"),
        positions[F.col("label")].alias("BP"),
        *[c.alias(name) for name, c in skills.items()],
    )
    vectors, names = role_vectors(players)
    x = vector_to_array("features")
    return rounded(
        vectors.groupBy(F.col("RoleGroup").alias("role"), "label").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(x[names.index("Heading_Accuracy")]).alias("heading"),
            F.avg(x[names.index("GK_Diving")]).alias("diving"),
        )
    )


@query("role_classes")
def role_classes(spark: SparkSession, sf: str) -> DataFrame:
    """One-vs-rest on role vectors: the metrics of the held-out players."""
    e = F.col("embedding")
    players = table(spark, sf, "embeddings").select(
        "vec_id",
        F.lit(TOP_CLUBS[0]).alias("Club"),
        F.array(*[F.lit(x) for x in ("GK", "CB", "LB", "CDM", "CM", "ST", "CAM", "LW", "RW", "RB")])[
            F.col("label")
        ].alias("BP"),
        *[e[i].cast("double").alias(name) for i, name in enumerate(PLAYER_SKILLS)],
    )
    vectors, _ = role_vectors(players)
    # The vectors carry no id; a hash of their skills splits them the same way on every run.
    key = F.xxhash64(vector_to_array("features"))
    split = vectors.select("label", "features", F.when(F.pmod(key, F.lit(5)) < 4, "train").otherwise("test").alias("split"))
    found = one_vs_rest(split, list(ROLE_CODES))
    measured = metrics.classification_metrics(found.scored, "label", "prediction")
    return rounded(measured.select(F.lit(found.grid.reg).alias("reg"), "*"))
