"""One Lasso regression per class, and the class with the highest score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.operators.lasso import Line, best_class, ovr_path
from airseries.operators.metrics import classification_metrics
from airseries.operators.models import _ranked

# Regularisation strengths tried by the grid search.
LASSO_GRID = (1e-4, 1e-3, 1e-2, 1e-1, 3e-1)

Models = dict[str, LinearRegressionModel]


def fit_ovr_lasso(
    df: DataFrame,
    classes: Sequence[str],
    reg: float,
    features: str = "features",
    label: str = "label",
    max_iter: int = 200,
    parallelism: int = 4,
) -> Models:
    """One model per class with a 0/1 target; class ``i`` has the label ``float(i)``.

    The fits are independent Spark jobs, submitted ``parallelism`` at a time.
    """

    def fit(item: tuple[int, str]) -> LinearRegressionModel:
        target = F.when(F.col(label) == float(item[0]), 1.0).otherwise(0.0)
        lasso = LinearRegression(
            featuresCol=features,
            labelCol="y",
            elasticNetParam=1.0,
            regParam=reg,
            maxIter=max_iter,
            standardization=True,
        )
        return lasso.fit(df.select(features, target.alias("y")))

    # Wrapped anew for each fit: a wrapped function sets the one copy of the local properties
    # taken when it was wrapped, which concurrent fits must not share.
    inherit = inheritable_thread_target(df.sparkSession)
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        fits = [pool.submit(inherit(fit), item) for item in enumerate(classes)]
        return {c: f.result() for c, f in zip(classes, fits, strict=True)}


def add_scores(df: DataFrame, models: Mapping[str, LinearRegressionModel]) -> DataFrame:
    """One ``score_<class>`` column per model."""
    for name, model in models.items():
        df = model.copy().setPredictionCol(f"score_{name}").transform(df)
    return df


def predict_class(df: DataFrame, classes: Sequence[str], out: str = "prediction") -> DataFrame:
    """Index of the class with the highest score; ties go to the first class."""
    scores = F.array(*[F.col(f"score_{c}") for c in classes])
    first = F.array_position(scores, F.array_max(scores)) - 1
    return df.withColumn(out, first.cast("double"))


@dataclass(frozen=True)
class GridResult:
    """Best strength, its F1, the F1 of every strength tried, and the lines of the best one."""

    reg: float
    f1: float
    tried: list[tuple[float, float]]
    lines: dict[str, Line]

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per strength in the order tried, the chosen one marked."""
        place = self.tried.index((self.reg, self.f1))
        rows = [(i, reg, f1, i == place) for i, (reg, f1) in enumerate(self.tried)]
        return spark.createDataFrame(rows, "place int, reg double, f1 double, chosen boolean")


def grid_search(
    train: DataFrame,
    classes: Sequence[str],
    grid: Sequence[float] = LASSO_GRID,
    validate: DataFrame | None = None,
    features: str = "features",
    label: str = "label",
) -> GridResult:
    """The strength with the best weighted F1; the first one wins a tie.

    Scored on ``validate``, or on the training rows where none is given. All strengths and classes are fitted from the
    same moments of the training rows, and all strengths are scored in one pass: the
    number of passes does not depend on the grid.
    """
    path = ovr_path(train, classes, grid, features, label)
    x = vector_to_array(F.col(features))
    scored = (train if validate is None else validate).select(F.col(label).alias("_label"), x.alias("_x"))
    guesses = F.array(
        *[F.struct(F.lit(i).alias("_place"), best_class(models, F.col("_x")).alias("_guess")) for i, models in enumerate(path)]
    )
    measured = classification_metrics(scored.select("_label", F.inline(guesses)), "_label", "_guess", by=["_place"])
    by_place = {r["_place"]: float(r["f1"]) for r in measured.collect()}
    tried = [(reg, by_place[i]) for i, reg in enumerate(grid)]
    best = max(range(len(tried)), key=lambda i: (tried[i][1], -i))
    return GridResult(*tried[best], tried, path[best])


def linear_importance(
    models: Mapping[str, LinearRegressionModel], features: Sequence[str], k: int = 20
) -> DataFrame:
    """The ``k`` features with the largest sum of absolute coefficients over all classes."""
    sums = [0.0] * len(features)
    for model in models.values():
        for i, w in enumerate(model.coefficients.toArray()):
            sums[i] += abs(float(w))
    return _ranked(list(zip(features, sums)), k)
