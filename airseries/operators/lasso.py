"""Lasso regressions of many targets at many strengths, from one set of moments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Rows, means, sample deviations and correlations of the features followed by the targets."""

    rows: int
    means: np.ndarray
    spreads: np.ndarray
    correlations: np.ndarray
    targets: int


@dataclass(frozen=True)
class Line:
    """A fitted linear model."""

    coefficients: np.ndarray
    intercept: float

    def score(self, x: Column) -> Column:
        """The prediction from an array of features; a plain sum over the features that count."""
        total = F.lit(float(self.intercept))
        for i in np.flatnonzero(self.coefficients).tolist():
            total = total + F.lit(float(self.coefficients[i])) * x[i]
        return total


def moments(df: DataFrame, targets: Sequence[Column], features: str = "features") -> Moments:
    """Moments of a vector column and the targets, in three passes whatever the number of targets.

    Sums are partial in every task and merged by tree; the driver sees a square of as many columns as there are
    features and targets. Deviations are taken from the means before they are multiplied, so nothing cancels.
    """
    joined = F.concat(vector_to_array(F.col(features)), F.array(*[t.cast("double") for t in targets]))
    vectors = df.select(array_to_vector(joined).alias("v"))
    if len(vectors.take(2)) < 2:
        raise ValueError("a Lasso needs two rows or more")
    found = vectors.select(Summarizer.metrics("count", "mean", "std").summary(F.col("v")).alias("s")).select("s.*").first()
    matrix = np.array(Correlation.corr(vectors, "v").first()[0].toArray())
    return Moments(found["count"], found["mean"].toArray(), found["std"].toArray(), matrix, len(targets))


def descend(
    correlations: np.ndarray, wanted: np.ndarray, limit: float, start: np.ndarray, tolerance: float = 1e-9, rounds: int = 10_000
) -> np.ndarray:
    """Weights that minimise ``w'Rw / 2 - w'r + limit * |w|``, by cyclic coordinate descent from ``start``."""
    w = start.copy()
    pull = wanted - correlations @ w
    for _ in range(rounds):
        change = 0.0
        for j in range(len(w)):
            free = pull[j] + w[j]
            new = np.sign(free) * max(abs(free) - limit, 0.0)
            step = new - w[j]
            if step:
                pull -= correlations[:, j] * step
                w[j] = new
                change = max(change, abs(step))
        if change < tolerance:
            break
    return w


def lasso_path(found: Moments, strengths: Sequence[float]) -> list[list[Line]]:
    """For every strength one line per target; features are standardised, as Spark ML does it.

    Features or targets that do not vary have weight 0. Strengths are worked on from the strongest, each from the
    weights of the one before.
    """
    n, split = found.rows, len(found.means) - found.targets
    varies = found.spreads > 0
    used = np.flatnonzero(varies[:split])
    square = found.correlations[np.ix_(used, used)]
    lines: dict[tuple[int, int], Line] = {}
    for k in range(found.targets):
        spread, mean = found.spreads[split + k], found.means[split + k]
        weights = np.zeros(len(used))
        for s in sorted(range(len(strengths)), key=lambda s: -strengths[s]):
            coefficients = np.zeros(split)
            if varies[split + k] and len(used):
                # The strength counts in deviations of the target over n rows; ``spread`` is over n - 1.
                limit = strengths[s] / spread * np.sqrt(n / (n - 1))
                weights = descend(square, found.correlations[used, split + k], limit, weights)
                coefficients[used] = weights * spread / found.spreads[used]
            lines[s, k] = Line(coefficients, float(mean - coefficients @ found.means[:split]))
    return [[lines[s, k] for k in range(found.targets)] for s in range(len(strengths))]


def ovr_path(
    df: DataFrame,
    classes: Sequence[str],
    strengths: Sequence[float],
    features: str = "features",
    label: str = "label",
) -> list[dict[str, Line]]:
    """One line per class for every strength; class ``i`` has the label ``float(i)``."""
    targets = [F.when(F.col(label) == float(i), 1.0).otherwise(0.0) for i in range(len(classes))]
    found = moments(df, targets, features)
    return [dict(zip(classes, lines, strict=True)) for lines in lasso_path(found, strengths)]


def best_class(models: Mapping[str, Line], x: Column) -> Column:
    """Index of the class with the highest score; ties go to the first class."""
    scores = F.array(*[line.score(x) for line in models.values()])
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")
