"""Linear models of a quantile, fitted by rounds of weighted sums."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.operators.columns import quoted
from airseries.operators.quantiles import quantiles_of
from airseries.session import stage


@dataclass(frozen=True)
class QuantileLine:
    """A fitted quantile: intercept, one slope a feature, and the rounds it took."""

    quantile: float
    features: tuple[str, ...]
    intercept: float
    slopes: tuple[float, ...]
    rounds: int

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Adds the line's value; null where a feature is missing."""
        return df.withColumn(out, _line(self.features, self.slopes) + F.lit(self.intercept))


def _line(features: Sequence[str], slopes: Sequence[float]) -> Column:
    line = F.lit(0.0)
    for name, slope in zip(features, slopes, strict=True):
        line = line + F.col(quoted(name)).cast("double") * F.lit(float(slope))
    return line


def quantile_regression(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    probabilities: Sequence[float] = (0.5,),
    rounds: int = 50,
    tolerance: float = 1e-5,
    smoothing: float = 1e-4,
) -> list[QuantileLine]:
    """The lines of least pinball loss for these quantiles, for any number of rows.

    The loss is not smooth, so each round minimises a quadratic that lies above it and touches it at the current line:
    a least-squares fit with weights 1 / (smoothing + |residual|), in units of the label's spread. A round is
    one aggregate over staged rows for all quantiles still moving; its (features + 1)^2 sums a quantile, whatever the
    number of rows, are all that reaches the driver. Coefficients that no longer move by more than
    ``tolerance`` end a quantile's rounds. Last, the intercepts become the exact quantiles of what the slopes
    leave, so a model without features is exactly the label's quantile.

    Rows with a missing, NaN or infinite value are left out; no line without any row. A constant
    feature gets slope 0; of features that say the same, the shortest vector of slopes is taken.
    """
    if any(not 0 < q < 1 for q in probabilities):
        raise ValueError("a quantile lies between 0 and 1")
    values = [F.col(quoted(c)).cast("double") for c in (label, *features)]
    finite = F.lit(True)
    for v in values:
        finite = finite & (F.abs(v) < F.lit(float("inf")))
    own = [f"_x{i}" for i in range(len(values))]
    rows = stage(df.where(finite).select(*[v.alias(o) for v, o in zip(values, own, strict=True)]), "quantile-rows")
    moments = [f(o) for o in own for f in (F.avg, F.stddev_pop)]
    count, *found = rows.agg(F.count(F.lit(1)), *moments).first()
    if not count:
        return []
    means, spreads = np.array(found[::2], float), np.array(found[1::2], float)
    # A spread of rounding errors alone is none.
    spreads = np.where(spreads > 1e-12 * np.abs(means), spreads, 0.0)
    slopes, used = np.zeros((len(probabilities), len(features))), np.zeros(len(probabilities), int)
    live = [i for i in range(1, len(own)) if spreads[i] > 0]
    if live and spreads[0] > 0:
        scaled = [((F.col(own[i]) - float(means[i])) / float(spreads[i])).alias(own[i]) for i in [0, *live]]
        moved, used = _rounds(
            rows.select(*scaled), own[0], [own[i] for i in live], probabilities, rounds, tolerance, smoothing
        )
        slopes[:, [i - 1 for i in live]] = moved * spreads[0] / spreads[live]
    left = [F.col(own[0]) - _line(own[1:], own_slopes) for own_slopes in slopes]
    names = [f"left{i}" for i in range(len(left))]
    wanted = {name: [q] for name, q in zip(names, probabilities, strict=True)}
    intercepts = quantiles_of(rows.select(*[c.alias(n) for c, n in zip(left, names, strict=True)]), wanted)
    return [
        QuantileLine(q, tuple(features), float(intercepts[name][0]), tuple(map(float, line)), int(n))
        for q, name, line, n in zip(probabilities, names, slopes, used, strict=True)
    ]


def _rounds(
    rows: DataFrame,
    label: str,
    features: list[str],
    probabilities: Sequence[float],
    rounds: int,
    tolerance: float,
    smoothing: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the standardised features for each quantile, and the rounds each used."""
    design = [F.lit(1.0), *[F.col(f) for f in features]]
    y = F.col(label)
    size = len(design)
    upper = np.triu_indices(size)
    count, *sums = rows.agg(F.count(F.lit(1)), *[F.sum(f) for f in features]).first()
    plain = np.array([count, *sums], float)
    at = np.zeros((len(probabilities), size))
    used = np.zeros(len(probabilities), int)
    open_ones = list(range(len(probabilities)))
    for _ in range(rounds):
        weights = {
            f"_w{i}": 1.0 / (smoothing + F.abs(y - F.lit(float(at[i, 0])) - _line(features, at[i, 1:])))
            for i in open_ones
        }
        parts = []
        for name in weights:
            w = F.col(name)
            parts += [F.sum(w * design[a] * design[b]) for a, b in zip(*upper, strict=True)]
            parts += [F.sum(w * d * y) for d in design]
        answers = np.array(rows.withColumns(weights).agg(*parts).first(), float).reshape(len(open_ones), -1)
        for i, answer in zip(list(open_ones), answers, strict=True):
            gram = np.zeros((size, size))
            gram[upper] = answer[:-size]
            gram = gram + np.triu(gram, 1).T
            new = np.linalg.lstsq(gram, answer[-size:] + (2 * probabilities[i] - 1) * plain, rcond=1e-12)[0]
            used[i] += 1
            if np.abs(new - at[i]).max() <= tolerance:
                open_ones.remove(i)
            at[i] = new
        if not open_ones:
            break
    return at[:, 1:], used
