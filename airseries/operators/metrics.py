"""Regression and classification metrics as aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.operators.columns import quoted


def _regression(label: str, prediction: str) -> dict[str, Column]:
    """n, rmse, mae and r2 over the rows that hold both the label and the prediction."""
    y = F.col(quoted(label)).cast("double")
    p = F.col(quoted(prediction)).cast("double")
    # The error is null where either is, and the aggregates pass over nulls.
    error = y - p
    squared = F.avg(F.pow(error, F.lit(2)))
    spread = F.var_pop(F.when(p.isNotNull(), y))
    return {
        "n": F.count(error),
        "rmse": F.sqrt(squared),
        "mae": F.avg(F.abs(error)),
        "r2": F.lit(1.0) - F.try_divide(squared, spread),
    }


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """n, rmse, mae and r2 in one pass, in all or per group (for example per split).

    Rows without label or prediction are left out. r2 is null for a constant label.
    """
    parts = [c.alias(name) for name, c in _regression(label, prediction).items()]
    return df.groupBy(*[F.col(quoted(c)) for c in by]).agg(*parts)


def forecast_metrics(
    df: DataFrame, label: str, prediction: str, now: str, by: Sequence[str] = ()
) -> DataFrame:
    """``regression_metrics``, and two of forecasts: mape and direction, in the same pass.

    mape is the mean error relative to the label, over labels other than zero. direction is the
    share of rows where forecast and label lie on the same side of the current value ``now``
    (or both on it), over the rows that hold all three.
    """
    y = F.col(quoted(label)).cast("double")
    p = F.col(quoted(prediction)).cast("double")
    x = F.col(quoted(now)).cast("double")
    same = F.sign(y - x) == F.sign(p - x)
    parts = _regression(label, prediction) | {
        "mape": F.avg(F.try_divide(F.abs(y - p), F.abs(y))),
        "direction": F.avg(same.cast("double")),
    }
    return df.groupBy(*[F.col(quoted(c)) for c in by]).agg(*[c.alias(name) for name, c in parts.items()])


def pinball_loss(
    df: DataFrame, label: str, predictions: Mapping[float, str], by: Sequence[str] = ()
) -> DataFrame:
    """One row per quantile (and group): n, mean pinball loss and share of labels at or below the forecast.

    ``predictions`` names the column that forecasts each quantile; all come from one pass.
    Rows without label or forecast are left out.
    """
    y = F.col(quoted(label)).cast("double")
    rows = []
    for q, name in predictions.items():
        error = y - F.col(quoted(name)).cast("double")
        rows.append(
            F.struct(
                F.lit(float(q)).alias("quantile"),
                F.count(error).alias("n"),
                F.avg(F.greatest(q * error, (q - 1) * error)).alias("loss"),
                F.avg((error <= 0).cast("double")).alias("covered"),
            )
        )
    groups = [F.col(quoted(c)) for c in by]
    return df.groupBy(*groups).agg(F.array(*rows).alias("_rows")).select(*groups, F.inline("_rows"))


def error_cube(
    df: DataFrame, label: str, prediction: str, dims: Sequence[str]
) -> DataFrame:
    """Errors by every combination of the dimensions, each subtotal and the total.

    Rows first become one row of moments per cell (count, sums of error, absolute and squared
    error, largest error); all subtotals are merged from the cells, so the rows are read and
    shuffled once, already summed. ``<dim>_all`` tells a subtotal over a dimension from a
    cell whose value is null. Rows without label or prediction are left out.
    """
    error = F.col(quoted(label)).cast("double") - F.col(quoted(prediction)).cast("double")
    columns = [F.col(quoted(d)) for d in dims]
    cells = (
        df.select(*columns, error.alias("_e"))
        .where(F.col("_e").isNotNull())
        .groupBy(*columns)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("_e").alias("_sum"),
            F.sum(F.abs("_e")).alias("_abs"),
            F.sum(F.col("_e") * F.col("_e")).alias("_square"),
            F.max(F.abs("_e")).alias("_max"),
        )
    )
    n = F.sum("_n")
    return cells.cube(*columns).agg(
        *[(F.grouping(quoted(d)) == 1).alias(f"{d}_all") for d in dims],
        n.alias("n"),
        (F.sum("_sum") / n).alias("bias"),
        (F.sum("_abs") / n).alias("mae"),
        F.sqrt(F.sum("_square") / n).alias("rmse"),
        F.max("_max").alias("worst"),
    )


def compare_predictions(
    df: DataFrame,
    label: str,
    predictions: Mapping[str, str],
    by: Sequence[str] = (),
    order_by: str = "rmse",
    ascending: bool = True,
) -> DataFrame:
    """One row per model (and group): metrics of several prediction columns in one pass, best first."""
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            *[c.alias(m) for m, c in _regression(label, column).items()],
        )
        for name, column in predictions.items()
    ]
    groups = [F.col(quoted(c)) for c in by]
    key = F.asc(order_by) if ascending else F.desc(order_by)
    return (
        df.groupBy(*groups)
        .agg(F.array(*rows).alias("_rows"))
        .select(*groups, F.inline("_rows"))
        .orderBy(*groups, key, "model")
    )


def confusion_counts(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per pair of label and prediction, as ``actual``, ``predicted``, ``n``."""
    return df.groupBy(
        *[F.col(quoted(c)) for c in by],
        F.col(quoted(label)).alias("actual"),
        F.col(quoted(prediction)).alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_long(
    df: DataFrame, label: str, prediction: str, classes: Sequence[Any]
) -> DataFrame:
    """Every pair of the listed classes and ``OTHER`` with its count, zero included.

    ``OTHER`` (null where classes are not text) stands for all other labels,
    predictions and nulls, so the counts add up to the rows.
    """
    cells = [(a, p) for a in range(len(classes) + 1) for p in range(len(classes) + 1)]
    row = _confusion_row(df, label, prediction, classes, cells)
    shown = [*classes, _other(classes)]
    pairs = [
        F.struct(
            _shown(shown[a], classes).alias("actual"),
            _shown(shown[p], classes).alias("predicted"),
            F.col(f"n_{a}_{p}").alias("n"),
        )
        for a, p in cells
    ]
    return row.select(F.inline(F.array(*pairs)))


#: What stands for labels that are not listed.
OTHER = "other"


def _other(classes: Sequence[Any]) -> str | None:
    return OTHER if all(isinstance(c, str) for c in classes) else None


def _shown(value: Any, classes: Sequence[Any]) -> Column:
    """The value as a column; a null of the classes' type for None."""
    return F.when(F.lit(False), F.lit(classes[0])) if value is None else F.lit(value)


def _place(name: str, classes: Sequence[Any]) -> Column:
    """Position of the value among the classes; one past the last for all else."""
    c = F.col(quoted(name))
    place = F.lit(len(classes))
    for i, one in reversed(list(enumerate(classes))):
        place = F.when(c == F.lit(one), i).otherwise(place)
    return place


def _confusion_row(
    df: DataFrame, label: str, prediction: str, classes: Sequence[Any], cells: list[tuple[int, int]]
) -> DataFrame:
    """One row with the count of every cell, from one aggregate."""
    placed = df.select(_place(label, classes).alias("a"), _place(prediction, classes).alias("p"))
    return placed.agg(
        *[F.count_if((F.col("a") == a) & (F.col("p") == p)).alias(f"n_{a}_{p}") for a, p in cells]
    )


def confusion_matrix(
    df: DataFrame,
    label: str,
    prediction: str,
    classes: Sequence[Any],
    names: Mapping[Any, str] | None = None,
) -> DataFrame:
    """One row per class in the listed order and one for all else, one ``pred_<class>`` column each.

    The row and the column of labels not listed are called as in ``confusion_long``
    and ``pred_other``; the cells add up to the rows of ``df``.
    """
    names = dict(names or {c: str(c) for c in classes})
    places = range(len(classes) + 1)
    row = _confusion_row(df, label, prediction, classes, [(a, p) for a in places for p in places])
    shown = [*classes, _other(classes)]
    titles = [f"pred_{names[c]}" for c in classes] + [f"pred_{OTHER}"]
    lines = [
        F.struct(
            _shown(shown[a], classes).alias("actual"),
            *[F.col(f"n_{a}_{p}").alias(titles[p]) for p in places],
        )
        for a in places
    ]
    return row.select(F.inline(F.array(*lines)))


def class_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """Per class: actual, predicted and correct rows, precision, recall and F1."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    groups = [F.col(quoted(c)) for c in by]

    def side(name: str, actual: Column, predicted: Column, correct: Column) -> Column:
        return F.struct(
            F.col(name).alias("class"),
            actual.cast("long").alias("actual"),
            predicted.cast("long").alias("predicted"),
            correct.cast("long").alias("correct"),
        )

    sides = F.array(
        side("actual", F.col("n"), F.lit(0), hit),
        side("predicted", F.lit(0), F.col("n"), F.lit(0)),
    )
    sums = (
        confusion_counts(df, label, prediction, by)
        .select(*groups, F.inline(sides))
        .groupBy(*groups, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "correct")])
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("correct"), F.col("predicted")), zero)
    recall = F.coalesce(F.try_divide(F.col("correct"), F.col("actual")), zero)
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        zero,
    )
    return sums.withColumns({"precision": precision, "recall": recall}).withColumn("f1", f1)


def classification_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """n, accuracy, and F1, precision and recall weighted by class size; in all or per group."""
    total = F.sum("actual")

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col("actual") * F.col(name)), total)

    return class_metrics(df, label, prediction, by).groupBy(*[F.col(quoted(c)) for c in by]).agg(
        total.alias("n"),
        F.try_divide(F.sum("correct"), total).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
    )


def compare_models(results: Mapping[str, DataFrame], order_by: str, ascending: bool = True) -> DataFrame:
    """One row per model from metric tables of separate sources, best first."""
    rows = None
    for name, result in results.items():
        named = result.select(F.lit(name).alias("model"), "*")
        rows = named if rows is None else rows.unionByName(named)
    if rows is None:
        raise ValueError("no results to compare")
    key = F.asc(order_by) if ascending else F.desc(order_by)
    return rows.orderBy(key, "model")
