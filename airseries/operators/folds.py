"""Cross-validation along time, and forecasts over several horizons."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.operators.columns import quoted
from airseries.operators.metrics import forecast_metrics, regression_metrics
from airseries.operators.quantiles import quantiles
from airseries.operators.temporal import ROWS_PER_TILE, RowFrame, lead, with_row_frames
from airseries.session import stage

Predict = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Fold:
    """Training rows lie in [start, cut - gap), tested rows in [cut, end); no start or end: open.

    Times are text, so that no time zone but the session's has a say in them.
    """

    number: int
    start: str | None
    cut: str
    end: str | None
    gap: float = 0.0

    def trains(self, at: Column, kind) -> Column:
        """Whether a row at this time is trained on."""
        before = at < self._time(self.cut, kind) - F.make_dt_interval(secs=F.lit(self.gap))
        return before if self.start is None else before & (at >= self._time(self.start, kind))

    def tests(self, at: Column, kind) -> Column:
        """Whether a row at this time is tested."""
        after = at >= self._time(self.cut, kind)
        return after if self.end is None else after & (at < self._time(self.end, kind))

    @staticmethod
    def _time(text: str, kind) -> Column:
        return F.lit(text).cast(kind)


def time_folds(
    df: DataFrame, ts: str, folds: int = 5, window: int | None = None, gap: float = 0.0
) -> list[Fold]:
    """Folds cut at quantiles of the time, so that each tests about as many rows.

    The time is cut into ``folds + 1`` blocks of about as many rows; fold i tests block i and trains on all blocks
    before it, or on the last ``window`` of them. The last ``gap`` seconds before a cut are
    left out of training: as long as the look-ahead of a target, no trained target lies in the tested block.
    All cuts are found in the same passes over the time column. A time that holds more rows
    than a block makes blocks meet; a fold that would test nothing is left out, and the others keep their numbers.
    Rows without a time are in no fold; a table without times has none.
    """
    if folds < 1 or (window is not None and window < 1) or gap < 0:
        raise ValueError("folds and window are at least 1, gap at least 0")
    cuts = quantiles(df, ts, [i / (folds + 1) for i in range(1, folds + 1)])
    if cuts[0] is None:
        return []
    out = []
    for i, cut in enumerate(cuts):
        start = cuts[i - window] if window is not None and i >= window else None
        end = cuts[i + 1] if i + 1 < len(cuts) else None
        if cut != end:
            out.append(Fold(i + 1, start, cut, end, gap))
    return out


def fold_frames(df: DataFrame, ts: str, fold: Fold) -> tuple[DataFrame, DataFrame]:
    """Training and tested rows of a fold, by comparisons with constants that reach the file scan."""
    at, kind = F.col(quoted(ts)), df.schema[ts].dataType
    return df.filter(fold.trains(at, kind)), df.filter(fold.tests(at, kind))


def in_folds(df: DataFrame, ts: str, folds: Sequence[Fold], fold: str = "fold", role: str = "role") -> DataFrame:
    """Each row once for each fold it takes part in, with the fold's number and ``train`` or ``test``.

    One pass serves all folds; a row is copied at most once a fold.
    """
    at, kind = F.col(quoted(ts)), df.schema[ts].dataType

    def part(f: Fold) -> Column:
        name = F.when(f.trains(at, kind), "train").when(f.tests(at, kind), "test")
        return F.struct(F.lit(f.number).alias(fold), name.alias(role))

    if not folds:
        return df.select("*", F.lit(0).alias(fold), F.lit("").alias(role)).limit(0)
    parts = F.filter(F.array(*[part(f) for f in folds]), lambda p: p[role].isNotNull())
    return df.select("*", F.inline(parts))


def cross_validate(
    df: DataFrame,
    ts: str,
    folds: Sequence[Fold],
    fit: Callable[[DataFrame], Predict],
    label: str,
    prediction: str = "prediction",
) -> DataFrame:
    """n, rmse, mae and r2 of each fold's tested rows, by a model that saw only its training rows.

    ``fit`` takes training rows and gives a function that adds ``prediction`` to others, for example
    ``lambda train: pipeline.fit(train).transform``. The rows are staged once; the
    metrics of all folds come from one aggregate.
    """
    if not folds:
        raise ValueError("no fold to validate on")
    kept = stage(df, "folds")
    tested = []
    for fold in folds:
        train, test = fold_frames(kept, ts, fold)
        scored = fit(train)(test).select(F.col(quoted(label)), F.col(quoted(prediction)))
        tested.append(scored.withColumn("fold", F.lit(fold.number)))
    every = tested[0]
    for scored in tested[1:]:
        every = every.unionByName(scored)
    return regression_metrics(every, label, prediction, ["fold"])


def group_means(label: str, by: Sequence[str], prediction: str = "prediction") -> Callable[[DataFrame], Predict]:
    """A model for ``cross_validate``: the mean label of the training rows of a group; null for unseen groups."""

    def fit(train: DataFrame) -> Predict:
        means = train.groupBy(*[F.col(quoted(c)) for c in by]).agg(F.avg(quoted(label)).alias(prediction))
        return lambda test: test.join(means, list(by), "left")

    return fit


def with_horizons(
    df: DataFrame,
    value: str,
    horizons: Sequence[int],
    order: Sequence[str],
    by: Sequence[str] = (),
    frames: dict[str, RowFrame] | None = None,
    rows_per_tile: int = ROWS_PER_TILE,
) -> DataFrame:
    """Adds ``<value>_in_<k>``, the value k rows ahead, for each horizon; null where the series ends before.

    Other ``frames`` (look-backs as features) share the sort. Rows that look over the end of a sorted tile meet the
    rows behind it; see ``with_row_frames``.
    """
    if min(horizons, default=1) < 1:
        raise ValueError("a horizon is at least one row")
    targets = {f"{value}_in_{k}": lead(value, k) for k in horizons}
    return with_row_frames(df, targets | (frames or {}), order, by, rows_per_tile)


def horizon_metrics(
    df: DataFrame, value: str, horizons: Sequence[int], prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per horizon (and group): how well a column says the value that many rows ahead.

    ``df`` has the columns of ``with_horizons``. All horizons come from one pass; ``direction`` is the share of
    forecasts on the right side of the current value.
    """
    at = F.inline(
        F.array(*[F.struct(F.lit(k).alias("horizon"), F.col(quoted(f"{value}_in_{k}")).alias("_target")) for k in horizons])
    )
    groups = [F.col(quoted(c)) for c in by]
    long = df.select(*groups, F.col(quoted(value)).alias("_now"), F.col(quoted(prediction)).alias("_said"), at)
    return forecast_metrics(long, "_target", "_said", "_now", [*by, "horizon"])
