"""Samples and train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airseries.operators.columns import quoted
from airseries.operators.ordering import INDEX, index_tiles, sorted_tiles
from airseries.operators.quantiles import quantiles

# Multiplicative hash of an integer key. The key is first reduced
# below 2^31, so the product fits a bigint for any key.
_KEY_RANGE = 2147483647
_MULTIPLIER = 2654435761
_HASH_RANGE = 4294967296


def hash_unit(key: str | Column) -> Column:
    """A number in [0, 1) that depends on the integer key alone."""
    k = (F.col(quoted(key)) if isinstance(key, str) else key).cast("long")
    mixed = F.pmod(F.pmod(k, F.lit(_KEY_RANGE)) * F.lit(_MULTIPLIER), F.lit(_HASH_RANGE))
    return mixed / F.lit(float(_HASH_RANGE))


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Rows whose key hashes below ``fraction``: the same rows on every run and layout."""
    return df.filter(hash_unit(key) < fraction)


def hash_split(df: DataFrame, key: str, train: float = 0.8, out: str = "split") -> DataFrame:
    """Adds ``train`` or ``test`` by the hash of the key."""
    return df.withColumn(out, F.when(hash_unit(key) < train, "train").otherwise("test"))


def bernoulli_sample(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Independent draws without replacement; depends on the data's partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """Random parts by weight; depends on the data's partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def time_cut(df: DataFrame, ts: str, q: float = 0.8) -> str | None:
    """The q-quantile of the time, exact.

    Text, so that no time zone but the session's has a say in it.
    """
    return quantiles(df, ts, [q])[0]


def cut_frames(df: DataFrame, ts: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut and rows from it on, by comparisons that reach the file scan."""
    limit = F.lit(cut).cast(df.schema[ts].dataType)
    return df.filter(F.col(quoted(ts)) < limit), df.filter(F.col(quoted(ts)) >= limit)


def temporal_split(
    df: DataFrame, ts: str, q: float = 0.8, out: str = "split", cut: str | None = None
) -> DataFrame:
    """Adds ``train`` before the q-quantile of the time and ``test`` from it on.

    The quantile is found at once, in passes over the time column only, unless
    ``cut`` gives it. Where ``df`` is not a plain table, stage it first.
    """
    at = time_cut(df, ts, q) if cut is None else cut
    before = F.col(quoted(ts)) < F.lit(at).cast(df.schema[ts].dataType)
    return df.withColumn(out, F.when(before, "train").otherwise("test"))


def positional_split(
    df: DataFrame, order: Sequence[str], q: float = 0.8, out: str = "split"
) -> DataFrame:
    """Adds ``train`` to exactly the first ``floor(q * rows)`` rows of a unique order."""
    tiles = sorted_tiles(df, order)
    rows = tiles.agg(F.count(F.lit(1)).alias("n")).scalar()
    train = F.col(INDEX) < F.floor(F.lit(q) * rows)
    return (
        index_tiles(tiles).withColumn(out, F.when(train, "train").otherwise("test")).drop(INDEX)
    )
