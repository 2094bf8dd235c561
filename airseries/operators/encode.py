"""One-hot columns, label indexing and feature vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.operators.columns import quoted


def one_hot(
    df: DataFrame,
    name: str,
    values: Sequence[str],
    prefix: str,
    naming: Callable[[str], str] = str,
) -> DataFrame:
    """One 0/1 column ``<prefix>_<value>`` per listed value; others and null give 0 in all."""
    c = F.col(quoted(name))
    return df.withColumns(
        {f"{prefix}_{naming(v)}": F.when(c == v, 1).otherwise(0) for v in values}
    )


def label_indexer(
    name: str, out: str = "label", alphabetical: bool = False, unseen: str = "keep"
) -> StringIndexer:
    """Indexer by frequency (ties alphabetical) or alphabetically; unseen labels get an extra index."""
    order = "alphabetAsc" if alphabetical else "frequencyDesc"
    return StringIndexer(
        inputCol=name, outputCol=out, stringOrderType=order, handleInvalid=unseen
    )


def label_names(index: str, out: str, labels: Sequence[str]) -> IndexToString:
    """Index back to label, with the names the fitted indexer holds."""
    return IndexToString(inputCol=index, outputCol=out, labels=list(labels))


def assemble(
    df: DataFrame, columns: Sequence[str], out: str = "features", missing: str = "error"
) -> DataFrame:
    """Feature vector; ``missing`` is ``error`` (null is refused) or ``zero`` (null counts as 0.0)."""
    if missing == "error":
        return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)
    if missing != "zero":
        raise ValueError("missing must be 'error' or 'zero'")
    values = [F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for c in columns]
    return df.withColumn(out, array_to_vector(F.array(*values)))
