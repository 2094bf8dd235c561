"""Helpers the training-data operators share."""

from __future__ import annotations

import ctypes
import os
import string
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space: \x20 and \x09 to \x0D, which is also what bytes.split() cuts at.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reach_workers(spark: SparkSession) -> None:
    """Let local Python workers import this package from where the driver found it.

    A cluster has the package installed or ships it with the job; there this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def id_of(c: str) -> Column:
    """The id as long; a row without id counts as the document with the smallest id."""
    return F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63)))


def text_key(c: str) -> Column:
    """Hash of a text that is distinct for null; with the id it names a row, equal rows share it."""
    return F.xxhash64(F.col(c).isNull(), F.col(c))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for an operator's own columns that no column of ``df`` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def schema_of(df: DataFrame, keep: Iterable[str], fields: list[tuple[str, str]]) -> T.StructType:
    """The kept columns and then the new fields; a new field replaces a kept column of its name."""
    new = {name for name, _ in fields}
    out = [f for f in df.schema.fields if f.name in set(keep) and f.name not in new]
    made = T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in fields)).fields
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in [*out, *made]])


def map_rows(
    df: DataFrame,
    keep: list[str],
    fields: list[tuple[str, str]],
    make: Callable[[pa.RecordBatch], dict],
) -> DataFrame:
    """Arrow batches through ``make``, one row out for each row in.

    ``make`` gives a list or Arrow array for every field; the columns in ``keep``
    pass through. No shuffle, memory bounded by one batch.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = schema_of(df, keep, fields)
    passed = [f.name for f in schema.fields[: len(schema.fields) - len(fields)]]
    # Names may repeat in a frame with clashing columns, so columns are taken by position.
    places = {name: i for i, name in enumerate(df.columns)}
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = make(batch)
            columns = [batch.column(places[n]) for n in passed] + [made[n] for n, _ in fields]
            yield pa.RecordBatch.from_arrays(
                [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                    for c, f in zip(columns, arrow, strict=True)
                ],
                schema=arrow,
            )

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give what this worker freed back to the system; workers are kept for the next tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; freed memory stays with the worker


def lean(work: Callable) -> Callable:
    """``work`` on one grouped table or a pair of them, with freed memory given back after each group."""

    def done(*tables: pa.Table) -> pa.Table:
        try:
            return work(*tables)
        finally:
            release_memory()

    # Spark counts the arguments to tell what to pass.
    return (lambda table: done(table)) if work.__code__.co_argcount == 1 else (lambda a, b: done(a, b))


def as_bytes(column: pa.Array) -> pa.Array:
    """A string column as bytes without decoding; nulls stay null."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
