"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is left out where plain SQL cannot say the same."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r6(c: Column | str, name: str | None = None) -> Column:
    """Double rounded to six places for comparison; the shift keeps exact halves off the edge."""
    x = F.col(c) if isinstance(c, str) else c
    out = F.round(x.cast("double") + F.lit(1e-9), 6)
    label = name or (c if isinstance(c, str) else None)
    return out.alias(label) if label else out


def big(c: Column | str, name: str | None = None) -> Column:
    """As bigint, the integer type both engines agree on."""
    x = F.col(c) if isinstance(c, str) else c
    label = name or (c if isinstance(c, str) else None)
    out = x.cast("long")
    return out.alias(label) if label else out


def rounded(df: DataFrame) -> DataFrame:
    """All doubles through ``r6``, all integers as bigint."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        quoted = F.col("`" + f.name + "`")
        if kind in ("double", "float"):
            out.append(r6(quoted, f.name))
        elif kind in ("int", "smallint", "tinyint"):
            out.append(big(quoted, f.name))
        else:
            out.append(quoted)
    return df.select(*out)
