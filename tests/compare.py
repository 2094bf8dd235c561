"""Run queries and their SQL twins side by side; also usable as a script."""

from __future__ import annotations

import datetime
import math
import sys
import time
from typing import Any

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def norm(v: Any) -> Any:
    if v is None:
        return ("null",)
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(v + 0.0))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, datetime.datetime):
        return ("t", v.isoformat())
    return ("s", str(v))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    rows = sorted(tuple(norm(r[i]) for i in order) for r in df.collect())
    return [df.columns[i] for i in order], rows


# Types the two engines call differently.
SAME_TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "int": "INTEGER",
}


def type_difference(df, con, sql: str) -> str | None:
    """None if the columns have the same types, else what differs."""
    want = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    have = {f.name: SAME_TYPES.get(f.dataType.simpleString(), "?") for f in df.schema}
    bad = {c: (have.get(c), want.get(c)) for c in {*have, *want} if have.get(c) != want.get(c)}
    return f"types {bad}" if bad else None


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(norm(r[i]) for i in order) for r in cur.fetchall())
    return [names[i] for i in order], rows


def difference(left: tuple, right: tuple) -> str | None:
    """None if equal, else what differs."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from airseries.session import local_session

    sf = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark, con, sql = local_session(), duck(sf), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = fn(spark, sf)
            got = spark_rows(df)
            took = time.time() - started
            state = f"{len(got[1])} rows only"
            if name in sql:
                diff = difference(got, duck_rows(con, sql[name])) or type_difference(
                    df, con, sql[name]
                )
                state = "ok" if diff is None else f"DIFFERS {diff}"
                bad += diff is not None
                state += f" ({len(got[1])} rows)"
        except Exception as e:  # noqa: BLE001
            took, bad = time.time() - started, bad + 1
            state = f"FAILS {type(e).__name__} {str(e)[:600]}"
        print(f"{name:28s} {took:6.2f}s {state}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
