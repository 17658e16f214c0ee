"""Compares registered queries with their SQL on DuckDB.

``python -m tests.parity <sf_dir> [query ...]`` prints one line per query.  Session
settings can be given as ``PARITY_CONF=key=value,key=value``.
"""

from __future__ import annotations

import os
import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type of the same column.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, sql: str, connection) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty if nothing does."""
    result = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    problems = []
    mine = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if mine != types:
        problems.append(f"columns {mine} != {types}")
    if sorted(mine) != sorted(types):
        return problems
    names = list(types)
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    right = _rows(names, expected)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows != {len(right)}")
    for a, b in zip(left, right):
        if a != b:
            problems.append(f"{a} != {b}")
            break
    return problems


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as contract

    from tests.conftest import make_session

    spark = make_session()
    for setting in filter(None, os.environ.get("PARITY_CONF", "").split(",")):
        spark.conf.set(*setting.split("="))
    connection = database(sf_dir)
    sql = contract.oracle_sql()
    failed = 0
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sql:
                problems = compare(df, sql[name], connection)
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - reported per query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        state = "FAIL " + " | ".join(problems) if problems else "ok" if name in sql else "ok (rows)"
        print(f"{name:32} {time.time() - started:6.2f}s {state}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
