"""The catalogue of queries with the SQL that says the same."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The bars of ``tables.bars`` in SQL.
BARS_SQL = """bars AS (
  SELECT event_id, 'b' AS bar_type, event_type AS symbol, value AS open, value + 1.0 AS high,
         value - 1.0 AS low, value AS close, user_id AS volume, ts AS bar_time,
         CAST(json_extract(props, '$.k') AS BIGINT) AS trade_count, value AS vwap
  FROM events)"""

COLUMNS_SQL = "bar_type, symbol, open, high, low, close, volume, bar_time, trade_count, vwap"
KEYED_SQL = f"CAST(event_id // 100 AS VARCHAR) AS key, {COLUMNS_SQL}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may refer to the relation ``bars``."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            needs = re.search(r"FROM\s+bars\b", sql) and not sql.startswith("WITH")
            ORACLES[name] = f"WITH {BARS_SQL} {sql}" if needs else sql
        return function

    return register
