"""Console output for looking at a flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .starting import stream_writer


def write_console(df: DataFrame, trigger: str | None = None) -> StreamingQuery:
    """Print a stream's rows untruncated."""
    return stream_writer(df, None, trigger).format("console").option("truncate", "false").start()
