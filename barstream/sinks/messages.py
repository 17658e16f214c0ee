"""The message sink: one JSON ``value`` per bar, with its ``key`` when present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .starting import stream_writer


def write_messages(
    df: DataFrame,
    path: str | None = None,
    *,
    brokers: str | None = None,
    topic: str | None = None,
    checkpoint: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery | None:
    """Write messages to a topic or to files; starts a query if ``df`` is a stream.

    Files are written exactly once, a topic at least once.
    """
    if path is None and not (brokers and topic):
        raise ValueError("give path, or brokers and topic")
    if path is not None:
        target, options = "parquet", {"path": path}
    else:
        target, options = "kafka", {"kafka.bootstrap.servers": brokers, "topic": topic}
    if df.isStreaming:
        writer = stream_writer(df, checkpoint, trigger)
        return writer.format(target).options(**options).start()
    df.write.format(target).options(**options).mode("append").save()
    return None
