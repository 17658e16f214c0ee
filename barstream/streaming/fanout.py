"""The flattening job: one source, a message sink and a raw table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.flatten import flatten_messages
from ..operators.wire import to_wire
from ..schema import TIME_FIELD
from ..sinks import write_console, write_messages, write_raw
from ..sinks.lake import RAW_INTERVAL
from ..sinks.starting import AVAILABLE_NOW, stream_writer

# The output modes and the sinks each one feeds.
OUTPUT_MODES = {
    "both": ("messages", "raw"),
    "kafka-only": ("messages",),
    "iceberg-only": ("raw",),
    "console-debug": ("console",),
}


@dataclass(frozen=True)
class Outputs:
    """Where the sinks write.  A target is a directory, or else a topic or table."""

    checkpoint: str
    messages_path: str | None = None
    brokers: str | None = None
    topic: str | None = None
    raw_path: str | None = None
    raw_table: str | None = None
    raw_format: str = "parquet"


def start_pipeline(
    source: DataFrame,
    outputs: str,
    targets: Outputs,
    *,
    mode: str = "permissive",
    time_field: str = TIME_FIELD,
    keep_nulls: bool = False,
    trigger: str | None = None,
    raw_trigger: str | None = RAW_INTERVAL,
) -> list[StreamingQuery]:
    """Start one query per sink of the output mode, each with its own checkpoint.

    The message sink gets one JSON message per bar, the raw table the source
    records as they came.  Both are append-only and stateless.
    """
    if outputs not in OUTPUT_MODES:
        raise ValueError(f"output mode must be one of {sorted(OUTPUT_MODES)}, not {outputs!r}")
    sinks = OUTPUT_MODES[outputs]
    flat = to_wire(flatten_messages(source, mode, typed_time=False), time_field, keep_nulls)
    queries = []
    if "messages" in sinks:
        queries.append(
            write_messages(
                flat,
                targets.messages_path,
                brokers=targets.brokers,
                topic=targets.topic,
                checkpoint=f"{targets.checkpoint}/messages",
                trigger=trigger,
            )
        )
    if "raw" in sinks:
        queries.append(
            write_raw(
                source,
                targets.raw_path,
                table=targets.raw_table,
                table_format=targets.raw_format,
                checkpoint=f"{targets.checkpoint}/raw",
                trigger=raw_trigger,
            )
        )
    if "console" in sinks:
        queries.append(write_console(flat, trigger))
    return queries


def start_once(
    source: DataFrame,
    targets: Outputs,
    *,
    mode: str = "permissive",
    time_field: str = TIME_FIELD,
    keep_nulls: bool = False,
    trigger: str | None = None,
) -> StreamingQuery:
    """Both sinks of the job from one read of the source, as one query.

    A micro-batch is read once and stored as the raw table's part
    (``batch_id=N``); the message sink's part is made from that.  Both overwrite what
    an earlier attempt at the batch has left, so each batch counts once in either
    sink.  The two ``start_pipeline`` queries read and parse the source each, but
    can run at paces of their own.  Takes paths, not topics or tables.
    """
    if targets.raw_path is None or targets.messages_path is None:
        raise ValueError("give raw_path and messages_path")

    def store(batch: DataFrame, batch_id: int) -> None:
        raw = f"{targets.raw_path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(raw)
        kept = batch.sparkSession.read.schema(batch.schema).parquet(raw)
        flat = to_wire(flatten_messages(kept, mode, typed_time=False), time_field, keep_nulls)
        flat.write.mode("overwrite").parquet(f"{targets.messages_path}/batch_id={batch_id}")

    return stream_writer(source, targets.checkpoint, trigger).foreachBatch(store).start()


def await_queries(
    spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None
) -> bool:
    """Wait until any query ends, then stop the others; True if one ended.

    A query that fails raises its error here, after the others are stopped.
    """
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
            return True
        return bool(spark.streams.awaitAnyTermination(timeout))
    finally:
        stop_all(queries)


def stop_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def run_pipeline(source: DataFrame, outputs: str, targets: Outputs, **settings) -> None:
    """Start the job and stay until it ends.

    With the ``available-now`` trigger every query finishes its backlog by itself;
    otherwise the job runs until one of its queries ends.
    """
    spark = source.sparkSession
    spark.streams.resetTerminated()
    finite = settings.get("trigger") == AVAILABLE_NOW
    if finite:
        settings.setdefault("raw_trigger", AVAILABLE_NOW)
    queries = start_pipeline(source, outputs, targets, **settings)
    if not finite:
        await_queries(spark, queries)
        return
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop_all(queries)
