"""The raw archive: message values as gzip JSON lines, in objects of consecutive offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.batching import RECORDS_PER_OBJECT, archive_chunks
from .starting import stream_writer

#: How often a stream rolls its archive files.
ROLL_INTERVAL = "60 seconds"
_PLACE = ("topic", "partition")
_OBJECT = (*_PLACE, "start_offset")


def write_archive(
    messages: DataFrame,
    path: str,
    *,
    max_records: int = RECORDS_PER_OBJECT,
    checkpoint: str | None = None,
    trigger: str | None = ROLL_INTERVAL,
) -> StreamingQuery | None:
    """Archive the message values, in one file per object that ``archive_manifest`` lists.

    An object holds up to ``max_records`` consecutive records of a topic partition and
    lies in a directory named by its first offset.  A batch is appended.  A stream also
    ends its objects with each micro-batch and overwrites them by name, so that a
    micro-batch that is repeated after a failure is archived once.
    """
    if not messages.isStreaming:
        _write(archive_chunks(messages, max_records), path, "append")
        return None

    # Numbered like a batch: after a long stop a topic partition is spread over many tasks.
    def archive(batch: DataFrame, batch_id: int) -> None:
        _write(archive_chunks(batch, max_records), path, "overwrite")

    return stream_writer(messages, checkpoint, trigger).foreachBatch(archive).start()


def _write(chunked: DataFrame, path: str, mode: str) -> None:
    # The window brings each chunk, of bounded size, into one task and so into one file.
    first = F.min("offset").over(Window.partitionBy(*_PLACE, "chunk"))
    lines = (
        chunked.withColumn("start_offset", first)
        .sortWithinPartitions(*_OBJECT, "offset")
        .select(*_OBJECT, F.col("value").cast("string").alias("value"))
    )
    layout = {"compression": "gzip", "partitionOverwriteMode": "dynamic"}
    lines.write.partitionBy(*_OBJECT).options(**layout).mode(mode).text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived messages: ``value``, ``topic``, ``partition`` and their object's ``start_offset``."""
    lines = spark.read.schema(
        "value string, topic string, partition string, start_offset string"
    ).text(path)
    return lines.withColumns(
        {
            "partition": F.col("partition").cast("int"),
            "start_offset": F.col("start_offset").cast("bigint"),
        }
    )
