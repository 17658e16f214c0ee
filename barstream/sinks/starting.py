"""The parts every streaming writer shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

#: Trigger that takes everything there is and then ends.
AVAILABLE_NOW = "available-now"


def stream_writer(
    df: DataFrame, checkpoint: str | None, trigger: str | None, name: str | None = None
) -> DataStreamWriter:
    """An append writer with its own checkpoint.

    ``trigger`` is an interval such as ``1 minute``, ``available-now``, or None
    for micro-batches as fast as they can follow each other.
    """
    writer = df.writeStream.outputMode("append")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    if trigger is not None:
        return writer.trigger(processingTime=trigger)
    return writer
