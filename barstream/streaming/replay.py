"""Paced replay of history as messages, in order."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..sinks.starting import stream_writer

# Fixed value: seconds between two replayed messages.
REPLAY_INTERVAL = "10 seconds"

#: The place of a message in the replay, from 0, and the turn it belongs to.
NUMBER = "message_number"
TURN = "turn"


def stage_replay(messages: DataFrame, path: str) -> None:
    """Number the messages by offset, then partition, and store them in that order.

    Files have ordinary sizes and hold neighbouring numbers, so that a turn of the
    replay reads only the row groups its numbers lie in.
    """
    numbered = number_rows(messages, ["offset", "partition"], name=NUMBER)
    numbered.repartitionByRange(NUMBER).sortWithinPartitions(NUMBER).write.parquet(path)


def replay_messages(
    spark: SparkSession,
    path: str,
    send: Callable[[DataFrame, int], None],
    *,
    checkpoint: str,
    messages_per_trigger: int = 1,
    trigger: str | None = REPLAY_INTERVAL,
    turns_at_once: int = 1,
) -> None:
    """Send the staged messages in order, some at each trigger, and return after the last.

    ``send`` gets the messages of a turn, sorted by ``NUMBER``, and the turn's number.  A
    replay that was stopped goes on from its checkpoint; a turn that had begun is
    sent again under the same number, so a sink that overwrites by it counts it once.

    A turn that is a micro-batch of its own costs a second or so, whatever it holds.  A
    replay that keeps no pace can send ``turns_at_once`` whole turns in a micro-batch:
    ``send`` then gets their messages with each one's ``TURN``, and the number of the
    micro-batch.
    """
    if turns_at_once < 1:
        raise ValueError("turns_at_once must be at least 1")
    if turns_at_once > 1 and trigger is not None:
        raise ValueError("a paced replay sends one turn at a trigger")
    messages = spark.read.parquet(path)
    if turns_at_once > 1:
        messages = messages.withColumn(TURN, F.expr(f"{NUMBER} div {messages_per_trigger}"))
    last = messages.agg(F.max(NUMBER)).first()[0]
    if last is None:
        return
    finished = threading.Event()

    def turn(numbers: DataFrame, turn_number: int) -> None:
        span = numbers.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
        if span.low is None:
            return
        if span.low <= last:
            send(messages.where(F.col(NUMBER).between(*span)).orderBy(NUMBER), turn_number)
        if span.high >= last:
            finished.set()

    numbers = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", messages_per_trigger * turns_at_once)
        .option("numPartitions", 1)
        .load()
    )
    running = stream_writer(numbers, checkpoint, trigger).foreachBatch(turn).start()
    while not finished.is_set():
        if running.awaitTermination(0.2):  # raises what made the stream fail
            return
    running.stop()
