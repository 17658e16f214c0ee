"""Flow counters taken while the data passes, without a pass of their own."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.flatten import explode_bars, parsed_bars

# The counters of a flow.
COUNTERS = ("messages_received", "messages_sent", "errors")
LAST_TIME = "last_message_time"

PARSED = "bars"


def flow_counters():
    """The counters as aggregates over parsed messages.

    Received are all messages, errors those that cannot be read, sent the bars
    that go on.
    """
    return [
        F.count(F.lit(1)).alias("messages_received"),
        F.coalesce(F.sum(F.when(F.col(PARSED).isNotNull(), F.size(PARSED))), F.lit(0)).alias(
            "messages_sent"
        ),
        F.count_if(F.col(PARSED).isNull()).alias("errors"),
        F.max("timestamp").alias(LAST_TIME),
    ]


def observe_flow(
    messages: DataFrame,
    observation: Observation | str = "flow",
    mode: str = "permissive",
    typed_time: bool = True,
) -> DataFrame:
    """Flatten messages and count them on the way.

    The counts are read from ``observation`` after a batch action, or from a
    query's progress under the given name on a stream.  The JSON is parsed once
    for both.
    """
    parsed = messages.withColumn(PARSED, parsed_bars(mode))
    counted = parsed.observe(observation, *flow_counters())
    return explode_bars(counted, F.col(PARSED), typed_time=typed_time)


class FlowMetrics(StreamingQueryListener):
    """Running totals of a stream's flow counters.

    Register it with ``spark.streams.addListener``; or feed it progress by hand
    with ``add``.
    """

    def __init__(self, name: str = "flow"):
        self.name = name
        self.connected = False
        self.last_message_time = None
        self.rows_per_second = 0.0
        self.batches = 0
        self.totals = dict.fromkeys(COUNTERS, 0)
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def add(self, progress) -> None:
        self.rows_per_second = progress.processedRowsPerSecond
        row = progress.observedMetrics.get(self.name)
        if row is None:
            return
        self.batches += 1
        for counter in COUNTERS:
            self.totals[counter] += row[counter]
        if row[LAST_TIME] is not None:
            self.last_message_time = max(filter(None, (self.last_message_time, row[LAST_TIME])))

    def snapshot(self) -> dict:
        return {
            **self.totals,
            LAST_TIME: self.last_message_time,
            "connection_status": self.connected,
        }

    def onQueryStarted(self, event) -> None:
        self.connected = True

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.connected = False
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def drain(self, running: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait for the query's end and for the last of its events.

        Events arrive in order and later than the query's end: once the event of the
        end is here, so is every batch's progress.
        """
        running.awaitTermination()
        with self._change:
            if not self._change.wait_for(lambda: str(running.runId) in self._ended, timeout):
                raise TimeoutError(f"no end of query {running.runId} within {timeout} s")


@contextmanager
def listening(spark: SparkSession, name: str = "flow") -> Iterator[FlowMetrics]:
    """A listener on the session's streams for as long as the block runs.

    It counts every batch, where a query's own ``recentProgress`` keeps the last 100.
    """
    metrics = FlowMetrics(name)
    spark.streams.addListener(metrics)
    try:
        yield metrics
    finally:
        spark.streams.removeListener(metrics)
