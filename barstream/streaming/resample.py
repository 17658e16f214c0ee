"""Coarser bars from a stream, kept in state until their window can get no more rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.queries import resample_bars
from ..sinks.starting import stream_writer


def resample_stream(
    bars: DataFrame,
    path: str,
    *,
    to: str = "1Hour",
    watermark: str = "1 hour",
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Append each window's bar to the Parquet directory ``path`` once, when it closes.

    State is one row per symbol and open window.  The mark is the largest time seen in
    earlier micro-batches less ``watermark``.  A window closes when the mark passes its
    end, and its row is written after the micro-batch in which it does.  A late bar
    still counts in the micro-batch that closes its window; later ones are dropped,
    and progress tells their number (``late_rows``).  The file sink commits by batch,
    so a batch repeated after a failure gives its windows once.
    """
    if not bars.isStreaming:
        raise ValueError("resample_stream takes a stream; use resample_bars for a table")
    coarse = resample_bars(bars, to, watermark)
    return stream_writer(coarse, checkpoint, trigger).format("parquet").option("path", path).start()


def late_rows(progress) -> int:
    """Rows a micro-batch dropped behind the watermark, as partly aggregated by its tasks."""
    return sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
