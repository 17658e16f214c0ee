"""A continuously refreshed report: the number of bars and the latest ten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.queries import LATEST_COLUMNS, latest_bars, total_events
from ..operators.wire import as_ticks
from ..sinks.starting import stream_writer

#: How often the report is refreshed.
REFRESH_INTERVAL = "60 seconds"

_TOTAL = "total bigint, batch_id bigint"
_LATEST = (
    "symbol string, open double, high double, low double, close double, volume bigint, "
    "bar_time timestamp_ntz, batch_id bigint"
)


def dashboard_stream(
    bars: DataFrame,
    path: str,
    *,
    checkpoint: str,
    trigger: str | None = REFRESH_INTERVAL,
) -> StreamingQuery:
    """Append a stream of bars to a tick table and keep its report up to date.

    Each micro-batch adds its own rows to the report of the batch before it, so a
    refresh costs as much as the new data and not as the whole table.  Every
    batch writes to directories named after its id and overwrites them, so a
    batch that is repeated after a failure counts once.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        ticks = as_ticks(batch)
        # Ticks first; the report then reads the stored rows instead of the source.
        stored = f"{path}/ticks/batch_id={batch_id}"
        ticks.write.partitionBy("trade_date").mode("overwrite").parquet(stored)
        new = batch.sparkSession.read.schema(ticks.schema).parquet(stored)
        _write_report(new, path, batch_id)

    return stream_writer(bars, checkpoint, trigger).foreachBatch(refresh).start()


def read_dashboard(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tick table, the totals per refresh, and the latest bars per refresh."""
    ticks = spark.read.parquet(f"{path}/ticks").drop("batch_id")
    totals = spark.read.schema(_TOTAL).parquet(f"{path}/totals")
    latest = spark.read.schema(_LATEST).parquet(f"{path}/latest")
    return ticks, totals.withColumnRenamed("total", "total_events"), latest


def _write_report(new: DataFrame, path: str, batch_id: int) -> None:
    spark = new.sparkSession
    total = total_events(new).select(F.col("total_events").alias("total"))
    latest = latest_bars(new)
    before = _report_before(spark, path, batch_id)
    if before is not None:
        total = total.union(before[0].select("total")).agg(F.sum("total").alias("total"))
        latest = latest_bars(latest.union(before[1].select(*LATEST_COLUMNS)))
    total.write.mode("overwrite").parquet(f"{path}/totals/batch_id={batch_id}")
    latest.write.mode("overwrite").parquet(f"{path}/latest/batch_id={batch_id}")


def _report_before(
    spark: SparkSession, path: str, batch_id: int
) -> tuple[DataFrame, DataFrame] | None:
    """The report that batch ``batch_id - 1`` left, if there was such a batch."""
    if batch_id == 0:
        return None
    found = []
    for part, schema in (("totals", _TOTAL), ("latest", _LATEST)):
        one = f"{path}/{part}/batch_id={batch_id - 1}"
        found.append(spark.read.schema(schema).option("basePath", f"{path}/{part}").parquet(one))
    return found[0], found[1]
