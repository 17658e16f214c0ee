"""Tables: the raw lake table, the tick table, and tables created from a query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.wire import as_ticks
from ..session import setting
from .starting import stream_writer

#: How often a stream appends to the raw table.
RAW_INTERVAL = "1 minute"


def write_raw(
    messages: DataFrame,
    path: str | None = None,
    *,
    table: str | None = None,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    checkpoint: str | None = None,
    trigger: str | None = RAW_INTERVAL,
) -> StreamingQuery | None:
    """Append the messages unparsed to a directory or to a catalog table.

    ``table_format="iceberg"`` works where that format's runtime is on the class
    path; the table is created if it does not exist.
    """
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    if not messages.isStreaming:
        writer = messages.write.format(table_format).mode("append").partitionBy(*partition_by)
        writer.save(path) if path is not None else writer.saveAsTable(table)
        return None
    writer = stream_writer(messages, checkpoint, trigger).format(table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table_format == "iceberg":
        writer = writer.option("fanout-enabled", "true")
    return writer.option("path", path).start() if path is not None else writer.toTable(table)


def load_ticks(
    bars: DataFrame,
    path: str,
    *,
    fill_defaults: bool = False,
    rebalance: bool = False,
    checkpoint: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery | None:
    """Append bars to the tick table, partitioned by trading date.

    A flow of current bars needs no shuffle, as a task holds few dates.  A load that
    spans many dates should ``rebalance``: Spark then gathers each date in few tasks,
    splitting large dates and merging small ones, so that files get a sensible size.
    A batch sorts a date by symbol, which lets readers of one symbol skip row groups.
    """
    ticks = as_ticks(bars, fill_defaults)
    if bars.isStreaming:
        writer = stream_writer(ticks, checkpoint, trigger).format("parquet")
        return writer.partitionBy("trade_date").option("path", path).start()
    if rebalance:
        ticks = ticks.hint("rebalance", "trade_date")
    ordered = ticks.sortWithinPartitions("trade_date", "symbol", "bar_time")
    ordered.write.partitionBy("trade_date").mode("append").parquet(path)
    return None


def write_fanned_out(df: DataFrame, path: str, partition_by: Sequence[str], writers: int = 100) -> None:
    """Append to a partitioned Parquet dataset without sorting the rows by partition.

    A task keeps up to ``writers`` files open, one a partition value.  Where it meets
    more, Spark sorts what is left of its rows, so memory stays bounded and nothing
    is lost.  For input whose tasks hold few partitions each; otherwise a sort is cheaper
    than many open files.
    """
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", writers):
        df.write.partitionBy(*partition_by).mode("append").parquet(path)


def insert_partitions(df: DataFrame, table: str, partition_by: Sequence[str], location: str | None = None) -> DataFrame:
    """Put rows into a partitioned catalog table, replacing the partitions they belong to.

    Partitions without new rows stay as they are.  The table is created where there is
    none, in the warehouse or at ``location``.  Columns go by name, so their order is
    free; a column the table lacks is an error.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return ctas(df, table, partition_by=partition_by, location=location)
    names = spark.table(table).columns
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"columns {sorted(df.columns)} are not those of {table}: {sorted(names)}")
    # The writer's own option does not reach an insert into a catalog table.
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*names).write.insertInto(table, overwrite=True)
    return spark.table(table)


def ctas(
    df: DataFrame,
    table: str,
    *,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> DataFrame:
    """Create ``table`` from ``df``; it is an error if the table exists.

    The data goes to the warehouse, or to ``location``.
    """
    writer = df.write.format(table_format).partitionBy(*partition_by)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(table, mode="errorifexists")
    return df.sparkSession.table(table)
