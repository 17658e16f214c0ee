"""A tick table that a stream feeds date by date, with one current report per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.wire import as_ticks
from ..schema import BARS
from ..sinks.starting import stream_writer

#: Batches of a date after which its closed ones are merged; reports kept beside the current one.
MERGE_EVERY = 60
KEEP = 3

_STATE = "symbol string, bars bigint, bar_time timestamp_ntz, close double"
_COLUMNS = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BARS.fields)


def report_stream(
    bars: DataFrame,
    path: str,
    *,
    checkpoint: str,
    trigger: str | None = "60 seconds",
    keep: int = KEEP,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Append a stream of bars to ``path``/ticks and upsert the report of its symbols.

    A micro-batch is stored under its date and number (``trade_date=D/batch_id=N``).
    The report has one row per symbol: its bars so far and its latest close.  A refresh
    adds the rows just stored to the report before it, so it costs what is new and the
    number of symbols.  Both overwrite what an earlier attempt at the same batch has
    left, so a repeated batch counts once; it meets the report of the batch before it,
    which is why ``keep`` is at least 1.  Older reports are deleted.

    Once a date holds ``merge_every`` closed batches they are written again as one
    (``merged/trade_date=D/upto=N``), each row once in its life.  Readers pass over
    batches up to N of such a date, so they are right before and after the merged
    ones are deleted.  Files and directories of a date thus stay few.
    """
    if keep < 1 or merge_every < 2:
        raise ValueError("keep at least one report, and merge at least two batches")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ticks = as_ticks(batch).withColumn("batch_id", F.lit(batch_id))
        _overwrite(ticks, f"{path}/ticks", "trade_date", "batch_id")
        found = _folders(spark, f"{path}/ticks")
        own = [date for date, n in found if n == batch_id]
        _upsert(spark, path, own, batch_id)
        _delete(spark, [f"{path}/report/batch_id={n}" for n in _reports(spark, path) if n < batch_id - keep])
        _merge(spark, path, [(d, n) for d, n in found if n < batch_id], merge_every)

    return stream_writer(bars, checkpoint, trigger).foreachBatch(refresh).start()


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``symbol, bars, bar_time, close`` of the current report; no row before the first batch."""
    done = _reports(spark, path)
    if not done:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(f"{path}/report/batch_id={max(done)}")


def read_report_ticks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the tick table, with ``trade_date``."""
    upto = _merged(spark, path)
    parts = [f"{path}/ticks/trade_date={d}/batch_id={n}" for d, n in _folders(spark, f"{path}/ticks") if n > upto.get(d, -1)]
    parts = _rows(spark, f"{path}/ticks", parts)
    merged = [f"{path}/merged/trade_date={d}/upto={n}" for d, n in _folders(spark, f"{path}/merged")]
    return parts.unionByName(_rows(spark, f"{path}/merged", merged))


def _rows(spark: SparkSession, base: str, folders: list[str]) -> DataFrame:
    schema = f"{_COLUMNS}, trade_date date"
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    return rows.select(*[f.name for f in BARS.fields], "trade_date")


def _overwrite(rows: DataFrame, path: str, *partitions: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def _upsert(spark: SparkSession, path: str, dates: list[str], batch_id: int) -> None:
    new = _rows(spark, f"{path}/ticks", [f"{path}/ticks/trade_date={d}/batch_id={batch_id}" for d in dates])
    state = new.select("symbol", F.lit(1).cast("bigint").alias("bars"), "bar_time", "close")
    before = [n for n in _reports(spark, path) if n < batch_id]
    if before:
        state = state.unionByName(spark.read.schema(_STATE).parquet(f"{path}/report/batch_id={max(before)}"))
    last = F.max(F.struct("bar_time", "close"))
    state = state.groupBy("symbol").agg(F.sum("bars").alias("bars"), last.alias("last"))
    state = state.select("symbol", "bars", "last.bar_time", "last.close")
    state.write.mode("overwrite").parquet(f"{path}/report/batch_id={batch_id}")


def _merge(spark: SparkSession, path: str, closed: list[tuple[str, int]], least: int) -> None:
    """Write the closed batches of every date that has ``least`` of them as one, then delete them."""
    upto = _merged(spark, path)
    by_date: dict[str, list[int]] = {}
    for date, n in closed:
        by_date.setdefault(date, []).append(n)
    _delete(spark, [f"{path}/ticks/trade_date={d}/batch_id={n}" for d, n in closed if n <= upto.get(d, -1)])
    due = {d: [n for n in ns if n > upto.get(d, -1)] for d, ns in by_date.items()}
    due = {d: ns for d, ns in due.items() if len(ns) >= least}
    if not due:
        return
    folders = [f"{path}/ticks/trade_date={d}/batch_id={n}" for d, ns in due.items() for n in ns]
    last = spark.createDataFrame([(d, max(ns)) for d, ns in due.items()], "trade_date string, upto bigint")
    last = last.withColumn("trade_date", F.col("trade_date").cast("date"))
    rows = _rows(spark, f"{path}/ticks", folders).join(F.broadcast(last), "trade_date")
    # Large dates are split over several tasks and small ones share one.
    _overwrite(rows.hint("rebalance", "trade_date"), f"{path}/merged", "trade_date", "upto")
    _delete(spark, folders)


def _reports(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the reports that were written to their end."""
    fs, root = _file_system(spark, f"{path}/report")
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    hadoop = spark._jvm.org.apache.hadoop.fs
    return [int(p.getName().partition("=")[2]) for p in found if fs.exists(hadoop.Path(p, "_SUCCESS"))]


def _merged(spark: SparkSession, path: str) -> dict[str, int]:
    """The last merged batch of each date."""
    upto: dict[str, int] = {}
    for date, n in _folders(spark, f"{path}/merged"):
        upto[date] = max(n, upto.get(date, -1))
    return upto


def _folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(date, number) of the directories two levels down."""
    fs, root = _file_system(spark, f"{path}/trade_date=*/*=*")
    return [
        (s.getPath().getParent().getName().partition("=")[2], int(s.getPath().getName().partition("=")[2]))
        for s in fs.globStatus(root) or []
        if s.isDirectory()
    ]


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        fs, path = _file_system(spark, folder)
        fs.delete(path, True)


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
