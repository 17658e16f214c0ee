"""Queries that keep datasets and catalog tables in shape, and live stream counters."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import maintenance, sinks, sources, streaming
from ..operators.wire import as_ticks
from ..session import scratch
from ..sinks.starting import AVAILABLE_NOW
from . import tables
from .evidence import ticks_in_files
from .flows import CUTOFF
from .registry import BARS_SQL, COLUMNS_SQL, query

_MILLIS = "date_trunc('millisecond', bar_time)"
_DATED_SQL = f"""{COLUMNS_SQL.replace("bar_time", f"{_MILLIS} AS bar_time")},
    CAST(bar_time AS DATE) AS trade_date"""

#: The first dates have one large file beside small ones; the target lies between them.
_LARGE_UNTIL = "2024-01-11"


def mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """A tick table whose early dates have one large file and, as all dates, three small ones."""
    path = scratch(spark, "mixed-files")
    bars = tables.bars(spark, sf_dir)
    early = F.col("bar_time") < F.lit(_LARGE_UNTIL).cast("timestamp_ntz")
    kind = F.col("event_id") % 20
    parts = [early & (kind >= 3)] + [(kind == i) | (~early & (kind % 3 == i) & (kind >= 3)) for i in range(3)]
    for part in parts:
        ticks = as_ticks(bars.where(part))
        ticks.repartition("trade_date").write.mode("append").partitionBy("trade_date").parquet(path)
    return path


@query("compact_binpack", f"SELECT {_DATED_SQL} FROM bars")
def compact_binpack(spark, sf_dir):
    """All rows after the small files were packed and the large ones left alone."""
    path = mixed_files(spark, sf_dir)
    largest = maintenance.list_files(spark, path).first().file_size_in_bytes
    maintenance.compact_small(spark, path, target_mb=largest / 2**20, share=0.9)
    return spark.read.parquet(path)


@query(
    "compact_binpack_files",
    f"""WITH {BARS_SQL}, f AS (SELECT CAST(bar_time AS DATE) AS trade_date,
                 count(DISTINCT event_id % 3) AS n FROM bars GROUP BY 1)
        SELECT CAST(sum(n) AS BIGINT) AS files_before,
               CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS files_packed,
               count(*) FILTER (n > 1) AS bins, count(*) AS files_after,
               count(*) FILTER (n = 1) AS files_untouched FROM f""",
)
def compact_binpack_files(spark, sf_dir):
    """Files of a table whose dates have up to three small files and a high target."""
    done = maintenance.compact_small(spark, ticks_in_files(spark, sf_dir), target_mb=1024)
    return done.select("files_before", "files_packed", "bins", "files_after", "files_untouched")


def ticks_table(spark: SparkSession, sf_dir: str) -> str:
    """A catalog table of ticks by date with several files a date; its name."""
    name, at = f"ticks_{uuid.uuid4().hex}", scratch(spark, "ticks-table")
    bars = as_ticks(tables.bars(spark, sf_dir))
    sinks.ctas(bars.repartition(3, "bar_time"), name, partition_by=["trade_date"], location=at)
    return name


@query("compact_table", f"SELECT {_DATED_SQL} FROM bars")
def compact_table(spark, sf_dir):
    """A catalog table's rows after its early dates were compacted, then all."""
    name = ticks_table(spark, sf_dir)
    maintenance.compact_table(spark, name, where=F.col("trade_date") < F.lit(CUTOFF.date()))
    maintenance.compact_table(spark, name, sort_by=["symbol", "bar_time"])
    return spark.table(name)


@query(
    "compact_table_files",
    "SELECT CAST(bar_time AS DATE) AS trade_date, CAST(1 AS BIGINT) AS files, count(*) AS rows FROM bars GROUP BY 1",
)
def compact_table_files(spark, sf_dir):
    """The files of each date that the table reads after compaction."""
    name = ticks_table(spark, sf_dir)
    maintenance.compact_table(spark, name)
    ticks = spark.table(name).select("trade_date", F.col("_metadata.file_path").alias("file"))
    return ticks.groupBy("trade_date").agg(
        F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("rows")
    )


@query(
    "retain_table",
    f"SELECT {_DATED_SQL} FROM bars WHERE {_MILLIS} >= TIMESTAMP '{CUTOFF:%Y-%m-%d %H:%M:%S}'",
)
def retain_table(spark, sf_dir):
    """A catalog table without the rows before a cutoff in the middle of a date."""
    name = ticks_table(spark, sf_dir)
    maintenance.retain_table(spark, name, CUTOFF)
    return spark.table(name)


@query(
    "stream_metrics_live",
    """SELECT (SELECT count(DISTINCT event_id // 100) FROM events)
                + (SELECT count(*) FROM documents) AS messages_received,
              (SELECT count(*) FROM events) AS messages_sent,
              (SELECT count(*) FROM documents) AS errors""",
)
def stream_metrics_live(spark, sf_dir):
    """Counters of a listener on a stream of 110 batches, more than a query's progress keeps."""
    base = scratch(spark, "metered")
    mixed = tables.messages(spark, sf_dir).union(tables.junk(spark, sf_dir))
    mixed.repartition(110).write.parquet(f"{base}/in")
    source = sources.read_messages_stream(spark, f"{base}/in", files_per_trigger=1)
    flat = streaming.observe_flow(source, "flow")
    with streaming.listening(spark, "flow") as metrics:
        writer = sinks.starting.stream_writer(flat, f"{base}/checkpoint", AVAILABLE_NOW)
        running = writer.format("noop").start()
        metrics.drain(running)
    counted = metrics.snapshot()
    row = tuple(counted[c] for c in ("messages_received", "messages_sent", "errors"))
    counters = spark.createDataFrame(
        [row], "messages_received bigint, messages_sent bigint, errors bigint"
    )
    return counters
