"""Queries over input that is spoiled, partial or wide enough to show what an operator does.

They run operators whose clean-input queries are elsewhere: messages with control
records and faulty fields, requested symbols without data, volumes above 999, one
sink of two, and datasets whose number of files is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import maintenance, sinks, sources, streaming
from ..operators import batching, queries
from ..operators.flatten import flatten_messages
from ..operators.wire import as_ticks, from_wire, to_array_element
from ..schema import BAR_COLUMNS
from ..session import scratch
from ..sinks.starting import AVAILABLE_NOW
from ..streaming.fanout import Outputs
from . import tables
from .registry import BARS_SQL, COLUMNS_SQL, KEYED_SQL, query

#: How a message is spoiled, by its number modulo 5; 0 is clean.
UNKNOWN_FIELD, TEXT_PRICE, NO_COUNT, OBJECT_VOLUME = 1, 2, 3, 4
_KIND_SQL = "event_id // 100 % 5"
_HIT_SQL = "event_id % 10 = 3"

# A price as text is a number in the strict mode and unreadable in the other one;
# an absent count is 0 in the one and null in the other.
STRICT_SQL = f"""SELECT CAST(event_id // 100 AS VARCHAR) AS key, bar_type, symbol, open, high, low, close,
    volume, bar_time,
    CASE WHEN {_KIND_SQL} = {NO_COUNT} AND {_HIT_SQL} THEN 0 ELSE trade_count END AS trade_count, vwap
    FROM bars WHERE {_KIND_SQL} NOT IN ({UNKNOWN_FIELD}, {OBJECT_VOLUME})"""
_PERMISSIVE = f"""SELECT event_id, bar_type, symbol,
    CASE WHEN {_KIND_SQL} = {TEXT_PRICE} AND {_HIT_SQL} THEN NULL ELSE open END AS open, high, low, close,
    CASE WHEN {_KIND_SQL} = {OBJECT_VOLUME} AND {_HIT_SQL} THEN NULL ELSE volume END AS volume, bar_time,
    CASE WHEN {_KIND_SQL} = {NO_COUNT} AND {_HIT_SQL} THEN NULL ELSE trade_count END AS trade_count, vwap
    FROM bars"""
_MILLIS = "date_trunc('millisecond', bar_time)"


def spoiled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of 100 bars; in four of five every tenth bar has one faulty field."""
    bars = tables.bars(spark, sf_dir)
    kind = F.expr("event_id div 100 % 5")
    hit = F.col("event_id") % 10 == 3
    text = F.to_json(to_array_element())

    def swapped(pattern: str, replacement: str):
        return F.regexp_replace(text, pattern, replacement)

    element = (
        F.when(hit & (kind == UNKNOWN_FIELD), swapped(r"\}$", ',"zz":1}'))
        .when(hit & (kind == TEXT_PRICE), swapped(r'"o":([^,]+),', '"o":"$1",'))
        .when(hit & (kind == NO_COUNT), swapped(r'"n":[^,]+,', ""))
        .when(hit & (kind == OBJECT_VOLUME), swapped(r'"v":[^,]+,', '"v":{},'))
        .otherwise(text)
    )
    # A message is 100 bars, so the list is bounded.
    packed = bars.groupBy(F.expr("event_id div 100").alias("batch_id")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", element.alias("bar")))).alias("rows")
    )
    value = F.concat(F.lit("["), F.array_join(F.col("rows.bar"), ","), F.lit("]"))
    return batching.as_messages(packed.select("batch_id", value.alias("value")), tables.TOPIC)


@query("flatten_strict_spoiled", STRICT_SQL)
def flatten_strict_spoiled(spark, sf_dir):
    """The strict mode rejects whole messages and coerces by type."""
    return flatten_messages(spoiled_messages(spark, sf_dir), mode="strict")


@query("flatten_spoiled", f"WITH {BARS_SQL} SELECT {KEYED_SQL} FROM ({_PERMISSIVE})")
def flatten_spoiled(spark, sf_dir):
    """The permissive mode keeps every bar and loses single fields."""
    return flatten_messages(spoiled_messages(spark, sf_dir))


@query("stream_flatten_strict_spoiled", STRICT_SQL)
def stream_flatten_strict_spoiled(spark, sf_dir):
    """The strict mode on a stream of spoiled arrays and texts that are not JSON."""
    base = scratch(spark, "spoiled")
    spoiled_messages(spark, sf_dir).union(tables.junk(spark, sf_dir)).write.parquet(f"{base}/in")
    bars = flatten_messages(sources.read_messages_stream(spark, f"{base}/in"), mode="strict")
    writer = sinks.starting.stream_writer(bars, f"{base}/checkpoint", AVAILABLE_NOW)
    writer.format("parquet").option("path", f"{base}/out").start().awaitTermination()
    return spark.read.schema(bars.schema).parquet(f"{base}/out")


@query(
    "tick_defaults",
    f"""WITH {BARS_SQL}
        SELECT bar_type, symbol, coalesce(open, 0) AS open, high, low, close,
               coalesce(volume, 0) AS volume, {_MILLIS} AS bar_time,
               coalesce(trade_count, 0) AS trade_count, vwap, CAST(bar_time AS DATE) AS trade_date
        FROM ({_PERMISSIVE})""",
)
def tick_defaults(spark, sf_dir):
    """Ticks of spoiled messages, absent numbers stored as 0."""
    return as_ticks(flatten_messages(spoiled_messages(spark, sf_dir)), fill_defaults=True)


@query("flatten_control", f"SELECT {KEYED_SQL} FROM bars WHERE event_id % 7 <> 0")
def flatten_control(spark, sf_dir):
    """Bars of messages in which every seventh element is a control record."""
    bars = tables.bars(spark, sf_dir)
    control = F.when(F.col("event_id") % 7 == 0, F.lit("success")).otherwise(F.col("bar_type"))
    mixed = batching.repack_messages(bars.withColumn("bar_type", control), dense_id="event_id")
    return flatten_messages(batching.as_messages(mixed, tables.TOPIC), only_bars=True)


_WIDE_LATEST = "ORDER BY bar_time DESC, symbol, open, high, low, close, volume LIMIT 10"


@query(
    "display_volumes",
    f"""SELECT strftime(bar_time, '%Y-%m-%d %H:%M:%S') AS time, symbol, round(open, 2) AS open,
               round(high, 2) AS high, round(low, 2) AS low, round(close, 2) AS close,
               format('{{:,}}', volume) AS volume, bar_time
        FROM (SELECT * REPLACE (volume * 12345678 + 999 AS volume) FROM bars {_WIDE_LATEST})""",
)
def display_volumes(spark, sf_dir):
    """The latest bars for reading, with volumes of several groups of digits."""
    wide = tables.bars(spark, sf_dir).withColumn("volume", F.col("volume") * 12345678 + 999)
    return queries.display_bars(queries.latest_bars(wide))


def _documents_wanted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents as requested symbols, the labelled ones as those with data."""
    symbol = F.col("doc_id").cast("string").alias("symbol")
    return (
        tables.table(spark, sf_dir, "documents").select(symbol),
        tables.table(spark, sf_dir, "labels").select(symbol),
    )


@query(
    "symbol_coverage_partial",
    """SELECT count(*) AS requested, count(l.doc_id) AS with_data, count(l.doc_id) / count(*) AS coverage
       FROM (SELECT DISTINCT doc_id FROM documents) d
       LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
)
def symbol_coverage_partial(spark, sf_dir):
    requested, seen = _documents_wanted(spark, sf_dir)
    return batching.symbol_coverage(requested, seen)


@query(
    "missing_symbols_partial",
    """SELECT DISTINCT CAST(doc_id AS VARCHAR) AS symbol FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def missing_symbols_partial(spark, sf_dir):
    requested, seen = _documents_wanted(spark, sf_dir)
    return batching.missing_symbols(requested, seen)


def _one_sink(spark: SparkSession, sf_dir: str, outputs: str) -> Outputs:
    base = scratch(spark, outputs)
    tables.messages(spark, sf_dir).write.parquet(f"{base}/in")
    targets = Outputs(
        checkpoint=f"{base}/checkpoint", messages_path=f"{base}/messages", raw_path=f"{base}/raw"
    )
    source = sources.read_messages_stream(spark, f"{base}/in", files_per_trigger=2)
    streaming.run_pipeline(source, outputs, targets, trigger=AVAILABLE_NOW)
    return targets


@query("stream_messages_only", f"SELECT {KEYED_SQL} FROM bars")
def stream_messages_only(spark, sf_dir):
    """The job with the message sink alone."""
    targets = _one_sink(spark, sf_dir, "kafka-only")
    return from_wire(spark.read.schema("key string, value string").parquet(targets.messages_path))


@query("stream_raw_only", f"SELECT {KEYED_SQL} FROM bars")
def stream_raw_only(spark, sf_dir):
    """The job with the raw sink alone."""
    targets = _one_sink(spark, sf_dir, "iceberg-only")
    return flatten_messages(sources.read_messages(spark, targets.raw_path))


def ticks_in_files(spark: SparkSession, sf_dir: str, files: int = 3) -> str:
    """The bars as a tick table that has one file for each date and ``event_id % files``."""
    path = scratch(spark, "ticks-in-files")
    bars = tables.bars(spark, sf_dir)
    for part in range(files):
        ticks = as_ticks(bars.where(F.col("event_id") % files == part))
        ticks.repartition("trade_date").write.mode("append").partitionBy("trade_date").parquet(path)
    return path


_FILES = """SELECT CAST(bar_time AS DATE) AS trade_date, count(DISTINCT event_id % 3) AS files,
                   count(*) AS rows FROM bars GROUP BY 1"""


@query("list_files_parquet", f"WITH {BARS_SQL} SELECT trade_date, files FROM ({_FILES})")
def list_files_parquet(spark, sf_dir):
    """The files of a Parquet tick table by date."""
    files = maintenance.list_files(spark, ticks_in_files(spark, sf_dir))
    return files.groupBy("trade_date").agg(F.count(F.lit(1)).alias("files"))


@query(
    "compact_files_reduced",
    f"""WITH {BARS_SQL} SELECT CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(files) AS BIGINT) AS files_before,
               count(*) AS files_after, CAST(sum(files) - count(*) AS BIGINT) AS files_reduced
        FROM ({_FILES}) WHERE files > 0""",
)
def compact_files_reduced(spark, sf_dir):
    """What compaction reports where each date has three files before and one after."""
    done = maintenance.compact(spark, ticks_in_files(spark, sf_dir), target_mb=1024)
    return done.select("rows", "files_before", "files_after", "files_reduced")


@query(
    "scan_limit",
    "SELECT least(count(*), 25) AS rows, least(count(*), 25) AS known FROM bars",
)
def scan_limit(spark, sf_dir):
    """Any 25 rows of a scanned tick table: how many, and how many of them it holds."""
    ticks = sources.read_ticks(spark, ticks_in_files(spark, sf_dir))
    some = ticks.limit(25).select("symbol", "bar_time").withColumn("one", F.lit(1))
    held = ticks.select("symbol", "bar_time").distinct().withColumn("known", F.lit(1))
    return some.join(held, ["symbol", "bar_time"], "left").agg(
        F.count("one").alias("rows"), F.count("known").alias("known")
    )
