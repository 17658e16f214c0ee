"""Grouping rows into messages, request batches and archive chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .history import bars_per_symbol
from .numbering import number_rows, with_batch_id
from .wire import to_array_element

# Bars per replayed message, symbols per request, records per archive object.
BARS_PER_MESSAGE = 100
SYMBOLS_PER_REQUEST = 100
RECORDS_PER_OBJECT = 1000


def repack_messages(
    bars: DataFrame,
    size: int = BARS_PER_MESSAGE,
    order_by: Sequence[str] = ("bar_time",),
    within: Sequence[str] = (),
    dense_id: str | None = None,
    unique: bool = True,
) -> DataFrame:
    """Pack bars into JSON arrays of ``size`` in order; the last one may be short.

    Returns ``within`` columns, ``batch_id``, ``records`` and ``value``.  No group
    is larger than ``size`` rows, however the buckets are distributed.
    """
    if dense_id is None:
        rows = number_rows(bars, order_by, within, "_row", unique)
    else:
        rows = bars.withColumn("_row", F.col(dense_id))
    rows = with_batch_id(rows, size, dense_id="_row")
    element = F.struct("_row", to_array_element().alias("bar"))
    packed = rows.groupBy(*within, "batch_id").agg(
        F.sort_array(F.collect_list(element)).alias("rows")
    )
    # Written by position: the elements keep wire names, two of which differ by case only.
    array = F.to_json(F.transform("rows", lambda row: row["bar"]))
    return packed.select(*within, "batch_id", F.size("rows").alias("records"), array.alias("value"))


def as_messages(batches: DataFrame, topic: str, partitions: int = 3) -> DataFrame:
    """Batches as records of the message source, spread over topic partitions.

    Offsets are gap-free within a partition and follow the batch order.
    """
    parts = F.lit(partitions)
    return batches.select(
        F.col("batch_id").cast("string").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("batch_id"), parts).cast("int").alias("partition"),
        F.expr(f"batch_id div {int(partitions)}").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def archive_chunks(messages: DataFrame, size: int = RECORDS_PER_OBJECT) -> DataFrame:
    """Add ``chunk``: which run of ``size`` consecutive records of its topic partition."""
    chunks = with_batch_id(messages, size, ["offset"], ["topic", "partition"])
    return chunks.withColumnRenamed("batch_id", "chunk")


def archive_manifest(messages: DataFrame, size: int = RECORDS_PER_OBJECT) -> DataFrame:
    """First offset and record count of each archive object of a topic partition.

    Offsets may have gaps: an object holds ``size`` consecutive records.
    """
    chunks = archive_chunks(messages.select("topic", "partition", "offset"), size)
    return (
        chunks.groupBy("topic", "partition", "chunk")
        .agg(F.min("offset").alias("start_offset"), F.count(F.lit(1)).alias("records"))
        .withColumn(
            "object_name",
            F.format_string("%s-%d-%d.jsonl.gz", "topic", "partition", "start_offset"),
        )
    )


def symbol_batches(
    symbols: DataFrame,
    size: int = SYMBOLS_PER_REQUEST,
    order_by: Sequence[str] = ("symbol",),
    dense_id: str | None = None,
    unique: bool = True,
) -> DataFrame:
    """Number the symbols into request batches of ``size`` from 1, 100 unless asked otherwise."""
    return with_batch_id(symbols, size, order_by, dense_id=dense_id, start=1, unique=unique)


def batch_symbols(batches: DataFrame) -> DataFrame:
    """The comma-joined symbol list of each request batch."""
    listed = F.array_join(F.array_sort(F.collect_list("symbol")), ",")
    return batches.groupBy("batch_id").agg(listed.alias("symbols"))


def batch_totals(pages: DataFrame) -> DataFrame:
    """Bars, pages and distinct symbols per request batch, and in total.

    ``pages`` has ``batch_id`` and the response text ``value``.  ``is_total`` marks
    the total; pages without a batch have a row of their own.  A symbol listed with an empty array counts as seen;
    a page without symbols does not count.
    """
    counted = bars_per_symbol(pages, ("batch_id",), position="at")
    # Reduced to one row per (batch, symbol) first: the distinct counts of the
    # rollup then never see more of a hot batch than its keys.
    per_symbol = counted.groupBy("batch_id", "symbol").agg(
        F.sum("bars").alias("bars"), F.count_if(F.col("at") == 0).alias("pages")
    )
    return per_symbol.rollup("batch_id").agg(
        (F.grouping("batch_id") == 1).alias("is_total"),
        F.sum("bars").alias("bars"),
        F.sum("pages").alias("pages"),
        F.countDistinct("symbol").alias("symbols"),
    )


def symbol_coverage(requested: DataFrame, seen: DataFrame) -> DataFrame:
    """How many requested symbols have data: one row with counts and ratio."""
    counts = _marked(requested, seen).agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("requested"),
        F.count("seen").alias("with_data"),
    )
    ratio = F.when(F.col("requested") > 0, F.col("with_data") / F.col("requested"))
    return counts.withColumn("coverage", F.coalesce(ratio, F.lit(0.0)))


def missing_symbols(requested: DataFrame, seen: DataFrame) -> DataFrame:
    """The requested symbols without data."""
    return _marked(requested, seen).filter(F.col("seen").isNull()).select("symbol")


def _marked(requested: DataFrame, seen: DataFrame) -> DataFrame:
    # Both sides are reduced to one row per symbol before they meet, so a symbol
    # that owns a third of the bars joins as a single row.
    wanted = requested.groupBy("symbol").agg(F.count(F.lit(1)).alias("lines"))
    with_data = seen.select("symbol").distinct().withColumn("seen", F.lit(True))
    return wanted.join(with_data, "symbol", "left")


def tradable_symbols(assets: DataFrame, exchange: str | None = None) -> DataFrame:
    """Symbols of the tradable assets, of one exchange if given."""
    kept = assets.filter(F.coalesce("tradable", F.lit(False)))
    if exchange is not None:
        kept = kept.filter(F.col("exchange") == exchange)
    return kept.select("symbol")
