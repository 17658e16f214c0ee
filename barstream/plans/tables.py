"""The driver's tables seen as bars, messages, pages, symbols and assets.

``events`` stand in for bars, ``customer``/``orders`` for requested symbols and
their bars, ``supplier`` for assets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batching import as_messages, repack_messages, symbol_batches
from ..operators.wire import wire_fields
from ..schema import BAR_COLUMNS, BAR_TYPE, PAGE_BAR_COLUMNS

TOPIC = "bars"

# Fixed value: bars per response page.
BARS_PER_PAGE = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bars, with the event number as ``event_id``."""
    value = F.col("value")
    derived = {
        "bar_type": F.lit(BAR_TYPE),
        "symbol": F.col("event_type"),
        "open": value,
        "high": value + 1.0,
        "low": value - 1.0,
        "close": value,
        "volume": F.col("user_id"),
        "bar_time": F.col("ts"),
        "trade_count": F.get_json_object("props", "$.k").cast("bigint"),
        "vwap": value,
    }
    return table(spark, sf_dir, "events").select(
        "event_id", *[derived[name].alias(name) for name in BAR_COLUMNS]
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars as messages of 100, in event order; the key is the batch number."""
    batches = repack_messages(bars(spark, sf_dir), dense_id="event_id")
    return as_messages(batches, TOPIC)


def junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document texts as messages that hold no JSON."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id")).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as single records of a topic with three partitions."""
    return table(spark, sf_dir, "events").select(
        F.lit(TOPIC).alias("topic"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requested symbols: customer numbers."""
    keys = table(spark, sf_dir, "customer")
    return keys.select("c_custkey", F.col("c_custkey").cast("string").alias("symbol"))


def orders_as_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bars of the customer's symbol."""
    price = F.col("o_totalprice")
    one = F.lit(1).cast("bigint")
    derived = {
        "bar_type": F.lit(BAR_TYPE),
        "symbol": F.col("o_custkey").cast("string"),
        "open": price,
        "high": price,
        "low": price,
        "close": price,
        "volume": one,
        "bar_time": F.col("o_orderdate"),
        "trade_count": one,
        "vwap": price,
    }
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", *[derived[name].alias(name) for name in BAR_COLUMNS]
    )


def as_pages(rows: DataFrame, page_of: tuple[str, ...]) -> DataFrame:
    """Bars grouped into response pages; ``page_of`` columns name the page.

    The caller's page columns bound a page to ``BARS_PER_PAGE`` bars.
    """
    bar = F.struct(*wire_fields(*PAGE_BAR_COLUMNS))
    by_symbol = rows.groupBy(*page_of, "symbol").agg(F.collect_list(bar).alias("bars"))
    pages = by_symbol.groupBy(*page_of).agg(
        F.map_from_entries(F.collect_list(F.struct("symbol", "bars"))).alias("bars")
    )
    return pages.select(*page_of, F.to_json(F.struct("bars")).alias("value"))


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars as response pages in event order."""
    page = F.expr(f"event_id div {BARS_PER_PAGE}").alias("page_id")
    return as_pages(bars(spark, sf_dir).select("*", page), ("page_id",))


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order bars as pages of request batches of 100 customers."""
    batches = symbol_batches(customers(spark, sf_dir), dense_id="c_custkey")
    rows = orders_as_bars(spark, sf_dir).join(
        batches.select("symbol", "batch_id"), "symbol"
    )
    page = F.expr(f"o_orderkey div {BARS_PER_PAGE}").alias("page_id")
    return as_pages(rows.select("*", page), ("batch_id", "page_id"))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as assets: tradable with a positive balance, nation as exchange."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("symbol"),
        F.col("n_name").alias("exchange"),
        (F.col("s_acctbal") > 0).alias("tradable"),
    )
