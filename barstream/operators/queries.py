"""The questions asked of the bar relation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prices import high_of, low_of, rounded_price, typical
from ..functions.text import thousands
from ..functions.times import display_time, instant, seconds_between, utc_wall_clock
from ..schema import PRICE_COLUMNS

# Rows of the latest-bars report, its columns, the display order.
LATEST_ROWS = 10
LATEST_COLUMNS = ("symbol", "open", "high", "low", "close", "volume", "bar_time")
DISPLAY_COLUMNS = ("time", "symbol", "open", "high", "low", "close", "volume", "bar_time")
_TIMEFRAME_UNITS = {"Min": "minutes", "Hour": "hours", "Day": "days", "Week": "weeks"}


def total_events(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count(F.lit(1)).alias("total_events"))


def count_by_symbol(bars: DataFrame) -> DataFrame:
    """Bars per symbol, most first."""
    counts = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "symbol")


def distinct_symbols(bars: DataFrame) -> DataFrame:
    return bars.select("symbol").distinct()


def profile_symbol(bars: DataFrame, symbol: str) -> DataFrame:
    """First and last time, bars and distinct symbols of one symbol's bars."""
    return bars.filter(F.col("symbol") == symbol).agg(
        F.min("bar_time").alias("min_date"),
        F.max("bar_time").alias("max_date"),
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("symbol").alias("distinct_symbols"),
    )


def daily_counts(bars: DataFrame, symbol: str) -> DataFrame:
    """Bars per trading date of one symbol, latest date first."""
    return (
        bars.filter(F.col("symbol") == symbol)
        .groupBy(F.to_date("bar_time").alias("trade_date"))
        .agg(F.count(F.lit(1)).alias("total_trades"))
        .orderBy(F.desc("trade_date"))
    )


def latest_bars(
    bars: DataFrame, n: int = LATEST_ROWS, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` latest bars.

    Equal times are ordered by symbol, then ``tie_breakers``, then the other
    shown columns, so the report does not change from run to run.
    """
    rest = [c for c in LATEST_COLUMNS if c not in ("bar_time", "symbol")]
    order = [F.desc("bar_time"), "symbol", *tie_breakers, *rest]
    return bars.orderBy(*order).limit(n).select(*LATEST_COLUMNS)


def top_offsets(messages: DataFrame, n: int = LATEST_ROWS) -> DataFrame:
    """The ``n`` highest offsets."""
    return messages.select("offset").orderBy(F.desc("offset")).limit(n)


def display_bars(bars: DataFrame) -> DataFrame:
    """Bars for reading: time in plain text, prices in cents, volume with commas.

    Columns come in display order; those the input lacks are left out.
    """
    shown = bars
    if "bar_time" in shown.columns:
        shown = shown.withColumn("time", display_time("bar_time"))
    if "volume" in shown.columns:
        shown = shown.withColumn("volume", thousands("volume"))
    for price in PRICE_COLUMNS:
        if price in shown.columns:
            shown = shown.withColumn(price, rounded_price(price))
    return shown.select(*[c for c in DISPLAY_COLUMNS if c in shown.columns])


def repair_ohlc(bars: DataFrame) -> DataFrame:
    """Widen high and low so that they enclose open and close."""
    return bars.withColumns({"high": high_of(), "low": low_of()})


def typical_price(bars: DataFrame) -> DataFrame:
    """Add the typical price in cents precision."""
    return bars.withColumn("typical_price", rounded_price(typical()))


def bar_rate(bars: DataFrame) -> DataFrame:
    """Bars, elapsed seconds from first to last bar, and bars per second."""
    spans = bars.agg(
        F.count(F.lit(1)).alias("bars"),
        F.min("bar_time").alias("first"),
        F.max("bar_time").alias("last"),
    )
    elapsed = F.coalesce(seconds_between("first", "last"), F.lit(0.0)).alias("seconds")
    rate = F.when(F.col("seconds") > 0, F.col("bars") / F.col("seconds")).otherwise(F.lit(0.0))
    return spans.select("bars", elapsed).withColumn("bars_per_second", rate)


def timeframe(text: str) -> str:
    """``1Min``, ``15Min``, ``1Hour``, ``1Day`` … as a Spark interval."""
    match = re.fullmatch(r"([1-9]\d*)(Min|Hour|Day|Week)", text)
    if match is None:
        raise ValueError(f"not a timeframe: {text!r}")
    return f"{match[1]} {_TIMEFRAME_UNITS[match[2]]}"


def resample_bars(
    bars: DataFrame, to: str = "1Hour", watermark: str | None = None
) -> DataFrame:
    """Coarser bars: first open, highest high, lowest low, last close, sums, mean price.

    Works on a stream too, with ``watermark`` saying how late a bar may come.  All
    aggregates combine on the map side, so a hot symbol shuffles one row per task
    and window.  (symbol, bar_time) is taken to identify a bar.  Weeks begin on Monday.
    """
    if watermark is not None:
        # Watermarks are defined on instants only; windows start at the same times.
        bars = bars.withColumn("bar_time", instant("bar_time"))
        bars = bars.withWatermark("bar_time", watermark)
    traded = F.when(F.col("vwap").isNotNull(), F.col("volume"))
    length = timeframe(to)
    # Windows count from the epoch, a Thursday; its first Monday comes four days later.
    start = "4 days" if to.endswith("Week") else None
    span = F.window("bar_time", length, length, start) if start else F.window("bar_time", length)
    coarse = bars.groupBy("symbol", span.alias("w")).agg(
        F.min_by("open", "bar_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_time").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
        F.sum(F.col("vwap") * F.col("volume")).alias("_value"),
        F.sum(traded).alias("_traded"),
    )
    start = F.col("w")["start"]
    return coarse.select(
        "symbol",
        (start if watermark is None else utc_wall_clock(start)).alias("bar_time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "trade_count",
        _mean_price().alias("vwap"),
    )


def _mean_price() -> Column:
    return F.when(F.col("_traded") > 0, F.col("_value") / F.col("_traded"))
