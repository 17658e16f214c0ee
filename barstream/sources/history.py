"""History lines, response pages, symbol lists and asset lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import not_blank
from ..functions.times import parse_time
from ..schema import ASSET, HISTORY, HISTORY_COLUMNS


def parse_history(lines: DataFrame, drop_malformed: bool = True) -> DataFrame:
    """Text lines (``value``) to history rows.

    Blank lines are skipped.  A line that is not JSON is dropped, or kept as a row
    of NULLs.  Read as arrays of one record, a bad line is NULL while a bad field
    only loses itself.
    """
    record = F.from_json("value", T.ArrayType(HISTORY))
    rows = F.inline(record) if drop_malformed else F.inline_outer(record)
    history = lines.filter(not_blank("value")).select(rows).toDF(*HISTORY_COLUMNS)
    return history.withColumn("bar_time", parse_time("bar_time"))


def split_history(lines: DataFrame) -> DataFrame:
    """History rows beside the lines that give none: ``bad_line``, ``reason`` and the row's columns.

    ``reason`` is ``blank``, ``not json`` (what the JSON reader cannot take as a record:
    broken text, arrays, numbers), ``no symbol`` or ``no time``, or NULL for a good row,
    whose ``bad_line`` is NULL.  A bad row has NULLs in the other columns.  Every line
    gives one row, so counts by reason add up to the lines read.
    """
    record = F.when(F.trim("value").startswith("{"), F.from_json("value", T.ArrayType(HISTORY)))
    parsed = lines.select("value", record.alias("r"))
    rows = parsed.select("value", F.col("r").isNotNull().alias("_read"), F.inline_outer("r"))
    rows = rows.toDF("value", "_read", *HISTORY_COLUMNS).withColumn("bar_time", parse_time("bar_time"))
    reason = (
        F.when(~F.coalesce(not_blank("value"), F.lit(False)), "blank")
        .when(~F.col("_read"), "not json")
        .when(F.coalesce("symbol", "wire_symbol").isNull(), "no symbol")
        .when(F.col("bar_time").isNull(), "no time")
    )
    rows = rows.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return rows.select(
        F.when(~good, F.col("value")).alias("bad_line"),
        "reason",
        *[F.when(good, F.col(n)).alias(n) for n in HISTORY_COLUMNS],
    )


def read_history(spark: SparkSession, path: str, drop_malformed: bool = True) -> DataFrame:
    """Newline-delimited JSON history, one record per line."""
    return parse_history(spark.read.text(path), drop_malformed)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved response pages, one JSON document per file."""
    return spark.read.text(path, wholetext=True)


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """A symbol list: one per line, trimmed, blank lines skipped."""
    lines = spark.read.text(path)
    return lines.select(F.trim("value").alias("symbol")).filter(not_blank("symbol"))


def read_assets(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Assets: files that each hold one JSON array, or one asset per line."""
    return spark.read.schema(ASSET).json(path, multiLine=not lines)
