"""The tick table, and its latest bars without reading all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..maintenance.files import dataset_files
from ..operators.queries import LATEST_ROWS, latest_bars
from ..schema import BARS


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Bars with their ``trade_date``, the partition column."""
    return spark.read.schema(f"{_ddl()}, trade_date date").parquet(path)


def read_ticks_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stored bars as a stream of files, the oldest files first."""
    reader = spark.readStream.schema(_ddl())
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def latest_ticks(spark: SparkSession, path: str, n: int = LATEST_ROWS) -> DataFrame:
    """The ``n`` latest bars of a tick table.

    Newer dates hold newer bars, so only as many of the newest dates are read as it
    takes to have ``n`` rows; that is seen from the file listing and file footers.
    """
    ticks = read_ticks(spark, path)
    dates = dataset_files(spark, path).select("trade_date").where("trade_date IS NOT NULL")
    newest = [row.trade_date for row in dates.distinct().orderBy(F.desc("trade_date")).collect()]
    taken = 1
    while taken <= len(newest):
        recent = ticks.where(F.col("trade_date") >= F.lit(newest[taken - 1]))
        if recent.count() >= n:
            return latest_bars(recent, n)
        taken *= 2
    return latest_bars(ticks, n)


def _ddl() -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in BARS.fields)
