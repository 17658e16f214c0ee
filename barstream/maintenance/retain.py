"""Retention: dropping rows older than a cutoff."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import dataset_files
from .swap import Exchange

_RESULT = "partitions_dropped bigint, rows_rewritten bigint, rows_removed bigint"


def retain_since(
    spark: SparkSession,
    path: str,
    cutoff: datetime,
    *,
    time_column: str = "bar_time",
    date_partition: str = "trade_date",
    dest: str | None = None,
) -> DataFrame:
    """Drop the rows of a date-partitioned dataset whose time lies before ``cutoff``.

    Older dates go as whole directories without being read; only the date that
    holds the cutoff is rewritten.  The cutoff is UTC unless it says otherwise.
    With ``dest`` the retained rows are written there instead and ``path`` stays as
    it is.  Rows without a time are kept.  The dataset may have further partition
    columns, before or after the date; all are kept.  The rewritten rows are counted
    before anything is dropped.

    Returns one row: dates dropped, rows rewritten, and rows removed from the date
    of the cutoff.
    """
    if cutoff.tzinfo is not None:
        cutoff = cutoff.astimezone(timezone.utc).replace(tzinfo=None)
    data = spark.read.parquet(path)
    day = F.lit(cutoff.date())
    # As text: a datetime literal would be shifted by the session time zone.
    limit = F.lit(str(cutoff)).cast("timestamp_ntz")
    recent = F.coalesce(F.col(time_column) >= limit, F.lit(True))
    date = F.col(date_partition)
    listing = dataset_files(spark, path)
    partitions = [c for c in listing.columns if c not in ("file_path", "file_size_in_bytes")]
    if date_partition not in partitions:
        raise ValueError(f"{path} is not partitioned by {date_partition}, but by {partitions}")
    older = listing.where(date < day).select(date_partition).distinct().count()
    edge = data.where(date == day)
    counted = edge.agg(F.count_if(recent).alias("kept"), F.count_if(~recent).alias("removed")).first()
    removed = counted.removed

    if dest is not None:
        kept = data.where(F.coalesce(date >= day, F.lit(True)) & recent)
        kept.write.partitionBy(*partitions).parquet(dest)
        rows = spark.read.schema(data.schema).parquet(dest).count()
        return spark.createDataFrame([(older, rows, removed)], _RESULT)

    exchange = Exchange(spark, path)
    rewritten = 0
    if removed:
        edge.where(recent).write.partitionBy(*partitions).parquet(exchange.rewritten)
        rewritten = spark.read.schema(data.schema).parquet(exchange.rewritten).count()
        if rewritten != counted.kept:
            raise RuntimeError(
                f"{exchange.rewritten} has {rewritten} rows instead of {counted.kept}; nothing dropped"
            )
    gone = listing.where(date <= day if removed else date < day)
    folders = gone.select(F.regexp_replace("file_path", "/[^/]*$", "").alias("entry")).distinct()
    exchange.run([exchange.relative(row.entry) for row in folders.toLocalIterator()])
    return spark.createDataFrame([(older, rewritten, removed)], _RESULT)
