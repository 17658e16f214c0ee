"""File listings and statistics of a dataset.

The listing comes from Spark's file source with its content column pruned: one
row per file, no file is opened, however many rows the dataset has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizes import average_or_zero, megabytes

PARQUET_FILES = "*.parquet"
_LISTING = ("path", "modificationTime", "length", "content")


def dataset_files(spark: SparkSession, path: str, pattern: str = PARQUET_FILES) -> DataFrame:
    """One row per file: path, size, and the dataset's partition columns."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    partitions = [c for c in listing.columns if c not in _LISTING]
    return listing.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size_in_bytes"),
        *partitions,
    )


def list_files(spark: SparkSession, path: str, pattern: str = PARQUET_FILES) -> DataFrame:
    """The files of a dataset, largest first."""
    files = dataset_files(spark, path, pattern)
    return files.orderBy(F.desc("file_size_in_bytes"), "file_path")


def file_stats(spark: SparkSession, path: str, pattern: str = PARQUET_FILES) -> DataFrame:
    """Number of files, total bytes and MB, average MB; zeros for an empty dataset."""
    return stats_of(dataset_files(spark, path, pattern))


def stats_of(files: DataFrame) -> DataFrame:
    """The statistics of a listing."""
    totals = files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("file_size_in_bytes"), F.lit(0)).alias("total_bytes"),
    )
    size = megabytes(F.col("total_bytes"))
    return totals.select(
        "file_count",
        "total_bytes",
        size.alias("total_mb"),
        average_or_zero(size, F.col("file_count")).alias("avg_file_size_mb"),
    )
