"""Upkeep of partitioned catalog tables, committed partition by partition in the catalog.

New data goes to directories of its own and ``ALTER TABLE … PARTITION … SET LOCATION``
points the table at them; no file is moved or renamed, so the commit costs the same
on an object store.  A reader that has listed the old files finishes on them: they
stay where they are until the folder's own clean-up removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import setting
from .compact import TARGET_MB
from .files import PARQUET_FILES, dataset_files

_COMPACTED = "partitions_compacted bigint, rows bigint, files_before bigint, files_after bigint"
_RETAINED = "partitions_dropped bigint, rows_rewritten bigint, rows_removed bigint"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{table} has no location")
    return rows[0].data_type.rstrip("/")


def _spec(partitions: Sequence[str], values: Sequence) -> str:
    """A partition as SQL; values as text, which the catalog casts to the column's type."""
    return ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(partitions, values))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _folders(rows: DataFrame) -> DataFrame:
    """``rows`` of data files with the directory of each file as ``folder``."""
    return rows.withColumn("folder", F.regexp_extract("file_path", "^(.*)/", 1))


def _files(data: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """One row per file the table reads now: directory, size, rows, partition columns."""
    files = data.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"), *partitions
    )
    counted = files.groupBy("file_path", "size", *partitions).agg(F.count(F.lit(1)).alias("rows"))
    return _folders(counted)


def _point_at(spark: SparkSession, table: str, partitions: Sequence[str], written: str) -> int:
    """Point the partitions found below ``written`` at their new directories."""
    # As text: a value like 007 would be read as a number and name another partition.
    with setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        listing = dataset_files(spark, written, PARQUET_FILES)
    found = _folders(listing).select("folder", *partitions).distinct()
    moved = 0
    for row in found.toLocalIterator():
        spec = _spec(partitions, [row[c] for c in partitions])
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {_literal(row.folder)}")
        moved += 1
    spark.catalog.refreshTable(table)
    return moved


def compact_table(
    spark: SparkSession,
    table: str,
    *,
    target_mb: float = TARGET_MB,
    where: Column | None = None,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Rewrite the partitions of ``table`` that have more files than their size asks for.

    ``where`` selects partitions and may use partition columns only.  A partition of
    ``b`` bytes is written as ``ceil(b / target)`` files, its rows spread by hash, so a hot partition is written by many tasks; ``sort_by`` orders each file.
    Partitions left alone are not read.  The rows are counted before the catalog
    changes.  Returns partitions, rows, and files of those partitions before and after.
    """
    partitions = partition_columns(spark, table)
    if not partitions:
        raise ValueError(f"{table} is not partitioned; use compact on its location")
    data = spark.table(table)
    files = _files(data, partitions)
    if where is not None:
        files = files.where(F.coalesce(where, F.lit(False)))
    target = int(target_mb * 1024 * 1024)
    # One row per partition.
    sizes = files.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("_files"),
        F.sum("rows").alias("_rows"),
        F.ceil(F.sum("size") / target).cast("int").alias("_pieces"),
    )
    plan = sizes.where("_files > _pieces").collect()
    if not plan:
        return spark.createDataFrame([(0, 0, 0, 0)], _COMPACTED)
    firsts = accumulate((r["_pieces"] for r in plan), initial=0)
    kinds = ", ".join(f"`_p_{c}` {data.schema[c].dataType.simpleString()}" for c in partitions)
    wanted = spark.createDataFrame(
        [(*[r[c] for c in partitions], r["_pieces"], first) for r, first in zip(plan, firsts)],
        f"{kinds}, _pieces int, _first int",
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partitions])
    payload = [c for c in data.columns if c not in partitions]
    slot = F.col("_first") + F.pmod(F.xxhash64(*payload), F.col("_pieces")).cast("int")
    written = f"{table_location(spark, table)}/_compacted-{uuid.uuid4().hex}"
    rows = data.join(wanted, same).repartitionById(sum(r["_pieces"] for r in plan), slot)
    rows = rows.sortWithinPartitions(*partitions, *sort_by)
    rows.select(*data.columns).write.partitionBy(*partitions).parquet(written)
    copied = spark.read.parquet(written).count()
    expected = sum(r["_rows"] for r in plan)
    if copied != expected:
        raise RuntimeError(f"{written} has {copied} rows instead of {expected}; nothing replaced")
    moved = _point_at(spark, table, partitions, written)
    after = dataset_files(spark, written, PARQUET_FILES).count()
    return spark.createDataFrame([(moved, copied, sum(r["_files"] for r in plan), after)], _COMPACTED)


def retain_table(
    spark: SparkSession,
    table: str,
    cutoff: datetime,
    *,
    time_column: str = "bar_time",
    date_partition: str = "trade_date",
) -> DataFrame:
    """Drop the rows of ``table`` whose time lies before ``cutoff`` (UTC unless it says otherwise).

    Older dates are dropped from the catalog unread; the date that holds the cutoff is
    written anew and pointed at.  Rows and partitions without a time or date are kept.
    Returns partitions dropped, rows written and rows removed from the date of the cutoff.
    """
    if cutoff.tzinfo is not None:
        cutoff = cutoff.astimezone(timezone.utc).replace(tzinfo=None)
    partitions = partition_columns(spark, table)
    if date_partition not in partitions:
        raise ValueError(f"{table} is not partitioned by {date_partition}, but by {partitions}")
    data = spark.table(table)
    day, date = F.lit(cutoff.date()), F.col(date_partition)
    recent = F.coalesce(F.col(time_column) >= F.lit(str(cutoff)).cast("timestamp_ntz"), F.lit(True))
    edge = data.where(date == day)
    kept, removed = edge.agg(F.count_if(recent), F.count_if(~recent)).first()
    # Partitions of the date of the cutoff that keep no row go as a whole as well.
    empty = edge.groupBy(*partitions).agg(F.count_if(recent).alias("_kept")).where("_kept = 0").drop("_kept")
    # Partition columns only: no column is read from the files.
    older = data.where(date < day).select(*partitions).distinct().collect()
    gone = older + (empty.collect() if removed else [])
    rewritten = 0
    if removed and kept:
        written = f"{table_location(spark, table)}/_retained-{uuid.uuid4().hex}"
        edge.where(recent).write.partitionBy(*partitions).parquet(written)
        rewritten = spark.read.parquet(written).count()
        if rewritten != kept:
            raise RuntimeError(f"{written} has {rewritten} rows instead of {kept}; nothing dropped")
        _point_at(spark, table, partitions, written)
    for row in gone:
        spec = _spec(partitions, [row[c] for c in partitions])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)
    return spark.createDataFrame([(len(gone), rewritten, removed)], _RETAINED)
