"""Compaction: many small files rewritten as few files of a target size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged
from .files import dataset_files, stats_of
from .swap import Exchange, plain_path

#: Size of a compacted file unless the caller says otherwise.
TARGET_MB = 512

_FILE = "_file"
_ROW = "_row"
_RESULT = (
    "dry_run boolean, rows bigint, files_before bigint, bytes_before bigint, "
    "files_after bigint, bytes_after bigint, files_reduced bigint"
)


def compact(
    spark: SparkSession,
    path: str,
    *,
    target_mb: float = TARGET_MB,
    where: Column | None = None,
    sort_by: Sequence[str] = (),
    dest: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Rewrite the dataset at ``path`` into files of about ``target_mb``.

    ``where`` selects partitions and may use partition columns only.  Partitions
    that already have as few files as their size allows are left alone.  Rows keep
    their order, or are sorted by ``sort_by`` within each file.  With ``dest`` the
    whole dataset is written there, partitions left alone in as many files as before,
    and ``path`` stays as it is; without, the compacted partitions take the place of
    the old files.  ``dry_run`` only reports.

    Returns one row with rows rewritten, files and bytes of the whole dataset before
    and after, and the number of files saved.
    """
    data = spark.read.parquet(path)
    listing = dataset_files(spark, path)
    partitions = [c for c in listing.columns if c not in ("file_path", "file_size_in_bytes")]
    before = stats_of(listing).first()
    counts = _row_counts(data, partitions, where)
    # One row per file, used several times: stored once.
    target_bytes = int(target_mb * 1024 * 1024)
    plan = staged(_slots(counts, partitions, target_bytes, dest is not None), "compaction-plan")
    totals = plan.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.max(F.col("first_slot") + F.col("slots")), F.lit(0)).alias("slots"),
    ).first()

    def report(files_after: int, bytes_after: int | None) -> DataFrame:
        result = (
            dry_run,
            totals.rows,
            before.file_count,
            before.total_bytes,
            files_after,
            bytes_after,
            before.file_count - files_after,
        )
        return spark.createDataFrame([result], _RESULT)

    if dry_run or totals.slots == 0:
        planned = before.file_count - totals.files + totals.slots
        return report(planned, before.total_bytes if totals.slots == 0 else None)

    exchange = None if dest else Exchange(spark, path)
    target = dest or exchange.rewritten
    # Names of the partition directories to rewrite; only those are read again.
    folder = F.regexp_replace("file_path", "/[^/]*$", "")
    folders = [r.entry for r in plan.select(folder.alias("entry")).distinct().toLocalIterator()]
    chosen = (
        spark.read.schema(data.schema)
        .option("basePath", path)
        .parquet(*[plain_path(spark, uri) for uri in folders])
    )
    _rewrite(chosen, plan, totals.slots, partitions, sort_by, target)
    written = spark.read.parquet(target).count()
    if written != totals.rows:
        raise RuntimeError(f"{target} has {written} rows instead of {totals.rows}; nothing replaced")
    if exchange:
        old = folders if partitions else [r.file_path for r in plan.select("file_path").toLocalIterator()]
        exchange.run([exchange.relative(uri) for uri in old])
    after = stats_of(dataset_files(spark, dest or path)).first()
    return report(after.file_count, after.total_bytes)


def _row_counts(data: DataFrame, partitions: list[str], where: Column | None) -> DataFrame:
    """One row per data file: path, size, rows.  Reads file footers, no columns."""
    files = data.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size"),
        *partitions,
    )
    counts = files.groupBy("file_path", "size", *partitions).agg(F.count(F.lit(1)).alias("rows"))
    # Applied to partition columns only: any other column is an analysis error here.
    chosen = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return counts.withColumn("chosen", chosen)


def _slots(files: DataFrame, partitions: list[str], target: int, every: bool) -> DataFrame:
    """Which output files each input file's bytes go to.

    Laid end to end, a partition's files are cut into equal pieces of at most the
    target size; a piece is an output file and has a number of its own.  Partitions
    that save no file are left out, or with ``every`` cut into as many as they have.
    """
    same = Window.partitionBy(*partitions) if partitions else Window.partitionBy(F.lit(0))
    earlier = same.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    fewest = F.least(F.ceil(F.col("total") / target), F.col("files"))
    laid_out = (
        files.withColumn("total", F.sum("size").over(same))
        .withColumn("files", F.count(F.lit(1)).over(same))
        .withColumn("slots", F.when(F.col("chosen"), fewest).otherwise(F.col("files")))
        .withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .where(F.lit(True) if every else F.col("files") > F.col("slots"))
    )
    wanted = ("file_path", "rows", "size", "start", "total", "slots", "first_slot")
    if not partitions:
        return laid_out.withColumn("first_slot", F.lit(0).cast("bigint")).select(*wanted)
    # Numbers the pieces over all partitions: one row per partition directory.
    numbered = Window.orderBy(*partitions).rowsBetween(Window.unboundedPreceding, -1)
    firsts = laid_out.groupBy(*partitions).agg(F.max("slots").alias("_n"))
    firsts = firsts.select(
        *[F.col(c).alias(f"_p_{c}") for c in partitions],
        F.coalesce(F.sum("_n").over(numbered), F.lit(0)).alias("first_slot"),
    )
    same_partition = reduce(
        and_, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partitions]
    )
    return laid_out.join(firsts, same_partition).select(*wanted)


def _rewrite(
    data: DataFrame,
    plan: DataFrame,
    slots: int,
    partitions: list[str],
    sort_by: Sequence[str],
    target: str,
) -> None:
    """Write each slot as one file."""
    rows = data.select(
        "*",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.row_index").alias(_ROW),
    )
    place = F.col("start") + F.col("size") * F.col(_ROW) / F.col("rows")
    piece = F.floor(place * F.col("slots") / F.col("total"))
    placed = rows.join(plan, rows[_FILE] == plan["file_path"]).withColumn(
        "_slot", (F.col("first_slot") + F.least(piece, F.col("slots") - 1)).cast("int")
    )
    (
        placed.repartitionById(slots, "_slot")
        .sortWithinPartitions(*partitions, *(sort_by or (_FILE, _ROW)))
        .select(*data.columns)
        .write.partitionBy(*partitions)
        .parquet(target)
    )
