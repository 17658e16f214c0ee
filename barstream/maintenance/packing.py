"""Compaction that leaves good files alone: small files packed into bins."""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..session import staged
from .compact import TARGET_MB
from .files import PARQUET_FILES
from .swap import Exchange, plain_path

#: Files below this share of the target size are packed; larger ones stay as they are.
SMALL_SHARE = 0.75
#: Bins and files a lane is expected to hold; lanes bound a task and leave a part-filled bin each.
BINS_PER_LANE = 256
FILES_PER_LANE = 16_384

_FILE = "_file"
_ROW = "_row"
_SLOT = "_slot"
_RESULT = (
    "dry_run boolean, files_before bigint, files_packed bigint, bins bigint, "
    "files_after bigint, files_untouched bigint, rows bigint"
)


def small_files(spark: SparkSession, path: str, target: int, share: float = SMALL_SHARE) -> DataFrame:
    """One row per data file from the listing: path, size, partition columns, ``small``.

    No file is opened.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", PARQUET_FILES).load(path)
    content = ("path", "modificationTime", "length", "content")
    return listing.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size"),
        (F.col("_metadata.file_size") < int(target * share)).alias("small"),
        *[c for c in listing.columns if c not in content],
    )


def best_fit(sizes: Sequence[int], target: int) -> list[int]:
    """The bin of each size: largest first, each into the fullest bin that takes it."""
    bins = [0] * len(sizes)
    free: list[tuple[int, int]] = []
    opened = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect.bisect_left(free, (sizes[i], -1))
        if at < len(free):
            room, bins[i] = free.pop(at)
        else:
            room, bins[i] = target, opened
            opened += 1
        bisect.insort(free, (room - sizes[i], bins[i]))
    return bins


def pack_plan(files: DataFrame, target: int) -> DataFrame:
    """``file_path, size, slot`` of the files worth rewriting; slots count the bins from 0.

    Bins never cross directories, so neither partitions.  A directory's small files are
    spread over as many lanes as keep a lane at about ``BINS_PER_LANE`` bins, so a large
    directory is packed by many tasks.  A file that has a bin to itself is left out, as
    rewriting it would gain nothing.
    """
    small = files.where("small").select(
        "file_path", "size", F.regexp_extract("file_path", "^(.*)/", 1).alias("folder")
    )
    lanes = small.groupBy("folder").agg(
        F.greatest(
            F.ceil(F.sum("size") / (target * BINS_PER_LANE)), F.ceil(F.count(F.lit(1)) / FILES_PER_LANE), F.lit(1)
        ).alias("lanes")
    )
    placed = small.join(lanes, "folder").withColumn("lane", F.pmod(F.xxhash64("file_path"), "lanes")).drop("lanes")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("file_path").reset_index(drop=True)
        rows["nth"] = best_fit(rows["size"].tolist(), target)
        return rows[rows.groupby("nth")["nth"].transform("size") > 1]

    packed = staged(
        placed.groupBy("folder", "lane").applyInPandas(
            pack, "file_path string, size bigint, folder string, lane bigint, nth bigint"
        ),
        "packed-files",
    )
    key = ["folder", "lane", "nth"]
    slots = number_rows(packed.select(*key).distinct(), key, name="slot")
    return packed.join(slots, key).select("file_path", "size", "slot")


def compact_small(
    spark: SparkSession,
    path: str,
    *,
    target_mb: float = TARGET_MB,
    share: float = SMALL_SHARE,
    where: Column | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Merge the small files of the dataset at ``path``; files near the target stay.

    Files below ``share`` of the target are packed into bins of at most ``target_mb``
    within their partition, and each bin becomes one file.  All other files keep their names and are not
    read.  ``where`` selects partitions and may use partition columns only.  Rows keep
    their order within a bin.  An empty dataset, or one without two small files in any
    partition, is left as it is.

    Only the names of the files to rewrite pass the driver, where Spark's own file
    index has them anyway.  Rows are counted before anything is replaced.
    """
    target = int(target_mb * 1024 * 1024)
    files = small_files(spark, path, target, share)
    partitions = [c for c in files.columns if c not in ("file_path", "size", "small")]
    before = files.count()
    chosen = files if where is None else files.where(F.coalesce(where, F.lit(False)))
    # One row per file to rewrite, used several times: stored once.
    plan = staged(pack_plan(chosen, target), "pack-plan")
    packed, bins = plan.agg(F.count(F.lit(1)), F.coalesce(F.max("slot") + 1, F.lit(0))).first()

    def report(rows: int | None) -> DataFrame:
        counts = (before, packed, bins, before - packed + bins, before - packed, rows)
        return spark.createDataFrame([(dry_run, *counts)], _RESULT)

    if dry_run or not packed:
        return report(None if dry_run else 0)
    names = [row.file_path for row in plan.select("file_path").toLocalIterator()]
    exchange = Exchange(spark, path)
    schema = spark.read.parquet(path).schema
    data = spark.read.schema(schema).option("basePath", path).parquet(*[plain_path(spark, n) for n in names])
    rows = data.select(
        "*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW)
    ).join(plan.select(F.col("file_path").alias(_FILE), F.col("slot").cast("int").alias(_SLOT)), _FILE)
    (
        rows.repartitionById(bins, _SLOT)
        .sortWithinPartitions(*partitions, _FILE, _ROW)
        .select(*data.columns)
        .write.partitionBy(*partitions)
        .parquet(exchange.rewritten)
    )
    copied = spark.read.schema(schema).parquet(exchange.rewritten).count()
    expected = data.count()
    if copied != expected:
        raise RuntimeError(f"{exchange.rewritten} has {copied} rows instead of {expected}; nothing replaced")
    exchange.run([exchange.relative(n) for n in names])
    return report(copied)
