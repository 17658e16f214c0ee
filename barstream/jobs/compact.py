"""Compact a Parquet dataset or a catalog table and print its statistics before and after.

``python -m barstream.jobs.compact --path s3a://lake/ticks
--partition-filter "trade_date >= '2023-02-06'"``, or ``--table ticks`` in place of the path
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from ..functions.sizes import megabytes
from ..maintenance.catalog import compact_table
from ..maintenance.compact import TARGET_MB, compact
from ..maintenance.packing import compact_small
from ..session import session


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--path")
    target.add_argument("--table", help="a partitioned table, committed in the catalog")
    parser.add_argument("--dest", help="write the compacted data there instead of in place")
    parser.add_argument("--target-file-size-mb", type=float, default=TARGET_MB)
    parser.add_argument("--partition-filter", help="SQL condition on partition columns")
    parser.add_argument("--small-files", action="store_true", help="pack small files only, leave others alone")
    parser.add_argument("--dry-run", action="store_true", help="report only")
    args = parser.parse_args(argv)
    if args.table and (args.dest or args.dry_run or args.small_files):
        parser.error("--table takes neither --dest nor --dry-run nor --small-files")
    if args.small_files and args.dest:
        parser.error("--small-files works in place")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = session("bar-compaction")
    how = {
        "target_mb": args.target_file_size_mb,
        "where": F.expr(args.partition_filter) if args.partition_filter else None,
    }
    if args.table:
        compact_table(spark, args.table, **how).show(truncate=False, vertical=True)
        return
    if args.small_files:
        compact_small(spark, args.path, dry_run=args.dry_run, **how).show(truncate=False, vertical=True)
        return
    result = compact(spark, args.path, dest=args.dest, dry_run=args.dry_run, **how)
    sizes = {
        name.replace("bytes", "mb"): F.round(megabytes(F.col(name)), 2)
        for name in ("bytes_before", "bytes_after")
    }
    result.withColumns(sizes).show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
