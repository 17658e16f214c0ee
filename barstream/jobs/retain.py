"""Drop the rows of the tick table that are older than a number of days or a time.

``python -m barstream.jobs.retain --path s3a://lake/ticks --days 365``
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from ..maintenance.catalog import retain_table
from ..maintenance.retain import retain_since
from ..session import session


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--path")
    target.add_argument("--table", help="a table partitioned by date, committed in the catalog")
    parser.add_argument("--dest", help="write the retained rows there instead of in place")
    limit = parser.add_mutually_exclusive_group(required=True)
    limit.add_argument("--days", type=float, help="keep rows of the last so many days")
    limit.add_argument("--since", type=datetime.fromisoformat, help="keep rows from this time on (UTC)")
    args = parser.parse_args(argv)
    if args.table and args.dest:
        parser.error("--dest goes with --path")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    cutoff = args.since or datetime.now(timezone.utc) - timedelta(days=args.days)
    spark = session("bar-retention")
    if args.table:
        done = retain_table(spark, args.table, cutoff)
    else:
        done = retain_since(spark, args.path, cutoff, dest=args.dest)
    done.show(truncate=False)


if __name__ == "__main__":
    main()
