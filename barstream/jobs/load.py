"""Load messages or history lines into the tick table, and say which lines were bad.

``python -m barstream.jobs.load --history s3a://lake/history --path s3a://lake/ticks``
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from ..operators.flatten import flatten_messages
from ..operators.history import normalise_bars
from ..session import session, staged
from ..sinks.lake import load_ticks
from ..sources.history import split_history
from ..sources.messages import read_messages


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--history", help="newline-delimited JSON history")
    source.add_argument("--messages", help="directory of message files")
    parser.add_argument("--path", required=True, help="the tick table")
    parser.add_argument("--fill-defaults", action="store_true", help="absent numbers become 0")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = session("bar-load")
    if args.messages:
        bars = flatten_messages(read_messages(spark, args.messages))
    else:
        # Stored, so that the lines are parsed once for the table and for the counts.
        lines = staged(split_history(spark.read.text(args.history)), "history-lines")
        lines.groupBy("reason").agg(F.count(F.lit(1)).alias("lines")).orderBy("reason").show(truncate=False)
        bars = normalise_bars(lines.where("reason IS NULL"))
    load_ticks(bars, args.path, fill_defaults=args.fill_defaults, rebalance=True)


if __name__ == "__main__":
    main()
