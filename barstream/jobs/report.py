"""Print the bar count and the latest bars of a tick table, once or repeatedly.

``python -m barstream.jobs.report --path s3a://lake/ticks --interval 60``
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence

from ..functions.text import thousands
from ..operators.queries import display_bars, total_events
from ..session import session
from ..sources.ticks import latest_ticks, read_ticks


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--path", required=True)
    parser.add_argument("--interval", type=float, default=60, help="seconds between refreshes")
    parser.add_argument("--refreshes", type=int, help="how many; default without end")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = session("bar-report")
    done = 0
    while args.refreshes is None or done < args.refreshes:
        if done:
            time.sleep(args.interval)
        total = total_events(read_ticks(spark, args.path))
        total.select(thousands("total_events").alias("total_events")).show()
        display_bars(latest_ticks(spark, args.path)).show(truncate=False)
        done += 1


if __name__ == "__main__":
    main()
