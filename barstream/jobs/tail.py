"""Print a topic's messages from its first one on.

``python -m barstream.jobs.tail --brokers host:9092 --topic bars``
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from ..session import session
from ..sinks.console import write_console
from ..sources.messages import OFFSETS, read_messages_stream


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--brokers")
    parser.add_argument("--topic")
    parser.add_argument("--path", help="directory of message files instead of a topic")
    parser.add_argument("--starting-offsets", choices=OFFSETS, default="earliest")
    parser.add_argument("--trigger", help="interval, or available-now to stop at the end")
    args = parser.parse_args(argv)
    if not args.path and not (args.brokers and args.topic):
        parser.error("give --path, or --brokers and --topic")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    messages = read_messages_stream(
        session("bar-tail"),
        args.path,
        brokers=args.brokers,
        topic=args.topic,
        starting_offsets=args.starting_offsets,
    )
    texts = [F.col(name).cast("string").alias(name) for name in ("key", "value")]
    shown = messages.select("topic", "partition", "offset", *texts)
    write_console(shown, args.trigger).awaitTermination()


if __name__ == "__main__":
    main()
