"""Replay history or stored messages to a message sink, in order and at a pace.

``python -m barstream.jobs.replay --history s3a://lake/history --staged s3a://lake/replay
--out s3a://lake/replayed --interval 10``
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.batching import BARS_PER_MESSAGE, as_messages, repack_messages
from ..operators.history import normalise_bars
from ..session import session
from ..sources.history import read_history
from ..sources.messages import read_messages
from ..streaming.replay import REPLAY_INTERVAL, replay_messages, stage_replay


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--history", help="newline-delimited JSON history")
    source.add_argument("--messages", help="directory of message files")
    parser.add_argument("--staged", required=True, help="where the numbered messages are kept; goes on if there")
    parser.add_argument("--out", required=True, help="the message sink, a directory per turn")
    parser.add_argument("--bars-per-message", type=int, default=BARS_PER_MESSAGE)
    parser.add_argument("--messages-per-turn", type=int, default=1)
    parser.add_argument("--interval", type=float, help=f"seconds between turns; {REPLAY_INTERVAL} unless given")
    return parser.parse_args(argv)


def _staged(spark, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = session("bar-replay")
    if not _staged(spark, args.staged):
        if args.messages:
            messages = read_messages(spark, args.messages)
        else:
            bars = normalise_bars(read_history(spark, args.history))
            packed = repack_messages(bars, args.bars_per_message, ["bar_time", "symbol"], unique=False)
            messages = as_messages(packed, "bars")
        stage_replay(messages, args.staged)

    def send(sent: DataFrame, turn: int) -> None:
        # A turn that is sent again takes the place of what it had written.
        sent.write.mode("overwrite").parquet(f"{args.out}/turn={turn}")

    trigger = REPLAY_INTERVAL if args.interval is None else f"{args.interval} seconds"
    replay_messages(
        spark,
        args.staged,
        send,
        checkpoint=f"{args.staged}-checkpoint",
        messages_per_trigger=args.messages_per_turn,
        trigger=trigger if args.interval != 0 else None,
    )


if __name__ == "__main__":
    main()
