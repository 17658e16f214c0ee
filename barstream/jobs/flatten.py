"""Flatten a topic of bar arrays into a topic of bars and a raw table.

``python -m barstream.jobs.flatten --brokers host:9092 --source-topic in --dest-topic out
--raw-table lake.raw --checkpoint s3a://jobs/flatten``

Source and message sink may be directories of Parquet files instead of topics.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from ..operators.flatten import MODES
from ..schema import TIME_FIELD
from ..session import session
from ..sinks.lake import RAW_INTERVAL
from ..sources.messages import OFFSETS, read_messages_stream
from ..streaming.fanout import OUTPUT_MODES, Outputs, run_pipeline, start_once


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_argument_group("source")
    source.add_argument("--brokers", help="message brokers, for topics")
    source.add_argument("--source-topic")
    source.add_argument("--source-path", help="directory of message files instead of a topic")
    source.add_argument("--starting-offsets", choices=OFFSETS, default="latest")
    source.add_argument("--max-offsets-per-trigger", type=int, help="messages of a topic in one micro-batch")
    source.add_argument("--max-files-per-trigger", type=int, help="files of a directory in one micro-batch")
    sink = parser.add_argument_group("sinks")
    sink.add_argument("--output-mode", choices=sorted(OUTPUT_MODES), default="both")
    sink.add_argument("--dest-topic")
    sink.add_argument("--dest-path", help="directory for flat messages instead of a topic")
    sink.add_argument("--raw-table", help="database.table for the raw messages")
    sink.add_argument("--raw-path", help="directory for the raw messages instead of a table")
    sink.add_argument("--raw-format", default="parquet")
    sink.add_argument("--checkpoint", required=True, help="base directory; each sink has its own below")
    job = parser.add_argument_group("job")
    job.add_argument("--parse-mode", choices=MODES, default=MODES[0])
    job.add_argument("--time-field", default=TIME_FIELD, help="name of the time in flat messages")
    job.add_argument("--keep-nulls", action="store_true", help="write absent fields as null")
    job.add_argument("--single-read", action="store_true", help="feed both directories from one query")
    job.add_argument("--trigger", help="interval of the message sink; default as fast as possible")
    job.add_argument("--processing-time", default=RAW_INTERVAL, help="interval of the raw sink")
    job.add_argument("--app-name", default="bar-flattener")
    job.add_argument("--log-level", choices=["DEBUG", "INFO", "WARN", "ERROR"], default="WARN")
    args = parser.parse_args(argv)

    if not args.source_path and not (args.brokers and args.source_topic):
        parser.error("give --source-path, or --brokers and --source-topic")
    sinks = OUTPUT_MODES[args.output_mode]
    if "messages" in sinks and not args.dest_path and not (args.brokers and args.dest_topic):
        parser.error("give --dest-path, or --brokers and --dest-topic")
    if "raw" in sinks:
        if bool(args.raw_path) == bool(args.raw_table):
            parser.error("give either --raw-path or --raw-table")
        if args.raw_table and "." not in args.raw_table:
            parser.error(f"--raw-table must be database.table, not {args.raw_table!r}")
    if args.single_read and not (args.output_mode == "both" and args.dest_path and args.raw_path):
        parser.error("--single-read takes output mode both, --dest-path and --raw-path")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = session(args.app_name)
    spark.sparkContext.setLogLevel(args.log_level)
    source = read_messages_stream(
        spark,
        args.source_path,
        brokers=args.brokers,
        topic=args.source_topic,
        starting_offsets=args.starting_offsets,
        files_per_trigger=args.max_files_per_trigger,
        offsets_per_trigger=args.max_offsets_per_trigger,
    )
    targets = Outputs(
        checkpoint=args.checkpoint,
        messages_path=args.dest_path,
        brokers=args.brokers,
        topic=args.dest_topic,
        raw_path=args.raw_path,
        raw_table=args.raw_table,
        raw_format=args.raw_format,
    )
    settings = {
        "mode": args.parse_mode,
        "time_field": args.time_field,
        "keep_nulls": args.keep_nulls,
        "trigger": args.trigger,
    }
    if args.single_read:
        start_once(source, targets, **settings).awaitTermination()
        return
    run_pipeline(source, args.output_mode, targets, raw_trigger=args.processing_time, **settings)


if __name__ == "__main__":
    main()
