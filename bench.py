"""Times the headline queries and prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``.  The messages
and the compacted tick table are stored before the clock starts; each figure is
the median of three warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from barstream import sinks
from barstream.maintenance import compact
from barstream.operators import batching, queries
from barstream.operators.flatten import flatten_messages
from barstream.operators.numbering import number_rows
from barstream.operators.wire import to_wire
from barstream.plans import tables
from barstream.session import scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = 3


def start() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("barstream-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barstream-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = start()
    stored = scratch(spark, "bench-messages")
    tables.messages(spark, SF_DIR).repartition(int(CPUS)).write.parquet(stored)
    messages = spark.read.parquet(stored)
    ticks_at = scratch(spark, "bench-ticks")
    sinks.load_ticks(flatten_messages(messages), ticks_at)
    compact(spark, ticks_at)
    ticks = spark.read.parquet(ticks_at)
    bars = tables.bars(spark, SF_DIR)
    requested, seen = tables.customers(spark, SF_DIR), tables.orders_as_bars(spark, SF_DIR)

    timed = {
        "flatten_messages": lambda: drain(flatten_messages(messages)),
        "flatten_strict": lambda: drain(flatten_messages(messages, mode="strict")),
        "to_wire": lambda: drain(to_wire(flatten_messages(messages, typed_time=False))),
        "count_by_symbol": lambda: queries.count_by_symbol(
            flatten_messages(messages, columns=["symbol"])
        ).collect(),
        "latest_bars": lambda: queries.latest_bars(flatten_messages(messages)).collect(),
        "resample_bars": lambda: drain(queries.resample_bars(flatten_messages(messages))),
        "ticks_count_by_symbol": lambda: queries.count_by_symbol(ticks).collect(),
        "ticks_latest_bars": lambda: queries.latest_bars(ticks).collect(),
        "ticks_profile_symbol": lambda: queries.profile_symbol(ticks, "click").collect(),
        "ticks_daily_counts": lambda: queries.daily_counts(ticks, "click").collect(),
        "ticks_resample_bars": lambda: drain(queries.resample_bars(ticks)),
        "number_rows": lambda: drain(number_rows(bars, ["bar_time", "event_id"], ["symbol"])),
        "repack_messages": lambda: drain(
            batching.repack_messages(bars, order_by=["bar_time", "event_id"])
        ),
        "symbol_coverage": lambda: batching.symbol_coverage(requested, seen).collect(),
    }
    seconds = {}
    for name, run in timed.items():
        run()
        times = []
        for _ in range(RUNS):
            began = time.perf_counter()
            run()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 4)
    arrays = messages.count()
    report = {
        "metric": "total of median warm query times",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "flattened_messages_per_second": round(arrays / seconds["flatten_messages"]),
        "flattened_bars_per_second": round(bars.count() / seconds["flatten_messages"]),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
