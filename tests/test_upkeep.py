"""Packing of small files, upkeep by table name, and live stream counters."""

from __future__ import annotations

import random
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barstream import maintenance, sinks, sources, streaming
from barstream.maintenance.packing import best_fit
from barstream.plans import evidence, tables
from barstream.session import scratch
from barstream.sinks.starting import AVAILABLE_NOW


def _names(spark, path):
    return {r.file_path for r in maintenance.list_files(spark, path).collect()}


def test_best_fit_fills_bins_up_to_the_target():
    rng = random.Random(3)
    sizes = [rng.randint(0, 700) for _ in range(2_000)]
    bins = best_fit(sizes, 1_000)
    held: dict[int, int] = {}
    for size, at in zip(sizes, bins):
        held[at] = held.get(at, 0) + size
    assert max(held.values()) <= 1_000
    # At most one bin may be half empty, or two of them had been one.
    assert sum(v <= 500 for v in held.values()) <= 1
    assert len(held) <= 1.1 * sum(sizes) / 1_000 + 1
    assert best_fit([], 10) == [] and best_fit([5, 5, 5], 10) == [0, 0, 1]


@pytest.mark.parametrize("partitioned", [True, False])
def test_packing_leaves_large_files_alone(spark, partitioned):
    path = scratch(spark, "packed")
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("v"), (F.col("id") % 2).alias("day"))
    by = ["day"] if partitioned else []
    rows.where("id < 30000").coalesce(1).write.partitionBy(*by).parquet(path)
    large = _names(spark, path)
    for i in range(4):
        few = rows.where(f"id >= 30000 AND id div 2 % 4 = {i}").coalesce(1)
        few.write.mode("append").partitionBy(*by).parquet(path)
    small = _names(spark, path) - large
    target = maintenance.list_files(spark, path).first().file_size_in_bytes / 2**20

    planned = maintenance.compact_small(spark, path, target_mb=target, dry_run=True).first()
    assert _names(spark, path) == large | small
    done = maintenance.compact_small(spark, path, target_mb=target).first()
    assert done.files_packed == planned.files_packed == len(small)
    assert large <= _names(spark, path) and not small & _names(spark, path)
    assert len(_names(spark, path)) == done.files_after == planned.files_after < len(large) + len(small)
    assert done.rows == 10_000 and done.files_untouched == len(large)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(40_000))
    # Nothing is left to gain.
    assert maintenance.compact_small(spark, path, target_mb=target, share=0.1).first().files_packed == 0


def _table(spark, rows, by):
    name = f"kept_{uuid.uuid4().hex}"
    sinks.ctas(rows, name, partition_by=by, location=scratch(spark, "table"))
    return name


def test_tables_compact_by_name_and_keep_other_partitions(spark):
    kinds = F.when(F.col("id") % 3 == 0, "007").when(F.col("id") % 3 == 1, "it's/odd")
    rows = spark.range(3_000).select("id", kinds.alias("kind"), (F.col("id") % 2).alias("half"))
    name = _table(spark, rows.repartition(4), ["kind", "half"])

    def files():
        found = spark.table(name).select("kind", "half", F.col("_metadata.file_path").alias("f")).distinct()
        held: dict = {}
        for r in found.collect():
            held.setdefault((r.kind, r.half), set()).add(r.f)
        return held

    before = files()
    done = maintenance.compact_table(spark, name, where=F.col("half") == 1).first()
    after = files()
    assert done.partitions_compacted == 3 and done.rows == 1_500 and done.files_after == 3
    for key, names in after.items():
        assert len(names) == 1 if key[1] == 1 else names == before[key]
    held = spark.table(name)
    assert held.exceptAll(rows).count() == 0 == rows.exceptAll(held).count()
    assert maintenance.compact_table(spark, name, where=F.col("half") == 1).first().partitions_compacted == 0
    with pytest.raises(ValueError):
        maintenance.compact_table(spark, _table(spark, rows.limit(3), []))


def test_hot_partition_is_compacted_into_pieces(spark):
    rows = spark.range(60_000).select(F.xxhash64("id").alias("v"), F.lit(date(2024, 1, 1)).alias("trade_date"))
    name = _table(spark, rows.repartition(12), ["trade_date"])
    done = maintenance.compact_table(spark, name, target_mb=0.125).first()
    assert 1 < done.files_after < 12 and done.rows == 60_000


def test_retention_of_a_table(spark):
    def row(day, hour, symbol):
        return (datetime(2024, 1, day, hour), symbol, date(2024, 1, day))

    rows = [row(1, 9, "a"), row(2, 9, "a"), row(2, 15, "a"), row(2, 9, "b"), row(3, 1, "b"), (None, "c", None)]
    data = spark.createDataFrame(rows, "bar_time timestamp_ntz, symbol string, trade_date date")
    name = _table(spark, data, ["trade_date", "symbol"])
    done = maintenance.retain_table(spark, name, datetime(2024, 1, 2, 12)).first()
    assert tuple(done) == (2, 1, 2)
    left = {(r.bar_time, r.symbol) for r in spark.table(name).collect()}
    assert left == {(datetime(2024, 1, 2, 15), "a"), (datetime(2024, 1, 3, 1), "b"), (None, "c")}
    assert tuple(maintenance.retain_table(spark, name, datetime(2024, 1, 2, 12)).first()) == (0, 0, 0)
    with pytest.raises(ValueError):
        maintenance.retain_table(spark, name, datetime(2024, 1, 2), date_partition="day")


def test_listener_counts_more_batches_than_a_query_remembers(spark, sf_dir):
    base = scratch(spark, "listened")
    tables.junk(spark, sf_dir).repartition(104).write.parquet(f"{base}/in")
    source = sources.read_messages_stream(spark, f"{base}/in", files_per_trigger=1)
    with streaming.listening(spark, "flow") as metrics:
        flat = streaming.observe_flow(source, "flow")
        writer = sinks.starting.stream_writer(flat, f"{base}/checkpoint", AVAILABLE_NOW)
        running = writer.format("noop").start()
        metrics.drain(running)
    assert len(running.recentProgress) <= 100 < metrics.batches
    assert metrics.snapshot()["errors"] == tables.junk(spark, sf_dir).count()
    assert metrics.snapshot()["connection_status"] is False
    # A listener that is gone counts no more, and an unseen query has no end to wait for.
    with pytest.raises(TimeoutError):
        streaming.FlowMetrics("flow").drain(running, timeout=0.1)


def test_spoiled_messages_hold_every_kind(spark, sf_dir):
    texts = {r.key.decode(): r.value.decode() for r in evidence.spoiled_messages(spark, sf_dir).collect()}
    assert '"zz":1' in texts["1"] and '"v":{}' in texts["4"] and '"o":"' in texts["2"]
    assert texts["3"].count('"n":') == 90 and texts["0"].count('"n":') == 100
