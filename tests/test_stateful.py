"""Streams that keep state: resampling, and the tick table with its report."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barstream import sources, streaming
from barstream.plans import stateful
from barstream.sinks.starting import AVAILABLE_NOW
from barstream.streaming import report

START = datetime(2024, 3, 1)


def bar(symbol, minutes, close=1.0):
    at = START + timedelta(minutes=minutes)
    return ("b", symbol, close, close, close, close, 10, at, 1, close)


def deliver(spark, path, *turns):
    """Each turn's bars as one file, in order."""
    for rows in turns:
        spark.createDataFrame(rows, sources.ticks._ddl()).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return sources.read_ticks_stream(spark, path, files_per_trigger=1)


@pytest.fixture()
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def resampled(spark, path, out, mark):
    query = streaming.resample_stream(
        stream(spark, path), out, to="1Hour", watermark="10 minutes", checkpoint=mark, trigger=AVAILABLE_NOW
    )
    query.awaitTermination()
    return query


def test_late_bars_count_until_their_window_has_closed(spark, folder):
    path, out = folder("in"), folder("out")
    deliver(
        spark,
        path,
        [bar("a", 5), bar("a", 59), bar("b", 30)],
        [bar("a", 75)],  # the mark reaches 65 minutes: the first hour closes after this turn
        [bar("a", 58, 7.0), bar("a", 190)],  # late, but of the turn that closes the window
        [bar("a", 57, 9.0), bar("b", 100)],  # late beyond it
        [bar("a", 400)],
    )
    query = resampled(spark, path, out, folder("mark"))
    rows = {(r.symbol, r.bar_time): (r.volume, r.high, r.close) for r in spark.read.parquet(out).collect()}
    hour = lambda n: START + timedelta(hours=n)
    assert rows[("a", hour(0))] == (30, 7.0, 1.0)
    assert rows[("b", hour(0))] == (10, 1.0, 1.0)
    assert rows[("a", hour(1))] == (10, 1.0, 1.0) and rows[("a", hour(3))] == (10, 1.0, 1.0)
    assert rows[("b", hour(1))] == (10, 1.0, 1.0) and len(rows) == 5
    assert sum(streaming.late_rows(p) for p in query.recentProgress) >= 1


def test_resampling_goes_on_from_its_checkpoint(spark, folder):
    path, out, mark = folder("in"), folder("out"), folder("mark")
    deliver(spark, path, [bar("a", 5), bar("a", 20)])
    resampled(spark, path, out, mark)
    deliver(spark, path, [bar("a", 50, 3.0)], [bar("a", 600)])
    resampled(spark, path, out, mark)
    resampled(spark, path, out, mark)
    rows = [(r.symbol, r.bar_time, r.volume, r.close) for r in spark.read.parquet(out).collect()]
    assert rows == [("a", START, 30, 3.0)]


def test_resampling_takes_a_stream(spark, folder):
    with pytest.raises(ValueError, match="stream"):
        streaming.resample_stream(spark.range(1), folder("out"), checkpoint=folder("mark"))


def test_turns_bring_bars_that_come_too_late(spark, sf_dir):
    """The query's input has bars both of windows still open and of closed ones."""
    path = stateful.stored_turns(spark, sf_dir)
    rows = stateful.delivered(spark, sf_dir).collect()
    assert Counter(r.event_id % 50 for r in rows)[0] > 10
    assert len({r.turn for r in rows}) >= 10
    assert spark.read.parquet(path).count() == len(rows)


def test_turns_are_written_from_one_read_of_the_events(spark, sf_dir, monkeypatch):
    """Neither the number of turns nor a single task multiplies the reads of the input."""
    from barstream.plans import tables

    count = spark.sparkContext.accumulator(0)
    real = tables.bars

    def counted(spark, sf_dir):
        def pass_on(batches):
            for batch in batches:
                count.add(batch.num_rows)
                yield batch

        rows = real(spark, sf_dir)
        return rows.mapInArrow(pass_on, rows.schema)

    monkeypatch.setattr(tables, "bars", counted)
    path = stateful.stored_turns(spark, sf_dir)
    held = spark.read.parquet(path)
    assert count.value == held.count() == real(spark, sf_dir).count()
    times = held.groupBy(F.col("_metadata.file_path"), F.col("_metadata.file_modification_time").alias("at"))
    files = times.agg(F.expr("percentile(date_diff(bar_time, DATE'2024-01-01'), 0.5)").alias("day")).orderBy("at").collect()
    turns = stateful.delivered(spark, sf_dir).groupBy("turn").agg(
        F.expr("percentile(date_diff(bar_time, DATE'2024-01-01'), 0.5)").alias("day")
    )
    assert [f.day for f in files] == [t.day for t in turns.orderBy("turn").collect()]


def reported(spark, path, out, mark, **settings):
    streaming.report_stream(
        stream(spark, path), out, checkpoint=mark, trigger=AVAILABLE_NOW, **settings
    ).awaitTermination()
    return {r.symbol: (r.bars, r.bar_time, r.close) for r in streaming.read_report(spark, out).collect()}


TURNS = [[bar("a", 1440 * (n // 4) + n, n * 1.0), bar("b", n)] for n in range(9)]


def test_report_and_merged_ticks(spark, folder):
    path, out, mark = folder("in"), folder("out"), folder("mark")
    assert streaming.read_report(spark, out).count() == 0 and streaming.read_report_ticks(spark, out).count() == 0
    deliver(spark, path, *TURNS)
    got = reported(spark, path, out, mark, keep=2, merge_every=3)
    assert got == {
        "a": (9, START + timedelta(days=2, minutes=8), 8.0),
        "b": (9, START + timedelta(minutes=8), 1.0),
    }
    assert sorted(report._reports(spark, out)) == [6, 7, 8]
    rows = streaming.read_report_ticks(spark, out).collect()
    want = sorted((r[1], r[7], r[5]) for turn in TURNS for r in turn)
    assert sorted((r.symbol, r.bar_time, r.close) for r in rows) == want
    assert all(r.trade_date == r.bar_time.date() for r in rows)
    left = defaultdict(list)
    for date, n in report._folders(spark, f"{out}/ticks"):
        left[date].append(n)
    assert sorted(left["2024-03-01"]) == [6, 7, 8]
    assert sorted(report._folders(spark, f"{out}/merged"))[:2] == [("2024-03-01", 2), ("2024-03-01", 5)]


def test_a_repeated_batch_counts_once(spark, folder):
    """The last batch is done again, as after a failure before its commit."""
    path, out, mark = folder("in"), folder("out"), folder("mark")
    deliver(spark, path, *TURNS[:5])
    first = reported(spark, path, out, mark, keep=1, merge_every=2)
    rows = streaming.read_report_ticks(spark, out).count()
    import pathlib

    last = max(int(p.name) for p in pathlib.Path(mark, "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        pathlib.Path(mark, "commits", name).unlink(missing_ok=True)
    assert reported(spark, path, out, mark, keep=1, merge_every=2) == first
    assert streaming.read_report_ticks(spark, out).count() == rows == 10


def test_readers_pass_over_batches_that_are_merged_already(spark, folder):
    """Between the merged copy and the deletion both are there; rows still count once."""
    path, out, mark = folder("in"), folder("out"), folder("mark")
    deliver(spark, path, *TURNS[:3])
    kept, real = [], report._delete
    report._delete = lambda spark, folders: kept.extend(folders)
    try:
        reported(spark, path, out, mark, keep=1, merge_every=2)
    finally:
        report._delete = real
    assert any("/ticks/" in f for f in kept)
    assert streaming.read_report_ticks(spark, out).count() == 6
    deliver(spark, path, *TURNS[3:5])
    reported(spark, path, out, mark, keep=1, merge_every=2)
    assert streaming.read_report_ticks(spark, out).count() == 10


def test_report_limits(spark, folder):
    with pytest.raises(ValueError, match="keep"):
        streaming.report_stream(spark.range(1), folder("x"), checkpoint=folder("c"), keep=0)


def test_one_read_feeds_both_sinks(spark, sf_dir, folder):
    from barstream.plans import tables
    from barstream.streaming.fanout import Outputs

    tables.messages(spark, sf_dir).repartition(3).write.parquet(folder("in"))
    targets = Outputs(checkpoint=folder("mark"), messages_path=folder("messages"), raw_path=folder("raw"))
    read = []
    for _ in range(2):
        source = sources.read_messages_stream(spark, folder("in"), files_per_trigger=1)
        query = streaming.start_once(source, targets, trigger=AVAILABLE_NOW)
        query.awaitTermination()
        read += [p.numInputRows for p in query.recentProgress]
    assert sum(read) == tables.messages(spark, sf_dir).count() == spark.read.parquet(folder("raw")).count()
    bars = tables.bars(spark, sf_dir).count()
    assert spark.read.parquet(folder("messages")).count() == bars
    # The last batch again, as after a failure between its two sinks.
    import pathlib

    last = max(int(p.name) for p in pathlib.Path(folder("mark"), "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        pathlib.Path(folder("mark"), "commits", name).unlink(missing_ok=True)
    source = sources.read_messages_stream(spark, folder("in"), files_per_trigger=1)
    streaming.start_once(source, targets, trigger=AVAILABLE_NOW).awaitTermination()
    assert spark.read.parquet(folder("messages")).count() == bars
    with pytest.raises(ValueError, match="raw_path"):
        streaming.start_once(source, Outputs(checkpoint=folder("mark")))


def test_nulls_can_go_out_of_the_job(spark, folder):
    from barstream.streaming.fanout import Outputs

    value = b'[{"T":"b","S":"a","o":1.5,"t":"2024-03-01T00:00:00Z"}]'
    rows = [(None, value, "bars", 0, 0, None, 0)]
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    spark.createDataFrame(rows, schema).write.parquet(folder("in"))
    for keep in (False, True):
        source = sources.read_messages_stream(spark, folder("in"))
        targets = Outputs(checkpoint=folder(f"mark{keep}"), messages_path=folder(f"out{keep}"))
        streaming.run_pipeline(source, "kafka-only", targets, trigger=AVAILABLE_NOW, keep_nulls=keep)
        sent = spark.read.parquet(folder(f"out{keep}")).first().value
        assert ('"v":null' in sent) == keep and '"o":1.5' in sent


def test_only_partitions_with_new_rows_are_replaced(spark, folder):
    from barstream.sinks import insert_partitions

    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "n int, day string")
    insert_partitions(rows, "replaced_days", ["day"], location=folder("t"))
    assert spark.catalog.tableExists("replaced_days")
    assert "replaced_days" in [r.tableName for r in spark.sql("SHOW TABLES").collect()]
    got = insert_partitions(spark.createDataFrame([("x", 9), ("z", 8)], "day string, n int"), "replaced_days", ["day"])
    assert sorted(map(tuple, got.collect())) == [(3, "y"), (8, "z"), (9, "x")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    with pytest.raises(ValueError, match="columns"):
        insert_partitions(rows.withColumn("more", rows.n), "replaced_days", ["day"])
    assert spark.sql("SELECT * FROM replaced_days LIMIT 2").count() == 2
    spark.sql("DROP TABLE replaced_days")


def test_fanned_out_files_are_written_without_a_sort(spark, folder, monkeypatch):
    from pyspark.sql import functions as F

    from barstream.sinks import write_fanned_out

    rows = spark.range(0, 1000, numPartitions=2).withColumn("p", F.col("id") % 5)
    plans = {}
    for name, writers in (("few", 0), ("many", 10), ("beyond", 3)):
        write_fanned_out(rows, folder(name), ["p"], writers)
        store = spark._jsparkSession.sharedState().statusStore()
        last = store.executionsList(store.executionsCount() - 1, 1).apply(0)
        plans[name] = last.physicalPlanDescription()
        assert spark.read.parquet(folder(name)).groupBy("p").count().where("count = 200").count() == 5
    assert "Sort" in plans["few"] and "Sort" not in plans["many"] and "Sort" not in plans["beyond"]


def test_bad_history_lines_keep_their_text_and_reason(spark):
    lines = [
        '{"T":"b","symbol":"a","v":1,"t":"2024-03-01T00:00:00Z"}',
        '{"T":"b","S":"a","t":"2024-03-01T00:00:00Z"}',
        '{"T":"b","symbol":"a","v":"no number","t":"2024-03-01T00:00:00Z"}',
        '  {"symbol":"a"}',
        '{"t":"2024-03-01T00:00:00Z"}',
        "{broken", "[1]", "3", "", "  ", None,
    ]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    got = Counter(tuple(r) for r in sources.split_history(frame).select("bad_line", "reason").collect())
    assert got == Counter(
        {(None, None): 3, ('  {"symbol":"a"}', "no time"): 1, ('{"t":"2024-03-01T00:00:00Z"}', "no symbol"): 1,
         ("{broken", "not json"): 1, ("[1]", "not json"): 1, ("3", "not json"): 1, ("", "blank"): 1,
         ("  ", "blank"): 1, (None, "blank"): 1}
    )
    assert sources.split_history(frame.limit(0)).count() == 0
