from __future__ import annotations

import gzip
import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from barstream import session, sinks, sources, streaming
from barstream.maintenance import compact, file_stats, list_files, retain_since
from barstream.operators.flatten import flatten_messages
from barstream.operators.queries import latest_bars, resample_bars
from barstream.operators.wire import as_ticks
from barstream.plans import tables
from barstream.schema import BAR_COLUMNS
from barstream.sinks.starting import AVAILABLE_NOW, stream_writer
from barstream.streaming.fanout import Outputs


def parquet_files(path) -> list[Path]:
    return [p for p in Path(path).rglob("*.parquet") if "/_" not in str(p.relative_to(path))]


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Messages of sf0.001 in four files."""
    path = str(tmp_path_factory.mktemp("messages") / "m")
    tables.messages(spark, "/root/testdata/sf0.001").repartition(4, "offset").write.parquet(path)
    return path


@pytest.fixture()
def ticks(spark, sf_dir, tmp_path):
    path = str(tmp_path / "ticks")
    for part in range(3):
        bars = tables.bars(spark, sf_dir).where(F.pmod("event_id", F.lit(3)) == part)
        sinks.load_ticks(bars, path)
    return path


def test_archive_files(spark, tmp_path):
    path = str(tmp_path / "archive")
    messages = spark.range(2500).select(
        F.format_string('{"n": %d}', "id").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        (F.col("id") % 2).cast("int").alias("partition"),
        F.expr("id div 2").alias("offset"),
    )
    sinks.write_archive(messages.repartition(4, "value"), path)
    files = sorted(Path(path).rglob("*.gz"))
    places = sorted(p.parent.relative_to(path).as_posix() for p in files)
    assert places == [f"topic=t/partition={p}/start_offset={o}" for p in (0, 1) for o in (0, 1000)]
    lines = {p: gzip.open(p, "rt").read().splitlines() for p in files}
    assert sorted(map(len, lines.values())) == [250, 250, 1000, 1000]
    for content in lines.values():
        numbers = [int(line.split()[-1].rstrip("}")) for line in content]
        assert numbers == sorted(numbers)
    assert sources and sinks.read_archive(spark, path).where("partition = 1").count() == 1250


def test_archive_stream(spark, stored, tmp_path):
    path = str(tmp_path / "archive")
    source = sources.read_messages_stream(spark, stored)
    sinks.write_archive(source, path, checkpoint=str(tmp_path / "c"), trigger=AVAILABLE_NOW, max_records=3).awaitTermination()
    back = flatten_messages(sinks.read_archive(spark, path))
    assert rows_of(back) == rows_of(flatten_messages(spark.read.parquet(stored)).drop("key"))


def test_symbol_and_asset_files(spark, tmp_path):
    (tmp_path / "symbols.txt").write_text("AAPL\n\n  MSFT  \n   \nTSLA")
    assert {r.symbol for r in sources.read_symbols(spark, str(tmp_path / "symbols.txt")).collect()} == {"AAPL", "MSFT", "TSLA"}
    (tmp_path / "assets.json").write_text('[{"symbol":"A","exchange":"X","tradable":true,"class":"us"},\n {"symbol":"B"}]')
    assert sources.read_assets(spark, str(tmp_path / "assets.json")).count() == 2
    (tmp_path / "lines.json").write_text('{"symbol":"A"}\n{"symbol":"B"}\n')
    assert sources.read_assets(spark, str(tmp_path / "lines.json"), lines=True).count() == 2
    (tmp_path / "page.json").write_text('{\n "bars": {"A": [{"o": 1}]}\n}')
    assert sources.read_pages(spark, str(tmp_path / "page.json")).count() == 1


def test_source_arguments(spark):
    with pytest.raises(ValueError):
        sources.read_messages(spark)
    with pytest.raises(ValueError):
        sources.read_messages_stream(spark, brokers="b:9092", topic="t", starting_offsets="middle")
    with pytest.raises(ValueError):
        sinks.write_messages(spark.range(1))
    with pytest.raises(ValueError):
        sinks.write_raw(spark.range(1))


def test_ctas_refuses_an_existing_table(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    assert sinks.ctas(bars, "ctas_bars").count() == bars.count()
    with pytest.raises(AnalysisException):
        sinks.ctas(bars, "ctas_bars")
    assert spark.sql("SHOW TABLES").where("tableName = 'ctas_bars'").count() == 1
    assert spark.sql("SHOW NAMESPACES").count() >= 1
    spark.sql("DROP TABLE ctas_bars")


def test_partitioned_table_with_inserted_rows(spark, sf_dir):
    bars = tables.bars(spark, sf_dir).select("symbol", "close", F.to_date("bar_time").alias("trade_date"))
    bars.createOrReplaceTempView("daily_source")
    spark.sql(
        "CREATE TABLE daily_bars (symbol string, close double, trade_date date) "
        "USING parquet PARTITIONED BY (trade_date)"
    )
    spark.sql("INSERT INTO daily_bars SELECT symbol, close, trade_date FROM daily_source")
    by_date = lambda df: {r.trade_date: r["count"] for r in df.groupBy("trade_date").count().collect()}
    assert by_date(spark.table("daily_bars")) == by_date(bars)
    spark.sql("DROP TABLE daily_bars")


@pytest.mark.parametrize("outputs, made", [("kafka-only", {"messages"}), ("iceberg-only", {"raw"}), ("both", {"messages", "raw"})])
def test_output_modes(spark, stored, tmp_path, outputs, made):
    targets = Outputs(str(tmp_path / "c"), messages_path=str(tmp_path / "messages"), raw_path=str(tmp_path / "raw"))
    source = sources.read_messages_stream(spark, stored)
    streaming.run_pipeline(source, outputs, targets, trigger=AVAILABLE_NOW)
    assert {n for n in ("messages", "raw") if (tmp_path / n).exists()} == made
    assert set(os.listdir(tmp_path / "c")) == made
    if "raw" in made:
        assert rows_of(spark.read.parquet(targets.raw_path)) == rows_of(spark.read.parquet(stored))
    # A second run finds nothing new.
    before = len(parquet_files(tmp_path))
    streaming.run_pipeline(source, outputs, targets, trigger=AVAILABLE_NOW)
    for name in made:
        expected = flatten_messages(spark.read.parquet(stored)).count() if name == "messages" else spark.read.parquet(stored).count()
        assert spark.read.parquet(str(tmp_path / name)).count() == expected
    assert len(parquet_files(tmp_path)) >= before


def test_console_mode(spark, stored, tmp_path):
    source = sources.read_messages_stream(spark, stored)
    targets = Outputs(str(tmp_path / "c"))
    (query,) = streaming.start_pipeline(source, "console-debug", targets, trigger=AVAILABLE_NOW)
    query.awaitTermination()
    assert "ConsoleTable" in query.lastProgress.sink.description
    assert sum(p.numInputRows for p in query.recentProgress) == spark.read.parquet(stored).count()


def test_raw_table_is_created(spark, stored, tmp_path):
    source = sources.read_messages_stream(spark, stored)
    targets = Outputs(str(tmp_path / "c"), raw_table="default.raw_stream")
    streaming.run_pipeline(source, "iceberg-only", targets, trigger=AVAILABLE_NOW)
    table = spark.table("default.raw_stream")
    assert rows_of(table) == rows_of(spark.read.parquet(stored))
    assert len(table.limit(2).collect()) == 2
    spark.sql("DROP TABLE default.raw_stream")


def test_unknown_output_mode(spark, stored, tmp_path):
    source = sources.read_messages_stream(spark, stored)
    with pytest.raises(ValueError):
        streaming.run_pipeline(source, "everything", Outputs(str(tmp_path)))


def test_waiting_stops_the_other_queries(spark, stored, tmp_path):
    source = sources.read_messages_stream(spark, stored)
    targets = Outputs(str(tmp_path / "c"), messages_path=str(tmp_path / "m"), raw_path=str(tmp_path / "r"))
    spark.streams.resetTerminated()
    queries = streaming.start_pipeline(source, "both", targets, raw_trigger="1 hour")
    assert streaming.await_queries(spark, queries, timeout=3) is False
    assert not any(query.isActive for query in queries)


def test_stream_into_tick_table(spark, stored, tmp_path):
    bars = flatten_messages(sources.read_messages_stream(spark, stored))
    path = str(tmp_path / "ticks")
    sinks.load_ticks(bars, path, checkpoint=str(tmp_path / "c"), trigger=AVAILABLE_NOW).awaitTermination()
    expected = as_ticks(flatten_messages(spark.read.parquet(stored)))
    assert rows_of(spark.read.parquet(path)) == rows_of(expected)


def test_replay_takes_one_message_at_a_time(spark, sf_dir, tmp_path):
    path = str(tmp_path / "replay")
    messages = tables.messages(spark, sf_dir).where("offset < 2")
    streaming.stage_replay(messages, path)
    sent = []
    again = {"checkpoint": str(tmp_path / "c"), "trigger": None}

    def send(turn, number):
        sent.append((number, [(r.offset, r.partition) for r in turn.collect()]))

    streaming.replay_messages(spark, path, send, **again)
    places = sorted((r.offset, r.partition) for r in messages.collect())
    assert sent == [(i, [place]) for i, place in enumerate(places)]
    before = list(sent)
    streaming.replay_messages(spark, path, send, **again)
    assert sent in (before, before + before[-1:])


def test_replay_without_a_pace_sends_many_turns_at_once(spark, sf_dir, tmp_path):
    path = str(tmp_path / "replay")
    messages = tables.messages(spark, sf_dir)
    streaming.stage_replay(messages, path)
    sent = []

    def send(turns, number):
        sent.append((number, [(r.turn, r.offset, r.partition) for r in turns.collect()]))

    how = {"checkpoint": str(tmp_path / "c"), "messages_per_trigger": 2, "turns_at_once": 3}
    streaming.replay_messages(spark, path, send, trigger=None, **how)
    places = sorted((r.offset, r.partition) for r in messages.collect())
    assert len(places) == 10
    rows = [(i // 2, *place) for i, place in enumerate(places)]
    assert sent == [(0, rows[:6]), (1, rows[6:])]
    with pytest.raises(ValueError, match="paced"):
        streaming.replay_messages(spark, path, send, trigger="1 second", **how)


def test_replay_query_takes_few_micro_batches(spark, sf_dir, monkeypatch):
    """Forty turns of the query are one micro-batch, not forty."""
    from barstream.plans import flows

    real, calls = streaming.replay_messages, []

    def counted(spark, path, send, **how):
        real(spark, path, lambda sent, n: (calls.append(n), send(sent, n)), **how)

    monkeypatch.setattr(streaming, "replay_messages", counted)
    events = spark.range(800).selectExpr(
        "id AS m", "id % 3 AS partition", "id div 3 AS offset", "cast('' AS binary) AS value"
    )
    monkeypatch.setattr(tables, "messages", lambda spark, sf_dir: events.drop("m"))
    rows = flows._replayed(spark, sf_dir).collect()
    assert sorted((r.turn, r.offset * 3 + r.partition) for r in rows) == [(i // 20, i) for i in range(800)]
    assert len(calls) == 1


def test_replay_reports_a_failing_sink(spark, sf_dir, tmp_path):
    path = str(tmp_path / "replay")
    streaming.stage_replay(tables.messages(spark, sf_dir), path)

    def send(turn, number):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        streaming.replay_messages(spark, path, send, checkpoint=str(tmp_path / "c"), trigger=None)


def test_dashboard(spark, stored, tmp_path):
    path = str(tmp_path / "board")
    bars = flatten_messages(sources.read_messages_stream(spark, stored, files_per_trigger=1))
    query = streaming.dashboard_stream(bars, path, checkpoint=str(tmp_path / "c"), trigger=AVAILABLE_NOW)
    query.awaitTermination()
    ticks, totals, latest = streaming.read_dashboard(spark, path)
    history = [r.total_events for r in totals.orderBy("batch_id").collect()]
    assert len(history) == len(parquet_files(stored)) and history == sorted(history)
    assert history[-1] == ticks.count() == flatten_messages(spark.read.parquet(stored)).count()
    last = latest.where(F.col("batch_id") == len(history) - 1).drop("batch_id")
    assert rows_of(last) == rows_of(latest_bars(ticks))


def test_repeated_dashboard_batch_counts_once(spark, stored, tmp_path):
    from barstream.streaming.dashboard import _write_report

    ticks = as_ticks(flatten_messages(spark.read.parquet(stored)))
    path = str(tmp_path / "board")
    _write_report(ticks, path, 0)
    for _ in range(2):
        _write_report(ticks, path, 1)
    totals = spark.read.parquet(f"{path}/totals").orderBy("batch_id").collect()
    assert [r.total for r in totals] == [ticks.count(), 2 * ticks.count()]


def test_batch_metrics(spark, stored):
    observation = Observation("flow")
    mixed = spark.read.parquet(stored).union(tables.junk(spark, "/root/testdata/sf0.001"))
    n = streaming.observe_flow(mixed, observation).count()
    seen = observation.get
    assert seen["messages_sent"] == n
    assert seen["errors"] == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert seen["messages_received"] == spark.read.parquet(stored).count() + seen["errors"]


def test_streamed_resample_equals_batch_for_closed_windows(spark, stored, tmp_path):
    source = sources.read_messages_stream(spark, stored)
    coarse = resample_bars(flatten_messages(source), "1Day", watermark="1 day")
    writer = stream_writer(coarse, str(tmp_path / "c"), AVAILABLE_NOW)
    writer.format("parquet").option("path", str(tmp_path / "out")).start().awaitTermination()
    mine = spark.read.parquet(str(tmp_path / "out"))
    whole = resample_bars(flatten_messages(spark.read.parquet(stored)), "1Day")
    closed = whole.join(mine.select("bar_time").distinct(), "bar_time", "left_semi")
    rounded = lambda df: df.withColumn("vwap", F.round("vwap", 6))
    assert mine.count() > 0 and rows_of(rounded(mine)) == rows_of(rounded(closed))


def test_file_stats_equal_the_file_system(spark, ticks):
    files = parquet_files(ticks)
    row = file_stats(spark, ticks).first()
    size = sum(p.stat().st_size for p in files)
    assert (row.file_count, row.total_bytes) == (len(files), size)
    assert row.total_mb == pytest.approx(size / 2**20)
    assert row.avg_file_size_mb == pytest.approx(size / 2**20 / len(files))
    listed = [r.file_size_in_bytes for r in list_files(spark, ticks).collect()]
    assert listed == sorted((p.stat().st_size for p in files), reverse=True)


def test_file_stats_of_nothing(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    row = file_stats(spark, str(tmp_path / "empty")).first()
    assert tuple(row) == (0, 0, 0.0, 0.0)


def test_compact_keeps_rows_and_saves_files(spark, ticks):
    before = rows_of(spark.read.parquet(ticks))
    files = len(parquet_files(ticks))
    dates = spark.read.parquet(ticks).select("trade_date").distinct().count()
    plan = compact(spark, ticks, dry_run=True).first()
    assert plan.dry_run and plan.files_after == dates and len(parquet_files(ticks)) == files
    done = compact(spark, ticks).first()
    assert (done.files_before, done.files_after, done.files_reduced) == (files, dates, files - dates)
    assert len(parquet_files(ticks)) == dates
    assert rows_of(spark.read.parquet(ticks)) == before
    assert not [p for p in os.listdir(ticks) if p.startswith(("_rew", "_rep"))]
    again = compact(spark, ticks).first()
    assert again.rows == 0 and again.files_reduced == 0


def test_compact_chosen_partitions(spark, ticks):
    before = rows_of(spark.read.parquet(ticks))
    early = F.col("trade_date") <= F.lit(date(2024, 1, 3))
    late = {p: p.stat().st_mtime_ns for p in parquet_files(ticks) if p.parent.name > "trade_date=2024-01-03"}
    compact(spark, ticks, where=early)
    assert {p: p.stat().st_mtime_ns for p in late} == late
    assert len([p for p in parquet_files(ticks) if p not in late]) == 3
    assert rows_of(spark.read.parquet(ticks)) == before
    with pytest.raises(AnalysisException):
        compact(spark, ticks, where=F.col("symbol") == "click")


def test_compact_splits_by_size(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(16).write.parquet(path)
    total = sum(p.stat().st_size for p in parquet_files(path))
    done = compact(spark, path, target_mb=total / 4 / 2**20 + 0.001).first()
    assert done.files_after == 4
    sizes = sorted(p.stat().st_size for p in parquet_files(path))
    assert sizes[-1] < 1.5 * sizes[0]
    assert spark.read.parquet(path).selectExpr("count(distinct id)").first()[0] == 40_000


def test_compact_of_a_stream_output_goes_to_a_new_directory(spark, stored, tmp_path):
    path, dest = str(tmp_path / "raw"), str(tmp_path / "compacted")
    source = sources.read_messages_stream(spark, stored, files_per_trigger=1)
    sinks.write_raw(source, path, checkpoint=str(tmp_path / "c"), trigger=AVAILABLE_NOW).awaitTermination()
    with pytest.raises(ValueError):
        compact(spark, path)
    done = compact(spark, path, dest=dest).first()
    assert done.files_after == 1 and done.files_before > 1
    assert rows_of(spark.read.parquet(dest)) == rows_of(spark.read.parquet(path))


@pytest.mark.parametrize("cutoff", [datetime(2024, 1, 15, 10, 30), datetime(2024, 1, 15), datetime(2023, 1, 1)])
def test_retain_since(spark, ticks, tmp_path, cutoff):
    kept = spark.read.parquet(ticks).where(F.col("bar_time") >= F.lit(cutoff).cast("timestamp_ntz"))
    expected = rows_of(kept)
    dest = str(tmp_path / "dest")
    retain_since(spark, ticks, cutoff, dest=dest)
    assert rows_of(spark.read.parquet(dest)) == expected
    late = {p: p.stat().st_mtime_ns for p in parquet_files(ticks) if p.parent.name > f"trade_date={cutoff:%Y-%m-%d}"}
    row = retain_since(spark, ticks, cutoff).first()
    assert rows_of(spark.read.parquet(ticks)) == expected
    assert {p: p.stat().st_mtime_ns for p in late} == late
    assert row.partitions_dropped == max(0, (cutoff.date() - date(2024, 1, 1)).days)


@pytest.mark.parametrize("layout", [["trade_date", "symbol"], ["symbol", "trade_date"]])
def test_retain_since_keeps_every_partition_column(spark, ticks, tmp_path, layout):
    path, cutoff = str(tmp_path / "two"), datetime(2024, 1, 15, 10, 30)
    spark.read.parquet(ticks).write.partitionBy(*layout).parquet(path)
    wanted = spark.read.parquet(ticks).where(F.col("bar_time") >= F.lit(cutoff).cast("timestamp_ntz"))
    expected, columns = rows_of(wanted), wanted.columns
    retain_since(spark, path, cutoff, dest=str(tmp_path / "dest"))
    row = retain_since(spark, path, cutoff).first()
    assert row.partitions_dropped == 14 and row.rows_removed > 0
    for place in (path, str(tmp_path / "dest")):
        assert rows_of(spark.read.parquet(place).select(*columns)) == expected


def test_retain_since_wants_a_date_partition(spark, ticks, tmp_path):
    path = str(tmp_path / "flat")
    spark.read.parquet(ticks).drop("trade_date").write.parquet(path)
    with pytest.raises((ValueError, AnalysisException)):
        retain_since(spark, path, datetime(2024, 1, 15))


def test_compact_dest_is_complete(spark, ticks, tmp_path):
    early = F.col("trade_date") <= F.lit(date(2024, 1, 15))
    compact(spark, ticks, where=early)
    before = rows_of(spark.read.parquet(ticks))
    files, dest = len(parquet_files(ticks)), str(tmp_path / "dest")
    dates = spark.read.parquet(ticks).select("trade_date").distinct().count()
    done = compact(spark, ticks, dest=dest).first()
    assert rows_of(spark.read.parquet(dest)) == before and done.rows == len(before)
    assert (done.files_before, done.files_after, done.files_reduced) == (files, dates, files - dates)
    some = str(tmp_path / "some")
    done = compact(spark, ticks, dest=some, where=early).first()
    assert rows_of(spark.read.parquet(some)) == before and done.files_reduced == 0


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rebalanced_load_has_few_files(spark, sf_dir, tmp_path):
    bars = tables.bars(spark, sf_dir).repartition(6, "event_id")
    dates = bars.select(F.to_date("bar_time")).distinct().count()
    sinks.load_ticks(bars, str(tmp_path / "as-is"))
    sinks.load_ticks(bars, str(tmp_path / "rebalanced"), rebalance=True)
    assert len(parquet_files(tmp_path / "rebalanced")) == dates < len(parquet_files(tmp_path / "as-is"))
    assert rows_of(spark.read.parquet(str(tmp_path / "rebalanced"))) == rows_of(as_ticks(bars))


@pytest.mark.parametrize("n", [1, 10, 100, 700, 5000])
def test_latest_ticks_equal_those_of_the_whole_table(spark, ticks, n):
    mine = [tuple(r) for r in sources.latest_ticks(spark, ticks, n).collect()]
    assert mine == [tuple(r) for r in latest_bars(spark.read.parquet(ticks), n).collect()]


def test_latest_ticks_reads_few_dates(spark, ticks):
    plan = sources.latest_ticks(spark, ticks)._jdf.queryExecution().toString()
    assert "trade_date#" in plan and ">= 2024-01-30" in plan


def test_compact_can_sort(spark, ticks):
    before = rows_of(spark.read.parquet(ticks))
    compact(spark, ticks, sort_by=["close"])
    for file in parquet_files(ticks):
        closes = [r.close for r in spark.read.parquet(str(file)).select("close").collect()]
        assert closes == sorted(closes)
    assert rows_of(spark.read.parquet(ticks)) == before


def test_release_deletes_what_was_staged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    df = session.staged(spark.range(3).toDF("x"), "three")
    assert df.count() == 3 and os.listdir(tmp_path / "barstream")
    session.release(spark)
    assert os.listdir(tmp_path / "barstream") == []


def test_without_the_setting_only_local_sessions_get_a_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId = "app-1"
        master = "local[2]"

    class Session:
        conf = Conf()
        sparkContext = Context()

    assert session.shared_folder(Session()) == session.shared_folder(Session())
    Context.master = "yarn"
    with pytest.raises(ValueError):
        session.shared_folder(Session())


def test_bar_columns_survive_history_files(spark, sf_dir, tmp_path):
    from barstream.operators.history import normalise_bars

    bars = tables.bars(spark, sf_dir).select(*BAR_COLUMNS)
    sinks.write_history(bars, str(tmp_path / "h"))
    assert rows_of(normalise_bars(sources.read_history(spark, str(tmp_path / "h")))) == rows_of(bars)
