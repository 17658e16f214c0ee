from __future__ import annotations

import pytest

from barstream.jobs import compact, flatten, load, replay, report, retain, tail
from barstream.operators.flatten import flatten_messages
from barstream.operators.wire import as_ticks
from barstream.plans import tables
from barstream.sinks.starting import AVAILABLE_NOW

TOPICS = ["--brokers", "b:9092", "--source-topic", "in", "--checkpoint", "/c"]


def test_flatten_arguments():
    args = flatten.arguments([*TOPICS, "--dest-topic", "out", "--raw-table", "lake.raw"])
    assert args.output_mode == "both" and args.starting_offsets == "latest"
    assert args.processing_time == "1 minute"


@pytest.mark.parametrize(
    "extra",
    [
        ["--dest-topic", "out", "--raw-table", "raw"],
        ["--dest-topic", "out"],
        ["--raw-table", "lake.raw"],
        ["--output-mode", "everything"],
        ["--output-mode", "kafka-only"],
        ["--dest-topic", "out", "--raw-table", "lake.raw", "--raw-path", "/r"],
    ],
)
def test_flatten_refuses(extra):
    with pytest.raises(SystemExit):
        flatten.arguments([*TOPICS, *extra])


def test_flatten_job(spark, sf_dir, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    tables.messages(spark, sf_dir).write.parquet(source)
    flatten.main(
        ["--source-path", source, "--dest-path", out, "--output-mode", "kafka-only",
         "--checkpoint", str(tmp_path / "c"), "--trigger", AVAILABLE_NOW]
    )
    assert spark.read.parquet(out).count() == tables.bars(spark, sf_dir).count()


def test_compact_and_report_jobs(spark, sf_dir, tmp_path, capsys):
    path = str(tmp_path / "ticks")
    ticks = as_ticks(tables.bars(spark, sf_dir)).repartition(3, "bar_time")
    ticks.write.partitionBy("trade_date").parquet(path)
    compact.main(["--path", path, "--partition-filter", "trade_date < '2024-01-10'"])
    assert "files_reduced" in capsys.readouterr().out
    report.main(["--path", path, "--refreshes", "2", "--interval", "0"])
    printed = capsys.readouterr().out
    assert printed.count("total_events") == 2 and "1,000" in printed


def test_tail_job(spark, sf_dir, tmp_path):
    source = str(tmp_path / "in")
    tables.messages(spark, sf_dir).write.parquet(source)
    tail.main(["--path", source, "--trigger", AVAILABLE_NOW])
    with pytest.raises(SystemExit):
        tail.arguments(["--topic", "t"])


def test_flatten_job_by_files_from_one_read(spark, sf_dir, tmp_path):
    source, out, raw = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "raw")
    tables.messages(spark, sf_dir).repartition(3).write.parquet(source)
    flatten.main(
        ["--source-path", source, "--dest-path", out, "--raw-path", raw, "--single-read", "--keep-nulls",
         "--max-files-per-trigger", "1", "--checkpoint", str(tmp_path / "c"), "--trigger", AVAILABLE_NOW]
    )
    assert sorted(p.name for p in (tmp_path / "raw").iterdir()) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert spark.read.parquet(out).count() == tables.bars(spark, sf_dir).count()
    with pytest.raises(SystemExit):
        flatten.arguments([*TOPICS, "--dest-topic", "out", "--raw-table", "lake.raw", "--single-read"])


def test_a_topic_is_read_within_limits():
    args = flatten.arguments([*TOPICS, "--dest-topic", "o", "--raw-table", "a.b", "--max-offsets-per-trigger", "5000"])
    assert args.max_offsets_per_trigger == 5000


def test_load_and_retain_jobs(spark, sf_dir, tmp_path, capsys):
    lines, path, kept = tmp_path / "lines.json", str(tmp_path / "ticks"), str(tmp_path / "kept")
    lines.write_text(
        "\n".join(
            ['{"T":"b","symbol":"a","o":1.0,"t":"2024-01-0%dT00:00:00Z"}' % d for d in range(1, 5)] + ["{broken", ""]
        )
    )
    load.main(["--history", str(lines), "--path", path, "--fill-defaults"])
    assert "not json" in capsys.readouterr().out
    rows = spark.read.parquet(path)
    assert rows.count() == 4 and rows.where("volume = 0").count() == 4
    stored = str(tmp_path / "messages")
    tables.messages(spark, sf_dir).write.parquet(stored)
    load.main(["--messages", stored, "--path", str(tmp_path / "more")])
    assert spark.read.parquet(str(tmp_path / "more")).count() == tables.bars(spark, sf_dir).count()
    retain.main(["--path", path, "--since", "2024-01-03", "--dest", kept])
    assert spark.read.parquet(kept).count() == 2
    retain.main(["--path", path, "--days", "1"])
    assert "partitions_dropped" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        retain.arguments(["--path", path])


def test_compact_and_retain_jobs_by_table_name(spark, sf_dir, capsys):
    from barstream.plans.upkeep import ticks_table

    name = ticks_table(spark, sf_dir)
    rows = spark.table(name).count()
    compact.main(["--table", name])
    assert "partitions_compacted" in capsys.readouterr().out
    retain.main(["--table", name, "--since", "2024-01-10T00:00:00"])
    left = spark.table(name)
    assert 0 < left.count() < rows and left.where("bar_time < '2024-01-10'").count() == 0
    with pytest.raises(SystemExit):
        compact.arguments(["--table", name, "--dest", "elsewhere"])
    with pytest.raises(SystemExit):
        retain.arguments(["--table", name, "--days", "1", "--dest", "elsewhere"])


def test_compact_job_packs_small_files(spark, sf_dir, capsys):
    from barstream.plans.evidence import ticks_in_files

    path = ticks_in_files(spark, sf_dir)
    rows = spark.read.parquet(path).count()
    compact.main(["--path", path, "--small-files"])
    assert "files_untouched" in capsys.readouterr().out
    assert spark.read.parquet(path).count() == rows


def test_replay_job_sends_history_in_order(spark, sf_dir, tmp_path):
    from barstream import sinks
    from barstream.plans import tables

    history, out = str(tmp_path / "history"), str(tmp_path / "out")
    sinks.write_history(tables.bars(spark, sf_dir), history)
    args = ["--history", history, "--staged", str(tmp_path / "staged"), "--out", out,
            "--interval", "0", "--messages-per-turn", "4"]
    replay.main(args)
    sent = spark.read.parquet(out)
    assert flatten_messages(sent).count() == tables.bars(spark, sf_dir).count()
    first = flatten_messages(sent.where("turn = 0")).selectExpr("max(bar_time) AS t").first().t
    later = flatten_messages(sent.where("turn > 0")).selectExpr("min(bar_time) AS t").first().t
    assert first <= later
    # A replay that is over sends nothing more.
    before = sent.count()
    replay.main(args)
    assert spark.read.parquet(out).count() == before
