from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.functions import canonical_json, display_time, iso_time, parse_time, to_milliseconds
from barstream.functions.times import seconds_between
from barstream.operators import batching, queries
from barstream.operators.flatten import flatten_messages
from barstream.operators.history import bars_per_symbol, flatten_symbol_map, normalise_bars
from barstream.operators.numbering import number_rows, with_batch_id
from barstream.operators.wire import as_ticks, from_wire, to_wire
from barstream.plans import tables
from barstream.schema import BAR_COLUMNS, BARS, MESSAGE
from barstream.sources.history import parse_history
from barstream.streaming import observe_flow

NOON = datetime(2025, 11, 20, 12, 0)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-11-20T14:35:00Z", datetime(2025, 11, 20, 14, 35)),
        ("2024-06-18T07:45:09.250375Z", datetime(2024, 6, 18, 7, 45, 9, 250375)),
        ("2024-06-18T01:20:09+02:00", datetime(2024, 6, 17, 23, 20, 9)),
        ("2025-03-09T02:30:00Z", datetime(2025, 3, 9, 2, 30)),  # does not exist in New York
        ("2025-11-20", datetime(2025, 11, 20)),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_time(spark, zone, text, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, parse_time(F.lit(text).cast("string"))) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_texts(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ntz = "timestamp_ntz"
        assert one(spark, iso_time(F.lit("2025-03-09 02:30:00").cast(ntz))) == "2025-03-09T02:30:00Z"
        assert one(spark, iso_time(F.lit("2025-03-09 02:30:00.25").cast(ntz))) == "2025-03-09T02:30:00.25Z"
        assert one(spark, display_time(F.lit(1763649300123))) == "2025-11-20 14:35:00"
        assert one(spark, display_time(F.lit("2025-03-09T02:30:00.5Z"))) == "2025-03-09 02:30:00"
        assert one(spark, display_time(F.lit("soon"))) == "soon"
        assert one(spark, display_time(F.lit("9" * 30))) == "9" * 30
        assert one(spark, display_time(F.lit("9" * 18))) == "9" * 18
        cut = one(spark, to_milliseconds(F.lit("2025-03-09 02:30:59.123999").cast(ntz)))
        assert cut == datetime(2025, 3, 9, 2, 30, 59, 123000)
        gap = seconds_between(
            F.lit("2025-03-08 00:00:00").cast(ntz), F.lit("2025-03-10 00:00:00.5").cast(ntz)
        )
        assert one(spark, gap) == 2 * 86400 + 0.5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_canonical_json(spark):
    assert one(spark, canonical_json(F.lit('{"b": 1, "a": [1.50, null, "x"]}'))) == '{"a":[1.5,null,"x"],"b":1}'
    assert one(spark, canonical_json(F.lit("{oops"))) is None


def _bar(symbol="A", at=NOON, **given):
    values = dict(
        bar_type="b", symbol=symbol, open=1.0, high=1.0, low=1.0, close=1.0, volume=1,
        bar_time=at, trade_count=1, vwap=1.0,
    ) | given
    return tuple(values[c] for c in BAR_COLUMNS)


def _bars(spark, *rows):
    return spark.createDataFrame(list(rows), BARS)


def test_to_wire_order_and_nulls(spark):
    bars = _bars(spark, _bar(volume=None))
    value = to_wire(bars).first().value
    assert list(json.loads(value)) == ["time_stamp", "T", "o", "h", "l", "c", "n", "vw", "S"]
    assert json.loads(value)["time_stamp"] == "2025-11-20T12:00:00Z"
    assert json.loads(to_wire(bars, keep_nulls=True).first().value)["v"] is None
    assert "timestamp" in json.loads(to_wire(bars, time_field="timestamp").first().value)


def test_wire_passes_text_time_on(spark):
    odd = "2025-11-20T14:35:00.100Z"
    message = spark.createDataFrame([(f'[{{"S":"A","t":"{odd}"}}]',)], "value string")
    value = to_wire(flatten_messages(message, typed_time=False)).first().value
    assert json.loads(value)["time_stamp"] == odd


def test_from_wire_reads_text_and_epoch_millis(spark):
    df = spark.createDataFrame(
        [
            ('{"time_stamp":"2025-11-20T12:00:00Z","S":"A"}',),
            ('{"time_stamp":1763640000000,"S":"B"}',),
            ("oops",),
        ],
        "value string",
    )
    rows = {r.symbol: r.bar_time for r in from_wire(df).collect()}
    assert rows == {"A": NOON, "B": NOON}


def test_as_ticks_defaults(spark):
    bars = _bars(spark, _bar(symbol=None, volume=None, vwap=None))
    plain, filled = as_ticks(bars).first(), as_ticks(bars, fill_defaults=True).first()
    assert plain.symbol is None and plain.volume is None
    assert filled.symbol == "null" and filled.volume == 0 and filled.vwap == 0.0
    assert str(filled.trade_date) == "2025-11-20"


def test_history_lines(spark):
    lines = [
        '{"symbol":"A","o":1,"t":"2025-11-20T12:00:00Z"}',
        '{"symbol":"","S":"B"}',
        '{"S":"C","T":"x"}',
        '{"o":1}',
        "   ",
        "oops",
        '{"symbol":"D","v":"many"}',
    ]
    text = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = normalise_bars(parse_history(text)).collect()
    assert sorted((r.symbol, r.bar_type, r.open) for r in rows) == sorted(
        [("A", "b", 1.0), ("B", "b", None), ("C", "x", None), ("", "b", 1.0), ("D", "b", None)],
        key=str,
    )
    assert parse_history(text, drop_malformed=False).count() == 6


def test_symbol_map(spark):
    page = '{"bars":{"A":[{"o":1,"t":"2025-11-20T12:00:00Z"},{"o":2}],"B":[]},"next_page_token":null}'
    pages = spark.createDataFrame([(1, page), (2, '{"bars":{}}'), (3, "oops")], "batch_id int, value string")
    assert [(r.symbol, r.open) for r in flatten_symbol_map(pages).orderBy("open").collect()] == [
        ("A", 1.0),
        ("A", 2.0),
    ]
    counts = {r.symbol: r.bars for r in bars_per_symbol(pages).collect()}
    assert counts == {"A": 2, "B": 0}
    unbatched = spark.createDataFrame([(None, '{"bars":{"A":[{"o":3}]}}')], "batch_id int, value string")
    found = batching.batch_totals(pages.union(unbatched)).collect()
    totals = {(r.batch_id, r.is_total): (r.bars, r.pages, r.symbols) for r in found}
    assert totals == {(1, False): (2, 1, 2), (None, False): (1, 1, 1), (None, True): (3, 2, 2)}


@pytest.fixture(scope="module")
def skewed(spark):
    """Four fifths of the rows are in one bucket; ids are shuffled."""
    n = 5000
    key = F.pmod(F.xxhash64("id"), F.lit(1_000_003))
    bucket = F.when(F.col("id") % 5 != 0, F.lit("hot")).when(F.col("id") % 10 == 0, F.lit("warm"))
    return spark.range(n).select("id", key.alias("k"), bucket.alias("bucket"))


def test_number_rows_equals_window(spark, skewed):
    mine = {r.id: r.row_index for r in number_rows(skewed, ["k", "id"], ["bucket"]).collect()}
    rows = sorted(skewed.collect(), key=lambda r: (str(r.bucket), r.k, r.id))
    seen: dict = {}
    for row in rows:
        assert mine[row.id] == seen.get(row.bucket, 0)
        seen[row.bucket] = seen.get(row.bucket, 0) + 1
    assert len(mine) == 5000


def test_number_rows_splits_a_hot_bucket(spark, skewed):
    numbered = number_rows(skewed, ["k", "id"], ["bucket"])
    assert sorted(r.row_index for r in numbered.where("bucket = 'hot'").collect()) == list(range(4000))
    placed = skewed.repartitionByRange(8, "bucket", "k", "id")
    sizes = placed.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1500


def test_equal_rows_get_different_numbers(spark):
    same = spark.range(3000).select(F.lit("x").alias("v"))
    numbers = [r.row_index for r in number_rows(same, ["v"], unique=False).collect()]
    assert sorted(numbers) == list(range(3000))


def test_batches(spark, skewed):
    batches = with_batch_id(skewed, 100, ["k", "id"], start=1).groupBy("batch_id").count().collect()
    assert {(r.batch_id, r["count"]) for r in batches} == {(i, 100) for i in range(1, 51)}
    dense = with_batch_id(skewed, 300, dense_id="id")
    assert dense.agg(F.max("batch_id")).first()[0] == 16
    with pytest.raises(ValueError):
        with_batch_id(skewed, 0, ["id"])
    with pytest.raises(ValueError):
        with_batch_id(skewed, 10)


def test_repack_is_the_inverse_of_flatten(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    packed = batching.repack_messages(bars, 7, ["bar_time", "event_id"], ["symbol"])
    sizes = packed.groupBy("symbol").agg(
        F.sum("records").alias("n"), F.count("*").alias("batches"), F.max("records").alias("most")
    )
    for row in sizes.collect():
        assert row.most == 7 and row.batches == -(-row.n // 7)
    back = flatten_messages(packed.select("value"))
    plain = bars.select(*BAR_COLUMNS)
    assert back.exceptAll(plain).count() == 0 and plain.exceptAll(back).count() == 0


def test_repacked_bars_are_in_order(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    packed = batching.repack_messages(bars, 50, ["bar_time", "event_id"]).orderBy("batch_id")
    times = [bar["t"] for row in packed.collect() for bar in json.loads(row.value)]
    pad = [time.rstrip("Z").ljust(26, "0") if "." in time else time for time in times]
    assert pad == sorted(pad)


def test_archive_manifest_with_offset_gaps(spark):
    offsets = [3 * i for i in range(25)]
    df = spark.createDataFrame([("t", 0, o) for o in offsets], "topic string, partition int, offset bigint")
    rows = sorted(batching.archive_manifest(df, 10).collect(), key=lambda r: r.chunk)
    assert [(r.start_offset, r.records, r.object_name) for r in rows] == [
        (0, 10, "t-0-0.jsonl.gz"),
        (30, 10, "t-0-30.jsonl.gz"),
        (60, 5, "t-0-60.jsonl.gz"),
    ]


def test_coverage(spark):
    requested = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "symbol string")
    seen = spark.createDataFrame([("A",)] * 5 + [("Z",)], "symbol string")
    row = batching.symbol_coverage(requested, seen).first()
    assert (row.requested, row.with_data, row.coverage) == (4, 1, 0.25)
    assert {r.symbol for r in batching.missing_symbols(requested, seen).collect()} == {"B", "C"}
    empty = batching.symbol_coverage(requested.limit(0), seen).first()
    assert (empty.requested, empty.with_data, empty.coverage) == (0, 0, 0.0)


def test_symbol_batches_take_the_size_asked_for(spark):
    symbols = spark.range(250).select(F.format_string("S%03d", "id").alias("symbol"))
    whole = batching.symbol_batches(symbols, size=250)
    assert [r["count"] for r in whole.groupBy("batch_id").count().collect()] == [250]
    batches = batching.symbol_batches(symbols)
    assert {r.batch_id: r["count"] for r in batches.groupBy("batch_id").count().collect()} == {1: 100, 2: 100, 3: 50}
    lists = {r.batch_id: r.symbols for r in batching.batch_symbols(batches).collect()}
    assert lists[3] == ",".join(f"S{i:03d}" for i in range(200, 250))


def test_tradable(spark):
    assets = spark.createDataFrame(
        [("A", "X", True), ("B", "X", None), ("C", "Y", True), ("D", "X", False)],
        "symbol string, exchange string, tradable boolean",
    )
    assert {r.symbol for r in batching.tradable_symbols(assets).collect()} == {"A", "C"}
    assert {r.symbol for r in batching.tradable_symbols(assets, "X").collect()} == {"A"}


def test_latest_bars_breaks_ties(spark):
    bars = _bars(spark, *[_bar(symbol=s, open=o) for s in "BA" for o in (2.0, 1.0)])
    rows = queries.latest_bars(bars, 3).collect()
    assert [(r.symbol, r.open) for r in rows] == [("A", 1.0), ("A", 2.0), ("B", 1.0)]
    plan = queries.latest_bars(bars)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_display_bars_leaves_missing_columns_out(spark):
    bars = _bars(spark, _bar(open=1.239, volume=1234567)).select("volume", "open", "symbol")
    shown = queries.display_bars(bars)
    assert shown.columns == ["symbol", "open", "volume"]
    assert tuple(shown.first()) == ("A", 1.24, "1,234,567")


def test_repair_and_typical_price(spark):
    bars = _bars(spark, _bar(open=5.0, high=4.0, low=6.0, close=7.0))
    row = queries.typical_price(queries.repair_ohlc(bars)).first()
    assert (row.high, row.low, row.typical_price) == (7.0, 5.0, 6.33)


def test_bar_rate(spark):
    bars = _bars(spark, _bar(), _bar(at=datetime(2025, 11, 20, 12, 0, 4)))
    assert tuple(queries.bar_rate(bars).first()) == (2, 4.0, 0.5)
    assert tuple(queries.bar_rate(bars.limit(1)).first()) == (1, 0.0, 0.0)
    assert tuple(queries.bar_rate(bars.limit(0)).first()) == (0, 0.0, 0.0)


def test_resample(spark):
    at = [datetime(2025, 11, 20, 12, m) for m in (0, 59)] + [datetime(2025, 11, 20, 13, 0)]
    bars = _bars(
        spark,
        _bar(at=at[1], open=2.0, close=3.0, high=9.0, volume=3, vwap=2.0),
        _bar(at=at[0], open=1.0, close=2.0, low=0.5, volume=1, vwap=1.0),
        _bar(at=at[2], volume=0, vwap=None),
    )
    rows = sorted(queries.resample_bars(bars, "1Hour").collect(), key=lambda r: r.bar_time)
    assert tuple(rows[0]) == ("A", at[0], 1.0, 9.0, 0.5, 3.0, 4, 2, 1.75)
    assert rows[1].vwap is None and rows[1].volume == 0
    with pytest.raises(ValueError):
        queries.timeframe("1Fortnight")


def test_queries_push_down_to_the_tick_table(spark, sf_dir, tmp_path):
    path = str(tmp_path / "ticks")
    as_ticks(tables.bars(spark, sf_dir)).write.partitionBy("trade_date").parquet(path)
    ticks = spark.read.parquet(path)
    plan = queries.profile_symbol(ticks, "click")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,click)]" in plan
    assert "ReadSchema: struct<symbol:string,bar_time:timestamp_ntz>" in plan
    recent = ticks.where(F.col("trade_date") >= F.lit("2024-01-20").cast("date"))
    assert "PartitionFilters: [isnotnull(trade_date" in recent._jdf.queryExecution().toString()


def test_json_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "messages")
    spark.createDataFrame([], MESSAGE).write.parquet(path)
    stored = spark.read.parquet(path)
    text = stored.select(F.col("value").cast("string"))
    for df in (
        flatten_messages(stored),
        flatten_symbol_map(stored),
        from_wire(stored),
        parse_history(text),
        observe_flow(stored, "flow"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1 and "Exchange" not in plan


def test_no_operator_needs_a_cross_join(spark, sf_dir):
    coverage = batching.symbol_coverage(tables.customers(spark, sf_dir), tables.orders_as_bars(spark, sf_dir))
    numbered = number_rows(tables.bars(spark, sf_dir), ["bar_time"])
    for df in (coverage, numbered):
        plan = df._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_schema_types():
    assert BARS["bar_time"].dataType == T.TimestampNTZType()
