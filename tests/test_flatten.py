from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from barstream.operators.flatten import flatten_messages, rejected_messages
from barstream.schema import BAR_COLUMNS

OK = (
    '{"T":"b","S":"QUX","o":7.25,"h":8.5,"l":6.75,"c":8.0,"v":640,'
    '"t":"2024-03-05T09:15:00Z","n":12,"vw":7.875}'
)
OK_ROW = ("b", "QUX", 7.25, 8.5, 6.75, 8.0, 640, "2024-03-05 09:15:00", 12, 7.875)


def nulls(**given):
    return tuple(given.get(c) for c in BAR_COLUMNS)


def zeros(**given):
    blank = dict.fromkeys(BAR_COLUMNS, 0) | {"bar_type": None, "symbol": None, "bar_time": None}
    return tuple((blank | given)[c] for c in BAR_COLUMNS)


# case: text, permissive rows, strict rows; None = the message is rejected
CASES = {
    "array of two": (f"[{OK},{OK}]", [OK_ROW, OK_ROW], [OK_ROW, OK_ROW]),
    "single object": (OK, [OK_ROW], None),
    "not json": ("not json", None, None),
    "empty text": ("", None, None),
    "empty array": ("[]", [], []),
    "json null": ("null", None, None),
    "truncated": (f'[{OK},{{"T":', None, None),
    "null element": (f"[null,{OK}]", [OK_ROW], [OK_ROW]),
    "number element": (f"[5,{OK}]", None, None),
    "empty object": ("[{}]", [nulls()], [zeros()]),
    "unknown field": (f'[{OK[:-1]},"zz":1}}]', [OK_ROW], None),
    "unknown field for a missing one": (
        '[{"T":"b","S":"A","zz":1}]',
        [nulls(bar_type="b", symbol="A")],
        None,
    ),
    "blank before colon and unknown field": (
        '[{"T" : "b","S" : "A","zz":1}]',
        [nulls(bar_type="b", symbol="A")],
        None,
    ),
    "missing fields": (
        '[{"T":"b","S":"A"}]',
        [nulls(bar_type="b", symbol="A")],
        [zeros(bar_type="b", symbol="A")],
    ),
    "float as volume": ('[{"S":"A","v":10.5}]', [nulls(symbol="A")], [zeros(symbol="A", volume=10)]),
    "exponent as volume": ('[{"S":"A","v":1e3}]', [nulls(symbol="A")], [zeros(symbol="A", volume=1000)]),
    "text as volume": ('[{"S":"A","v":"12"}]', [nulls(symbol="A")], [zeros(symbol="A", volume=12)]),
    "fraction text as volume": ('[{"S":"A","v":"12.5"}]', [nulls(symbol="A")], None),
    "text as price": ('[{"S":"A","o":"1.5"}]', [nulls(symbol="A")], [zeros(symbol="A", open=1.5)]),
    "blank text as price": ('[{"S":"A","o":" "}]', [nulls(symbol="A")], [zeros(symbol="A")]),
    "null as price": ('[{"S":"A","o":null}]', [nulls(symbol="A")], [zeros(symbol="A")]),
    "boolean as price": ('[{"S":"A","o":true}]', [nulls(symbol="A")], None),
    "number as symbol": ('[{"S":5}]', [nulls(symbol="5")], [zeros(symbol="5")]),
    "array as symbol": ('[{"S":[1]}]', [nulls(symbol="[1]")], None),
    "object as symbol": ('[{"S":{"a":1}}]', [nulls(symbol='{"a":1}')], None),
    "colon in a value": ('[{"S":"a\\":b"}]', [nulls(symbol='a":b')], [zeros(symbol='a":b')]),
    "repeated key": ('[{"S":"A","S":"B"}]', [nulls(symbol="B")], [zeros(symbol="B")]),
    "one bad element": (f'[{OK},{{"S":"B","v":"x"}}]', [OK_ROW, nulls(symbol="B")], None),
    "count beyond int": (
        '[{"S":"A","n":3000000000}]',
        [nulls(symbol="A", trade_count=3000000000)],
        None,
    ),
    "volume beyond bigint": ('[{"S":"A","v":99999999999999999999}]', [nulls(symbol="A")], None),
    "control message": (
        '[{"T":"success","msg":"connected"}]',
        [nulls(bar_type="success")],
        None,
    ),
    "single quotes": ("[{'S':'A'}]", [nulls(symbol="A")], None),
    "bare infinity": ('[{"S":"A","o":Infinity}]', [nulls(symbol="A", open=float("inf"))], None),
    "quoted infinity": (
        '[{"S":"A","o":"Infinity"}]',
        [nulls(symbol="A", open=float("inf"))],
        [zeros(symbol="A", open=float("inf"))],
    ),
    "blanks around": (f" [ {OK} ]", [OK_ROW], [OK_ROW]),
    "line breaks": (json.dumps(json.loads(f"[{OK}]"), indent=1), [OK_ROW], [OK_ROW]),
}


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(name, text) for name, (text, _, _) in CASES.items()] + [("sql null", None)]
    return spark.createDataFrame(rows, "key string, value string")


@pytest.fixture(scope="module", params=["permissive", "strict"])
def outcome(request, cases):
    mode = request.param
    flat = flatten_messages(cases, mode).withColumn("bar_time", F.col("bar_time").cast("string"))
    rows: dict[str, list] = {}
    for key, *values in flat.collect():
        rows.setdefault(key, []).append(tuple(values))
    rejected = {row.key for row in rejected_messages(cases, mode).collect()}
    return mode, rows, rejected


@pytest.mark.parametrize("case", CASES)
def test_parse_case(outcome, case):
    mode, rows, rejected = outcome
    expected = CASES[case][1 if mode == "permissive" else 2]
    assert (case in rejected) == (expected is None)
    assert rows.get(case, []) == (expected or [])


def test_absent_value_is_neither_read_nor_rejected(outcome):
    _, rows, rejected = outcome
    assert "sql null" not in rows and "sql null" not in rejected


def test_only_bars_drops_control_records(cases):
    kept = flatten_messages(cases, only_bars=True)
    assert {row.bar_type for row in kept.collect()} == {"b"}


def test_chosen_columns_equal_those_of_the_whole(cases):
    for mode in ("permissive", "strict"):
        some = flatten_messages(cases, mode, columns=["symbol", "bar_time"])
        whole = flatten_messages(cases, mode).select("key", "symbol", "bar_time")
        assert some.columns == whole.columns
        assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))


def test_only_bars_works_without_the_type_column(cases):
    kept = flatten_messages(cases, only_bars=True, columns=["symbol"])
    assert kept.columns == ["key", "symbol"]
    assert {row.symbol for row in kept.collect()} == {"QUX", "A"}


def test_binary_key_and_value(spark):
    df = spark.createDataFrame([(b"k", f"[{OK}]".encode())], "key binary, value binary")
    row = flatten_messages(df).first()
    assert row.key == "k" and row.symbol == "QUX"


def test_without_key(spark):
    df = spark.createDataFrame([(f"[{OK}]",)], "value string")
    assert flatten_messages(df).columns == list(BAR_COLUMNS)


def test_unknown_mode(cases):
    with pytest.raises(ValueError):
        flatten_messages(cases, mode="lenient")


@pytest.mark.parametrize("setting", ["true", "false"])
def test_case_sensitivity_does_not_matter(spark, cases, setting):
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", setting)
    try:
        for mode, at in (("permissive", 1), ("strict", 2)):
            expected = sum((case[at] or []).count(OK_ROW) for case in CASES.values())
            assert flatten_messages(cases, mode).filter("close = 8.0").count() == expected
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


@pytest.mark.parametrize("setting", ["true", "false"])
def test_ansi_mode_does_not_matter(spark, cases, setting):
    before = spark.conf.get("spark.sql.ansi.enabled")
    expected = sorted(map(str, flatten_messages(cases, "strict").collect()))
    spark.conf.set("spark.sql.ansi.enabled", setting)
    try:
        assert sorted(map(str, flatten_messages(cases, "strict").collect())) == expected
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
