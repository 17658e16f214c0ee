"""Bars to outgoing JSON messages and back to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import iso_time, parse_time, to_milliseconds, utc_wall_clock
from ..schema import (
    BAR_COLUMNS,
    BAR_FIELDS,
    COLUMN_OF,
    NUMERIC_COLUMNS,
    OUTGOING_FIELDS,
    TIME_FIELD,
    WIRE_OF,
)

# What the tick table stores for an absent value.
NUMERIC_DEFAULT = 0
TEXT_DEFAULT = "null"


def to_wire(df: DataFrame, time_field: str = TIME_FIELD, keep_nulls: bool = False) -> DataFrame:
    """One JSON message per bar; the time leads and is called ``time_field``.

    A time that is still text goes out byte for byte as it came in.  The message
    ``key`` is kept when present.  Absent values are left out of the JSON unless
    ``keep_nulls``.
    """
    typed = isinstance(df.schema["bar_time"].dataType, (T.TimestampNTZType, T.TimestampType))

    def field(wire: str) -> Column:
        column = F.col(COLUMN_OF[wire])
        if wire != "t":
            return column.alias(wire)
        return (iso_time(column) if typed else column).alias(time_field)

    record = F.struct(*[field(wire) for wire in OUTGOING_FIELDS])
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    keep = ["key"] if "key" in df.columns else []
    return df.select(*keep, F.to_json(record, options).alias("value"))


def from_wire(df: DataFrame, time_field: str = TIME_FIELD) -> DataFrame:
    """Flat JSON messages (``value``) to the bar relation.

    The time may be ISO text or epoch milliseconds.  A message that is not JSON
    gives no row.
    """
    # The time field leads, as in the messages; all other names keep their type.
    fields = [T.StructField(time_field, T.StringType())] + [
        T.StructField(wire, kind) for wire, _, kind in BAR_FIELDS if wire != "t"
    ]
    names = ["bar_time"] + [column for wire, column, _ in BAR_FIELDS if wire != "t"]
    keep = ["key"] if "key" in df.columns else []
    one = F.from_json(F.col("value").cast("string"), T.ArrayType(T.StructType(fields)))
    rows = df.select(*keep, F.inline(one)).toDF(*keep, *names)
    millis = F.col("bar_time").try_cast("bigint")
    time = F.coalesce(utc_wall_clock(F.timestamp_millis(millis)), parse_time("bar_time"))
    return rows.select(*keep, *[time.alias(c) if c == "bar_time" else c for c in BAR_COLUMNS])


def as_ticks(df: DataFrame, fill_defaults: bool = False) -> DataFrame:
    """Bars as rows of the tick table: time in milliseconds, ``trade_date`` added.

    ``fill_defaults`` stores 0 and ``"null"`` for absent numbers and texts.
    """
    millis = to_milliseconds("bar_time")
    ticks = df.select(*[millis.alias(c) if c == "bar_time" else c for c in BAR_COLUMNS])
    if fill_defaults:
        ticks = ticks.na.fill(NUMERIC_DEFAULT, list(NUMERIC_COLUMNS)).na.fill(
            TEXT_DEFAULT, ["bar_type", "symbol"]
        )
    return ticks.withColumn("trade_date", F.to_date("bar_time"))


def wire_fields(*columns: str) -> list[Column]:
    """Bar columns under their wire names, the time as text."""
    return [
        (iso_time(name) if name == "bar_time" else F.col(name)).alias(WIRE_OF[name])
        for name in columns
    ]


def to_array_element() -> Column:
    """A bar as a struct with wire names, for building message arrays."""
    return F.struct(*wire_fields(*BAR_COLUMNS))
