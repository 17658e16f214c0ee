"""Schemas of the market-bar data: the wire format and the relation built from it.

On the wire a bar uses one-letter names of which two differ only by case (``T``
and ``t``).  Those names stay inside JSON; every relation uses the long names,
so nothing depends on ``spark.sql.caseSensitive``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wire field, relation column, type.
BAR_FIELDS = (
    ("T", "bar_type", T.StringType()),
    ("S", "symbol", T.StringType()),
    ("o", "open", T.DoubleType()),
    ("h", "high", T.DoubleType()),
    ("l", "low", T.DoubleType()),
    ("c", "close", T.DoubleType()),
    ("v", "volume", T.LongType()),
    ("t", "bar_time", T.StringType()),
    ("n", "trade_count", T.LongType()),
    ("vw", "vwap", T.DoubleType()),
)

# The wire field order of an outgoing flat bar.
OUTGOING_FIELDS = ("t", "T", "o", "h", "l", "c", "v", "n", "vw", "S")

#: Name of the time field in an outgoing flat bar.
TIME_FIELD = "time_stamp"

#: ``bar_type`` of a price bar; other values are control records.
BAR_TYPE = "b"

WIRE_NAMES = tuple(wire for wire, _, _ in BAR_FIELDS)
BAR_COLUMNS = tuple(name for _, name, _ in BAR_FIELDS)
COLUMN_OF = {wire: name for wire, name, _ in BAR_FIELDS}
WIRE_OF = {name: wire for wire, name, _ in BAR_FIELDS}
NUMERIC_COLUMNS = tuple(name for _, name, kind in BAR_FIELDS if not isinstance(kind, T.StringType))
PRICE_COLUMNS = ("open", "high", "low", "close")


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


#: One bar as parsed from JSON.
BAR = _struct((wire, kind) for wire, _, kind in BAR_FIELDS)

#: The payload of a message: a JSON array of bars.
BAR_ARRAY = T.ArrayType(BAR)

#: The relation of flattened bars: long names, UTC wall-clock time.
BARS = _struct(
    (name, T.TimestampNTZType() if name == "bar_time" else kind) for _, name, kind in BAR_FIELDS
)

#: A record of the message source.
MESSAGE = _struct(
    [
        ("key", T.BinaryType()),
        ("value", T.BinaryType()),
        ("topic", T.StringType()),
        ("partition", T.IntegerType()),
        ("offset", T.LongType()),
        ("timestamp", T.TimestampType()),
        ("timestampType", T.IntegerType()),
    ]
)

#: A line of newline-delimited history: a bar that names its symbol ``symbol``.
HISTORY = _struct([(wire, kind) for wire, _, kind in BAR_FIELDS] + [("symbol", T.StringType())])
HISTORY_COLUMNS = BAR_COLUMNS[:1] + ("wire_symbol",) + BAR_COLUMNS[2:] + ("symbol",)

#: A bar inside a response page: the page keys it by symbol.
PAGE_BAR = _struct((wire, kind) for wire, _, kind in BAR_FIELDS if wire not in ("T", "S"))
PAGE_BAR_COLUMNS = tuple(name for name in BAR_COLUMNS if name not in ("bar_type", "symbol"))

#: A page of the history response.
PAGE = _struct(
    [
        ("bars", T.MapType(T.StringType(), T.ArrayType(PAGE_BAR))),
        ("next_page_token", T.StringType()),
    ]
)

#: A tradable instrument.
ASSET = _struct(
    [("symbol", T.StringType()), ("exchange", T.StringType()), ("tradable", T.BooleanType())]
)
