"""Messages holding JSON arrays of bars, flattened to one row per bar.

Everything here is a stateless select, so it runs unchanged on a batch and on a
stream, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import parse_time
from ..schema import BAR, BAR_COLUMNS, BAR_FIELDS, BAR_TYPE, WIRE_OF

MODES = ("permissive", "strict")

# The range of the strict mode's trade count.
_INT_RANGE = (-(2**31), 2**31 - 1)
_BIGINT_RANGE = (-(2**63), 2**63 - 1)

#: What the strict mode does not take for JSON: single quotes, bare NaN and Infinity.
_PLAIN_JSON = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def parsed_bars(mode: str = "permissive", columns: Sequence[str] = BAR_COLUMNS) -> Column:
    """The array of bars in ``value``, or NULL for a message that is rejected.

    ``permissive`` keeps whatever can be read: unknown fields are ignored, a
    field of the wrong type becomes NULL, a lone object counts as an array of
    one.  ``strict`` rejects the whole message in those cases, coerces numbers
    the way typed deserialisers do and reads an absent number as 0.
    A ``null`` element yields no bar in either mode.

    ``columns`` limits the fields that are converted, except in ``strict`` mode,
    which has to see them all; what is rejected does not depend on it.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "strict":
        parsed = _strict()
    else:
        text = F.col("value").cast("string")
        parsed = F.from_json(text, T.ArrayType(T.StructType([BAR[WIRE_OF[c]] for c in columns])))
    return F.filter(parsed, lambda bar: bar.isNotNull())


def explode_bars(
    df: DataFrame,
    bars: Column,
    only_bars: bool = False,
    typed_time: bool = True,
    columns: Sequence[str] = BAR_COLUMNS,
) -> DataFrame:
    """One row per element of ``bars``, with the message ``key`` kept when present.

    The array is given as an expression: behind a column of its own the optimiser
    would test it for emptiness first, and parse every message again to do so.
    """
    keep = [F.col("key").cast("string")] if "key" in df.columns else []
    rows = df.select(*keep, F.inline(bars)).toDF(*(["key"] if keep else []), *columns)
    if only_bars:
        rows = rows.filter(F.col("bar_type") == BAR_TYPE)
    if typed_time and "bar_time" in columns:
        rows = rows.withColumn("bar_time", parse_time("bar_time"))
    return rows


def flatten_messages(
    df: DataFrame,
    mode: str = "permissive",
    only_bars: bool = False,
    typed_time: bool = True,
    columns: Sequence[str] = BAR_COLUMNS,
) -> DataFrame:
    """Flatten messages (``value`` = JSON array of bars) to the bar relation.

    ``only_bars`` drops control records.  ``typed_time=False`` leaves the time
    as the text that came in, for sinks that pass it on unchanged.  ``columns``
    names the bar columns wanted; fields of the others are not converted at all.
    """
    read = [*columns, "bar_type"] if only_bars and "bar_type" not in columns else list(columns)
    if mode == "strict":
        read = BAR_COLUMNS
    rows = explode_bars(df, parsed_bars(mode, read), only_bars, typed_time, read)
    return rows.drop(*[c for c in read if c not in columns])


def rejected_messages(df: DataFrame, mode: str = "permissive") -> DataFrame:
    """The messages ``flatten_messages`` gives no rows for because they cannot be read."""
    return df.filter(F.col("value").isNotNull() & parsed_bars(mode, ["symbol"]).isNull())


def _strict() -> Column:
    """The strict reading of ``value``, written in SQL: one expression, built in one step.

    Nearly every message is clean: each of its keys became a value, which a few
    counts show, and the parsed array is the result.  Only other messages are
    parsed again, field by field with their JSON types.

    ``transform(array(x), name -> ...)[0]`` binds a value to a name, so that it is
    computed once however often it is used.
    """
    # A flat array of non-empty objects has one comma less than it has keys.  Commas
    # and brackets inside values make the counts disagree, never agree.
    clean = (
        "size(bars) = 0 OR (found = size(split(text, ',')) AND "
        r"size(bars) = size(split(text, '\\{')) - 1 AND size(split(text, '\\[')) = 2)"
    )
    present = " + ".join(f"CAST(bar.`{name}` IS NOT NULL AS INT)" for name in BAR_COLUMNS)
    usual = "bar.symbol IS NOT NULL AND coalesce(bar.trade_count BETWEEN {} AND {}, true)"
    found = (
        f"aggregate(bars, 0, (n, bar) -> n + CASE WHEN {usual.format(*_INT_RANGE)} "
        f"THEN {present} END)"
    )
    whole = f"found = size(bars) * {len(BAR_FIELDS)}"
    filled = _named_struct(lambda wire, name, kind: _or_zero(f"bar.`{name}`", kind))
    with_defaults = f"transform(bars, bar -> {filled})"
    parsed = f"CAST(from_json(text, '{_ddl(0)}', {_PLAIN_JSON}) AS {_ddl(1)})"
    return F.expr(
        rf"""transform(array(CAST(value AS STRING)), text ->
              CASE WHEN text RLIKE r'^\s*\[' THEN transform(array({parsed}), bars ->
                transform(array({found}), found ->
                  CASE WHEN {clean} THEN CASE WHEN {whole} THEN bars ELSE {with_defaults} END
                       ELSE {_by_type_sql()} END)[0])[0] END)[0]"""
    )


def _by_type_sql() -> str:
    """The bars in ``text`` if all fields of all elements are acceptable, else NULL."""
    # Of a repeated field the last value counts.
    def value(wire: str, name: str, kind: T.DataType) -> str:
        given = f"filter(map_entries(e), f -> f.key = '{wire}')"
        text = f"try_variant_get(try_element_at({given}, -1).value, '$', 'string')"
        if isinstance(kind, T.StringType):
            return text
        exact = "DOUBLE" if isinstance(kind, T.DoubleType) else "DECIMAL(38,10)"
        return _or_zero(f"try_cast(try_cast(trim({text}) AS {exact}) AS {_sql(kind)})", kind)

    fine = _field_is_fine_sql()
    return f"""transform(array(from_json(text, 'array<map<string,variant>>', {_PLAIN_JSON})), es ->
      CASE WHEN forall(es, e -> e IS NULL OR forall(map_entries(e), f -> {fine}))
           THEN transform(es, e -> CASE WHEN e IS NOT NULL THEN {_named_struct(value)} END)
      END)[0]"""


def _field_is_fine_sql() -> str:
    """Whether ``f`` is a known field whose value its type can take."""
    shape = "schema_of_variant(f.value)"
    text = "trim(try_variant_get(f.value, '$', 'string'))"
    number = f"try_cast({text} AS DECIMAL(38,10))"

    # A number loses its fraction, so the bounds lie one further out; a text may have none.
    def whole(low: int, high: int) -> str:
        bounds = f"{number} > {low - 1}BD AND {number} < {high + 1}BD"
        return rf"(({shape} != 'STRING' OR {text} RLIKE r'^[+-]?\d+$') AND {bounds})"

    return f"""f.key IN ({_names_of(T.DataType)}) AND (
      f.value IS NULL OR is_variant_null(f.value) OR (
        NOT {shape} LIKE 'OBJECT%' AND NOT {shape} LIKE 'ARRAY%' AND (
          f.key IN ({_names_of(T.StringType)}) OR coalesce(
            CASE WHEN {shape} = 'BOOLEAN' THEN false
                 WHEN {shape} = 'STRING' AND {text} = '' THEN true
                 WHEN f.key IN ({_names_of(T.DoubleType)}) THEN try_cast({text} AS DOUBLE) IS NOT NULL
                 WHEN f.key = 'n' THEN {whole(*_INT_RANGE)}
                 ELSE {whole(*_BIGINT_RANGE)} END, false))))"""


def _sql(kind: T.DataType) -> str:
    return kind.simpleString()


def _names_of(kind: type[T.DataType]) -> str:
    return ", ".join(f"'{wire}'" for wire, _, of in BAR_FIELDS if isinstance(of, kind))


def _or_zero(value: str, kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return value
    return f"coalesce({value}, CAST(0 AS {_sql(kind)}))"


def _named_struct(value: Callable[[str, str, T.DataType], str]) -> str:
    fields = (f"'{name}', {value(wire, name, kind)}" for wire, name, kind in BAR_FIELDS)
    return f"named_struct({', '.join(fields)})"


def _ddl(which: int) -> str:
    """The array type with wire names (0) or column names (1)."""
    return f"array<struct<{', '.join(f'{field[which]}:{_sql(field[2])}' for field in BAR_FIELDS)}>>"
