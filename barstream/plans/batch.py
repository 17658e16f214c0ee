"""Queries over batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical_json, display_time, instant, iso_time
from ..operators import batching, queries
from ..operators.flatten import flatten_messages, rejected_messages
from ..operators.history import bars_per_symbol, flatten_symbol_map, normalise_bars
from ..operators.numbering import number_rows, with_batch_id
from ..operators.wire import from_wire, to_wire, wire_fields
from ..schema import BAR_COLUMNS
from ..sources.history import parse_history
from . import tables
from .registry import COLUMNS_SQL, KEYED_SQL, query

SYMBOL = "click"
EXCHANGE = "NATION_7"


def flattened(spark: SparkSession, sf_dir: str, columns: Sequence[str] = BAR_COLUMNS) -> DataFrame:
    return flatten_messages(tables.messages(spark, sf_dir), columns=columns)


@query("flatten", f"SELECT {KEYED_SQL} FROM bars")
def flatten(spark, sf_dir):
    return flattened(spark, sf_dir)


@query("flatten_strict", f"SELECT {KEYED_SQL} FROM bars")
def flatten_strict(spark, sf_dir):
    return flatten_messages(tables.messages(spark, sf_dir), mode="strict")


@query("flatten_only_bars", f"SELECT {KEYED_SQL} FROM bars")
def flatten_only_bars(spark, sf_dir):
    return flatten_messages(tables.messages(spark, sf_dir), only_bars=True)


@query(
    "rejected_messages",
    "SELECT 'doc-' || doc_id AS key, text AS value FROM documents",
)
def rejected(spark, sf_dir):
    mixed = tables.messages(spark, sf_dir).union(tables.junk(spark, sf_dir))
    bad = rejected_messages(mixed)
    return bad.select(F.col("key").cast("string"), F.col("value").cast("string"))


@query("total_events", "SELECT count(*) AS total_events FROM bars")
def total_events(spark, sf_dir):
    return queries.total_events(flattened(spark, sf_dir, ["bar_type"]))


@query(
    "count_by_symbol",
    'SELECT symbol, count(*) AS "count" FROM bars GROUP BY symbol ORDER BY 2 DESC, 1',
)
def count_by_symbol(spark, sf_dir):
    return queries.count_by_symbol(flattened(spark, sf_dir, ["symbol"]))


@query("distinct_symbols", "SELECT DISTINCT symbol FROM bars")
def distinct_symbols(spark, sf_dir):
    return queries.distinct_symbols(flattened(spark, sf_dir, ["symbol"]))


@query(
    "profile_symbol",
    f"""SELECT min(bar_time) AS min_date, max(bar_time) AS max_date, count(*) AS total_records,
               count(DISTINCT symbol) AS distinct_symbols
        FROM bars WHERE symbol = '{SYMBOL}'""",
)
def profile_symbol(spark, sf_dir):
    return queries.profile_symbol(flattened(spark, sf_dir, ["symbol", "bar_time"]), SYMBOL)


@query(
    "daily_counts",
    f"""SELECT CAST(bar_time AS DATE) AS trade_date, count(*) AS total_trades
        FROM bars WHERE symbol = '{SYMBOL}' GROUP BY 1 ORDER BY 1 DESC""",
)
def daily_counts(spark, sf_dir):
    return queries.daily_counts(flattened(spark, sf_dir, ["symbol", "bar_time"]), SYMBOL)


_LATEST = "ORDER BY bar_time DESC, symbol, open, high, low, close, volume LIMIT 10"


@query(
    "latest_bars",
    f"SELECT symbol, open, high, low, close, volume, bar_time FROM bars {_LATEST}",
)
def latest_bars(spark, sf_dir):
    return queries.latest_bars(flattened(spark, sf_dir, queries.LATEST_COLUMNS))


@query(
    "display_bars",
    f"""SELECT strftime(bar_time, '%Y-%m-%d %H:%M:%S') AS time, symbol, round(open, 2) AS open,
               round(high, 2) AS high, round(low, 2) AS low, round(close, 2) AS close,
               format('{{:,}}', volume) AS volume, bar_time
        FROM (SELECT * FROM bars {_LATEST})""",
)
def display_bars(spark, sf_dir):
    return queries.display_bars(latest_bars(spark, sf_dir))


@query(
    "display_time",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS of_millis,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS of_text, event_type AS of_other
       FROM events""",
)
def show_time(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    millis = F.unix_millis(instant("ts"))
    return events.select(
        "event_id",
        display_time(millis).alias("of_millis"),
        display_time(iso_time("ts")).alias("of_text"),
        display_time("event_type").alias("of_other"),
    )


@query(
    "top_offsets",
    """SELECT b // 3 AS "offset" FROM (SELECT DISTINCT event_id // 100 AS b FROM events)
       ORDER BY 1 DESC LIMIT 10""",
)
def top_offsets(spark, sf_dir):
    return queries.top_offsets(tables.messages(spark, sf_dir))


@query(
    "resample_hour",
    """SELECT symbol, date_trunc('hour', bar_time) AS bar_time, arg_min(open, bar_time) AS open,
              max(high) AS high, min(low) AS low, arg_max(close, bar_time) AS close,
              CAST(sum(volume) AS BIGINT) AS volume,
              CAST(sum(trade_count) AS BIGINT) AS trade_count,
              round(sum(vwap * volume) / nullif(sum(volume), 0), 6) AS vwap
       FROM bars GROUP BY 1, 2""",
)
def resample_hour(spark, sf_dir):
    coarse = queries.resample_bars(flattened(spark, sf_dir), "1Hour")
    return coarse.withColumn("vwap", F.round("vwap", 6))


@query(
    "resample_week",
    """SELECT symbol, CAST(date_trunc('week', bar_time) AS TIMESTAMP) AS bar_time,
              arg_min(open, bar_time) AS open, max(high) AS high, min(low) AS low,
              arg_max(close, bar_time) AS close, CAST(sum(volume) AS BIGINT) AS volume,
              CAST(sum(trade_count) AS BIGINT) AS trade_count,
              round(sum(vwap * volume) / nullif(sum(volume), 0), 6) AS vwap
       FROM bars GROUP BY 1, 2""",
)
def resample_week(spark, sf_dir):
    """Weeks from Monday on."""
    coarse = queries.resample_bars(flattened(spark, sf_dir), "1Week")
    return coarse.withColumn("vwap", F.round("vwap", 6))


@query(
    "typical_price",
    "SELECT event_id, round((high + low + close) / 3, 2) AS typical_price FROM bars",
)
def typical_price(spark, sf_dir):
    priced = queries.typical_price(tables.bars(spark, sf_dir))
    return priced.select("event_id", "typical_price")


@query(
    "repair_ohlc",
    """SELECT event_id, open, greatest(high, value2, open) AS high, least(low, value2, open) AS low,
              value2 AS close
       FROM (SELECT *, close + trade_count - 50 AS value2 FROM bars)""",
)
def repair_ohlc(spark, sf_dir):
    drifted = tables.bars(spark, sf_dir).withColumn("close", F.col("close") + F.col("trade_count") - 50)
    return queries.repair_ohlc(drifted).select("event_id", "open", "high", "low", "close")


@query(
    "bar_rate",
    """SELECT count(*) AS bars, round(epoch(max(bar_time)) - epoch(min(bar_time)), 6) AS seconds,
              round(count(*) / (epoch(max(bar_time)) - epoch(min(bar_time))), 9) AS bars_per_second
       FROM bars""",
)
def bar_rate(spark, sf_dir):
    rate = queries.bar_rate(flattened(spark, sf_dir, ["bar_time"]))
    return rate.select(
        "bars",
        F.round("seconds", 6).alias("seconds"),
        F.round("bars_per_second", 9).alias("bars_per_second"),
    )


@query(
    "to_wire",
    """SELECT CAST(event_id // 100 AS VARCHAR) AS key,
              to_json({'time_stamp': replace(CAST(bar_time AS VARCHAR), ' ', 'T') || 'Z',
                       'T': bar_type, 'o': open, 'h': high, 'l': low, 'c': close, 'v': volume,
                       'n': trade_count, 'vw': vwap, 'S': symbol})::VARCHAR AS value
       FROM bars""",
)
def wire(spark, sf_dir):
    return to_wire(flattened(spark, sf_dir))


@query("to_wire_roundtrip", f"SELECT {KEYED_SQL} FROM bars")
def wire_roundtrip(spark, sf_dir):
    return from_wire(to_wire(flattened(spark, sf_dir)))


@query(
    "canonical_json",
    "SELECT event_id, CAST(json(props) AS VARCHAR) AS props FROM events",
)
def canonical(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", canonical_json("props").alias("props"))


@query("normalise_bars", f"SELECT {COLUMNS_SQL} FROM bars")
def normalise(spark, sf_dir):
    """History lines of three kinds: with ``symbol``, with ``S``, and with an empty ``symbol``."""
    bars = tables.bars(spark, sf_dir)
    fields = wire_fields(*[c for c in BAR_COLUMNS if c not in ("bar_type", "symbol")])
    busy, rare = F.col("trade_count") >= 50, F.col("trade_count") < 10
    lines = bars.select(
        F.to_json(
            F.struct(
                F.when(rare, F.col("bar_type")).alias("T"),
                F.when(~busy, F.col("symbol")).alias("S"),
                F.when(busy, F.col("symbol")).when(~rare, F.lit("")).alias("symbol"),
                *fields,
            )
        ).alias("value")
    )
    return normalise_bars(parse_history(lines))


@query(
    "flatten_symbol_map",
    f"SELECT event_id // 10000 AS page_id, {COLUMNS_SQL} FROM bars",
)
def symbol_map(spark, sf_dir):
    return flatten_symbol_map(tables.event_pages(spark, sf_dir), ("page_id",))


@query(
    "bars_per_symbol",
    "SELECT event_id // 10000 AS page_id, symbol, CAST(count(*) AS INTEGER) AS bars FROM bars GROUP BY 1, 2",
)
def page_symbols(spark, sf_dir):
    return bars_per_symbol(tables.event_pages(spark, sf_dir), ("page_id",))


@query("repack_roundtrip", f"SELECT {COLUMNS_SQL} FROM bars")
def repack_roundtrip(spark, sf_dir):
    packed = batching.repack_messages(tables.bars(spark, sf_dir), order_by=["bar_time", "event_id"])
    return flatten_messages(packed.select("value"))


@query(
    "repack_messages",
    """SELECT symbol, b AS batch_id, CAST(count(*) AS INTEGER) AS records,
              CAST(min(bar_time) AS VARCHAR) AS first, CAST(max(bar_time) AS VARCHAR) AS last
       FROM (SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY bar_time, event_id) - 1) // 100
                    AS b FROM bars)
       GROUP BY 1, 2""",
)
def repack(spark, sf_dir):
    """Each symbol's bars packed in time order; first and last time read back from the text."""
    packed = batching.repack_messages(
        tables.bars(spark, sf_dir), order_by=["bar_time", "event_id"], within=["symbol"]
    )
    times = F.from_json("value", "array<struct<t:string>>")["t"]

    def plain(time):
        return F.replace(F.rtrim(time, F.lit("Z")), F.lit("T"), F.lit(" "))

    return packed.select(
        "symbol",
        "batch_id",
        "records",
        plain(F.element_at(times, 1)).alias("first"),
        plain(F.element_at(times, -1)).alias("last"),
    )


@query(
    "with_batch_id",
    """SELECT event_id, symbol,
              (row_number() OVER (PARTITION BY symbol ORDER BY bar_time, event_id) - 1) // 100
                AS batch_id
       FROM bars""",
)
def batch_ids(spark, sf_dir):
    keys = tables.bars(spark, sf_dir).select("event_id", "symbol", "bar_time")
    return with_batch_id(keys, 100, ["bar_time", "event_id"], ["symbol"]).drop("bar_time")


@query(
    "number_rows",
    "SELECT event_id, row_number() OVER (ORDER BY value, event_id) - 1 AS row_index FROM events",
)
def row_numbers(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("event_id", "value")
    return number_rows(events, ["value", "event_id"]).drop("value")


@query(
    "archive_manifest",
    """SELECT 'bars' AS topic, CAST(p AS INTEGER) AS partition, chunk, min(o) AS start_offset,
              count(*) AS records, 'bars-' || p || '-' || min(o) || '.jsonl.gz' AS object_name
       FROM (SELECT event_id % 3 AS p, event_id // 3 AS o,
                    (row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1) // 1000
                      AS chunk
             FROM events)
       GROUP BY p, chunk""",
)
def manifest(spark, sf_dir):
    return batching.archive_manifest(tables.records(spark, sf_dir))


@query(
    "batch_totals",
    """WITH pages AS (
         SELECT o_custkey // 100 + 1 AS batch_id, o_orderkey // 10000 AS page_id, count(*) AS bars
         FROM orders GROUP BY 1, 2),
       symbols AS (SELECT DISTINCT o_custkey // 100 + 1 AS batch_id, o_custkey FROM orders)
       SELECT p.batch_id, p.is_total, p.bars, p.pages, s.symbols
       FROM (SELECT batch_id, grouping(batch_id) = 1 AS is_total,
                    CAST(sum(bars) AS BIGINT) AS bars, count(*) AS pages
             FROM pages GROUP BY ROLLUP (batch_id)) p
       JOIN (SELECT batch_id, grouping(batch_id) = 1 AS is_total, count(*) AS symbols
             FROM symbols GROUP BY ROLLUP (batch_id)) s
         ON p.batch_id IS NOT DISTINCT FROM s.batch_id AND p.is_total = s.is_total""",
)
def batch_totals(spark, sf_dir):
    return batching.batch_totals(tables.order_pages(spark, sf_dir))


@query(
    "batch_symbols",
    """SELECT c_custkey // 100 + 1 AS batch_id,
              string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY CAST(c_custkey AS VARCHAR)) AS symbols
       FROM customer GROUP BY 1""",
)
def batch_symbols(spark, sf_dir):
    batches = batching.symbol_batches(tables.customers(spark, sf_dir), dense_id="c_custkey")
    return batching.batch_symbols(batches)


@query(
    "symbol_coverage",
    """SELECT count(*) AS requested, count(o_custkey) AS with_data,
              count(o_custkey) / count(*) AS coverage
       FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey""",
)
def coverage(spark, sf_dir):
    return batching.symbol_coverage(
        tables.customers(spark, sf_dir), tables.orders_as_bars(spark, sf_dir)
    )


@query(
    "missing_symbols",
    """SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
)
def missing(spark, sf_dir):
    return batching.missing_symbols(
        tables.customers(spark, sf_dir), tables.orders_as_bars(spark, sf_dir)
    )


@query(
    "tradable_symbols",
    "SELECT s_name AS symbol FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0",
)
def tradable(spark, sf_dir):
    return batching.tradable_symbols(tables.assets(spark, sf_dir))


@query(
    "tradable_symbols_of_exchange",
    f"""SELECT s_name AS symbol FROM supplier JOIN nation ON s_nationkey = n_nationkey
        WHERE s_acctbal > 0 AND n_name = '{EXCHANGE}'""",
)
def tradable_of_exchange(spark, sf_dir):
    return batching.tradable_symbols(tables.assets(spark, sf_dir), EXCHANGE)
