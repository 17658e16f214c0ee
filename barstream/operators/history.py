"""History records and response pages brought to the bar relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import parse_time
from ..schema import BAR_COLUMNS, BAR_TYPE, PAGE, PAGE_BAR_COLUMNS


def normalise_bars(df: DataFrame) -> DataFrame:
    """History rows (``symbol`` and ``wire_symbol``) to the bar relation.

    The symbol is the record's ``symbol`` unless empty, else its ``S``, else the
    empty text; an absent type means a bar.
    """
    symbol = F.coalesce(F.nullif("symbol", F.lit("")), F.col("wire_symbol"), F.lit(""))
    kind = F.coalesce("bar_type", F.lit(BAR_TYPE))
    derived = {"symbol": symbol.alias("symbol"), "bar_type": kind.alias("bar_type")}
    return df.select(*[derived.get(name, F.col(name)) for name in BAR_COLUMNS])


def _by_symbol(pages: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """One row per (page, symbol): place in the page, symbol, array of bars."""
    page = F.from_json(F.col("value").cast("string"), PAGE)
    return pages.select(*keep, F.posexplode(page["bars"]).alias("at", "symbol", "bars"))


def flatten_symbol_map(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pages (``value`` = JSON with a symbol-to-bars map) to one row per bar.

    A symbol with an empty array gives no rows.  ``keep`` names page columns to
    carry along.
    """
    rows = _by_symbol(pages, keep).select(*keep, "symbol", F.inline("bars"))
    rows = rows.toDF(*keep, "symbol", *PAGE_BAR_COLUMNS)
    derived = {
        "bar_type": F.lit(BAR_TYPE).alias("bar_type"),
        "bar_time": parse_time("bar_time").alias("bar_time"),
    }
    return rows.select(*keep, *[derived.get(name, F.col(name)) for name in BAR_COLUMNS])


def bars_per_symbol(
    pages: DataFrame, keep: tuple[str, ...] = (), position: str | None = None
) -> DataFrame:
    """Number of bars of each symbol in each page.

    ``position`` names an extra column with the symbol's place in its page.
    """
    place = [F.col("at").alias(position)] if position else []
    return _by_symbol(pages, keep).select(
        *keep, *place, "symbol", F.coalesce(F.size("bars"), F.lit(0)).alias("bars")
    )
