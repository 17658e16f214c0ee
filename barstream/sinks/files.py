"""Text outputs: history lines and symbol lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.wire import wire_fields
from ..schema import BAR_COLUMNS


def history_lines(bars: DataFrame) -> DataFrame:
    """Bars as history lines: no type, the symbol under ``symbol``."""
    fields = [c for c in BAR_COLUMNS if c not in ("bar_type", "symbol")]
    record = F.struct(*wire_fields(*fields), "symbol")
    return bars.select(F.to_json(record).alias("value"))


def write_history(bars: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Newline-delimited JSON history."""
    history_lines(bars).write.mode(mode).text(path)


def write_symbols(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A symbol list, one per line."""
    df.select("symbol").write.mode(mode).text(path)
