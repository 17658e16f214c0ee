"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def canonical_json(text: Column | str) -> Column:
    """Re-serialise JSON text without layout; NULL where the text is not JSON.

    Keys come out sorted, so equal documents have equal texts.
    """
    return F.to_json(F.try_parse_json(_column(text)))


def not_blank(text: Column | str) -> Column:
    return F.length(F.trim(_column(text))) > 0


def thousands(number: Column | str) -> Column:
    """An integer with thousands separators; a fraction is cut off."""
    return F.format_number(_column(number).cast("bigint"), 0)
