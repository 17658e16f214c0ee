"""Byte sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MEGABYTE = 1024 * 1024


def megabytes(size: Column) -> Column:
    return size / F.lit(_MEGABYTE)


def average_or_zero(total: Column, count: Column) -> Column:
    """``total / count``, and 0 where there is nothing to average."""
    return F.when(count > 0, total / count).otherwise(F.lit(0.0))
