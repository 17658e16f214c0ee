"""Price arithmetic on the columns of a bar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def high_of(high="high", close="close", open_="open") -> Column:
    """Highest price the bar's own prices allow."""
    return F.greatest(high, close, open_)


def low_of(low="low", close="close", open_="open") -> Column:
    """Lowest price the bar's own prices allow."""
    return F.least(low, close, open_)


def typical(high="high", low="low", close="close") -> Column:
    """Mean of high, low and close."""
    return (F.col(high) + F.col(low) + F.col(close)) / 3


def rounded_price(price: Column | str) -> Column:
    """A price in cents precision."""
    return F.round(price, 2)
