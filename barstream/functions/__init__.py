"""Column functions; each builds a Spark expression and nothing else."""

from .prices import high_of, low_of, rounded_price, typical
from .sizes import average_or_zero, megabytes
from .text import canonical_json, not_blank, thousands
from .times import (
    display_time,
    instant,
    iso_time,
    parse_time,
    seconds_between,
    to_milliseconds,
    utc_wall_clock,
)

__all__ = [
    "average_or_zero",
    "canonical_json",
    "display_time",
    "high_of",
    "instant",
    "iso_time",
    "low_of",
    "megabytes",
    "not_blank",
    "parse_time",
    "rounded_price",
    "seconds_between",
    "thousands",
    "to_milliseconds",
    "typical",
    "utc_wall_clock",
]
