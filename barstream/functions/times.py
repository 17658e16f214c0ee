"""Time conversions that do not depend on the session time zone or on ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A numeric UTC offset at the end of a time text; the last
# millisecond of the year 9999.
_OFFSET = r"[+-]\d{2}:?\d{2}$"
_LAST_MILLIS = 253_402_300_799_999


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _from_micros(micros: Column) -> Column:
    """UTC wall clock that lies ``micros`` after the epoch."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, seconds
    )


def utc_wall_clock(instant: Column | str) -> Column:
    """An instant (``timestamp``) as UTC wall clock (``timestamp_ntz``)."""
    return _from_micros(F.unix_micros(_column(instant)))


def instant(time: Column | str) -> Column:
    """UTC wall clock (``timestamp_ntz``) as an instant (``timestamp``)."""
    return F.concat(_column(time).cast("string"), F.lit("Z")).cast("timestamp")


def parse_time(text: Column | str) -> Column:
    """ISO-8601 text to UTC wall clock; NULL where it is not a time.

    ``Z`` and absent zones are already UTC wall clock, so the common case is one
    cast; only texts with a numeric offset go through an instant.
    """
    text = _column(text)
    shifted = ~text.endswith("Z") & text.rlike(_OFFSET)
    return F.when(shifted, utc_wall_clock(text.try_cast("timestamp"))).otherwise(
        text.try_cast("timestamp_ntz")
    )


def iso_time(time: Column | str) -> Column:
    """UTC wall clock to ``2025-11-20T14:35:00Z``, with sub-seconds only if present."""
    return F.concat(F.replace(_column(time).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def display_time(value: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an epoch-milliseconds number or of a time text.

    What is neither is shown unchanged.
    """
    text = _column(value).cast("string")
    millis = text.try_cast("bigint")
    in_range = millis.between(-_LAST_MILLIS, _LAST_MILLIS)
    time = F.coalesce(F.when(in_range, _from_micros(millis * 1000)), parse_time(text))
    return F.coalesce(F.substring(time.cast("string"), 1, 19), text)


def to_milliseconds(time: Column | str) -> Column:
    """Wall-clock time with everything below the millisecond cut off."""
    time = _column(time)
    second = F.extract(F.lit("SECOND"), time - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    below = F.pmod(second, F.lit("0.001").cast("decimal(8,6)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return time - F.make_dt_interval(zero, zero, zero, below)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds between two wall-clock times, with sub-seconds."""
    gap = _column(end) - _column(start)
    return (
        F.extract(F.lit("DAY"), gap) * 86400.0
        + F.extract(F.lit("HOUR"), gap) * 3600.0
        + F.extract(F.lit("MINUTE"), gap) * 60.0
        + F.extract(F.lit("SECOND"), gap).cast("double")
    )
