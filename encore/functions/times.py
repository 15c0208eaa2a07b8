"""Timestamps and durations as column expressions (session time zone must be UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def parse_timestamp(text: Column, fmt: str = TEXT_FORMAT) -> Column:
    """Text to timestamp; text that does not follow the format becomes null."""
    return F.try_to_timestamp(text, F.lit(fmt))


def within_years(moment: Column, first: int = 2016, last: int = 2018) -> Column:
    """Keep the value inside the years, else null. The row itself always stays."""
    return F.when(F.year(moment).between(first, last), moment)


def micros(moment: Column) -> Column:
    """Microseconds since the epoch, for timestamps with or without a time zone."""
    return F.unix_micros(moment.cast("timestamp"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Days from ``earlier`` to ``later``, rounded down (minus half a day is -1)."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(MICROS_PER_DAY))


def hours_apart(start: Column, end: Column) -> Column:
    """Absolute distance in hours; null if one end is missing."""
    return F.abs(micros(end) - micros(start)) / F.lit(float(MICROS_PER_HOUR))
