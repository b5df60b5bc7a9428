"""Epoch seconds to UTC timestamps, months and configured periods."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodtide.config import OUTSIDE_PERIOD, UNKNOWN_PERIOD, Period
from moodtide.functions.numeric import coerce_double

# Fixed value: largest number of seconds a 64-bit nanosecond timestamp can hold.
_MAX_SECONDS = 9223372036


def _year_start(year: int) -> int:
    return int(datetime(year, 1, 1, tzinfo=timezone.utc).timestamp())


def epoch_in_years(c: Column, year_min: int, year_max: int, data_type: str = "string") -> Column:
    """Whether the epoch falls in those UTC years. Plain numeric bounds: unreadable, infinite
    and oversized values become NULL on the way and count as outside."""
    seconds = coerce_double(c, data_type).try_cast("bigint")
    inside = seconds.between(_year_start(year_min), _year_start(year_max + 1) - 1)
    return F.coalesce(inside, F.lit(False))


def epoch_to_timestamp(c: Column, data_type: str = "string") -> Column:
    """UTC timestamp, NULL for unreadable or unrepresentable values."""
    seconds = coerce_double(c, data_type)
    return F.when(seconds.between(-_MAX_SECONDS, _MAX_SECONDS), F.timestamp_seconds(seconds))


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def assign_time_period(year: Column, periods: tuple[Period, ...]) -> Column:
    """Name of the first configured period holding the year."""
    chain = F.when(year.isNull(), F.lit(UNKNOWN_PERIOD))
    for period in periods:
        low = F.lit(True) if period.first_year is None else year >= period.first_year
        high = F.lit(True) if period.last_year is None else year <= period.last_year
        chain = chain.when(low & high, F.lit(period.name))
    return chain.otherwise(F.lit(OUTSIDE_PERIOD))
