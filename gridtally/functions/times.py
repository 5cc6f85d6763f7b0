"""Time helpers.

All model time is zone-free (``timestamp_ntz``), so that no session setting can move a
reading into another hour. Nothing here casts through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _int(value: Column | int) -> Column:
    return F.lit(value) if isinstance(value, int) else value


def year_start(year: Column | int) -> Column:
    """Midnight of 1 January."""
    return F.make_date(_int(year), F.lit(1), F.lit(1)).cast("timestamp_ntz")


def add_hours(start: Column, hours: Column) -> Column:
    return start + F.make_dt_interval(hours=hours.cast("int"))


def hour_start(ts: Column, end_of_interval_minutes: int = 0) -> Column:
    """Start of the hour a reading belongs to.

    Feeds that stamp the end of each interval pass its length, so that a reading stamped
    01:00 belongs to the hour that starts at 00:00.
    """
    if end_of_interval_minutes:
        ts = ts - F.make_dt_interval(mins=F.lit(end_of_interval_minutes))
    return add_hours(F.to_date(ts).cast("timestamp_ntz"), F.hour(ts))


def days_in_year(year: Column | int) -> Column:
    year = _int(year)
    first, nxt = (F.make_date(y, F.lit(1), F.lit(1)) for y in (year, year + 1))
    return F.datediff(nxt, first)


def hours_in_year(year: Column | int) -> Column:
    return days_in_year(year) * 24


def hour_of_year(ts: Column) -> Column:
    """1-based hour of the year."""
    return (F.dayofyear(ts) - 1) * 24 + F.hour(ts) + 1
