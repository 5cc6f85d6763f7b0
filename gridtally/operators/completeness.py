"""Gaps and repeats in a regular feed, from a bitmap of slots per series and day.

A day of 5-minute readings has 288 slots: the bits of five 64-bit words. One aggregation over the feed
sets them (``bit_or`` has buffers of fixed width, combines before the shuffle and needs no sort), beside
a count of the readings. Zeros are the slots without a reading; readings less ones are the repeats.
What follows has a row per series and day, whatever the number of readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440
_WORD = 64


def _slots(step_minutes: int) -> int:
    if step_minutes < 1 or MINUTES_PER_DAY % step_minutes:
        raise ValueError("a day must hold a whole number of steps")
    return MINUTES_PER_DAY // step_minutes


def _words(step_minutes: int) -> list[str]:
    return [f"_slots_{i}" for i in range(-(-_slots(step_minutes) // _WORD))]


def _slot(ts: Column, step_minutes: int) -> Column:
    return F.floor((F.hour(ts) * 60 + F.minute(ts)) / step_minutes).cast("int")


def _start_of_interval(ts: str, end_of_interval_minutes: int) -> Column:
    stamp = F.col(ts).cast("timestamp_ntz")
    if end_of_interval_minutes:
        stamp = stamp - F.make_dt_interval(mins=F.lit(end_of_interval_minutes))
    return stamp


def slot_days(
    feed: DataFrame,
    keys: Sequence[str],
    step_minutes: int = 5,
    ts: str = "date_time",
    end_of_interval_minutes: int = 0,
) -> DataFrame:
    """``keys…, day``, the words of the day's bitmap, and ``readings``.

    A reading counts for the slot its stamp lies in; ``end_of_interval_minutes`` is taken off stamps
    that name the end of an interval. Rows without a stamp are left out.
    """
    stamped = feed.where(F.col(ts).isNotNull()).select(
        *keys, _start_of_interval(ts, end_of_interval_minutes).alias("_stamp")
    )
    rows = stamped.select(*keys, F.to_date("_stamp").alias("day"), _slot(F.col("_stamp"), step_minutes).alias("_slot"))
    bits = [
        F.expr(
            f"bit_or(CASE WHEN _slot div {_WORD} = {i} THEN shiftleft(1L, _slot % {_WORD}) ELSE 0L END)"
        ).alias(word)
        for i, word in enumerate(_words(step_minutes))
    ]
    return rows.groupBy(*keys, "day").agg(*bits, F.count(F.lit(1)).alias("readings"))


def _grid(
    feed: DataFrame, ts: str, end_of_interval_minutes: int, start: str | None, end: str | None
) -> tuple[Column, Column]:
    """The first and the last stamp that should be there."""
    stamp = _start_of_interval(ts, end_of_interval_minutes)
    low = feed.agg(F.min(stamp)).scalar() if start is None else F.lit(start).cast("timestamp_ntz")
    high = feed.agg(F.max(stamp)).scalar() if end is None else F.lit(end).cast("timestamp_ntz")
    return low, high


def merged(days: DataFrame, keys: Sequence[str], step_minutes: int = 5) -> DataFrame:
    """One row for each series and day from several of :func:`slot_days`, of different files."""
    bits = [F.bit_or(w).alias(w) for w in _words(step_minutes)]
    return days.groupBy(*keys, "day").agg(*bits, F.sum("readings").alias("readings"))


def _over_grid(
    found: DataFrame, expected: DataFrame, keys: Sequence[str], step_minutes: int, low: Column, high: Column
) -> DataFrame:
    """Every series on every day of the grid: its bitmap, readings, and the slots ``_low`` to
    ``_high`` that the grid has on that day."""
    spine = expected.withColumns({"_low": low, "_high": high})
    first, last = F.to_date("_low"), F.to_date("_high")
    spine = spine.withColumn("day", F.explode(F.sequence(first, last)))
    n, ids = _slots(step_minutes), [*keys, "day"]
    spine = spine.select(
        *ids,
        F.when(F.col("day") == first, _slot(F.col("_low"), step_minutes)).otherwise(0).alias("_low"),
        F.when(F.col("day") == last, _slot(F.col("_high"), step_minutes)).otherwise(n - 1).alias("_high"),
    )
    own = found.withColumnsRenamed({k: f"_own_{k}" for k in ids})
    joined = spine.join(own, [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in ids], "left")
    counts = [F.coalesce(F.col(w), F.lit(0)).alias(w) for w in [*_words(step_minutes), "readings"]]
    return joined.select(*ids, "_low", "_high", *counts)


def _days(
    feed: DataFrame,
    keys: Sequence[str],
    step_minutes: int,
    ts: str,
    end_of_interval_minutes: int,
    series: DataFrame | None,
    start: str | None,
    end: str | None,
) -> DataFrame:
    stamp = _start_of_interval(ts, end_of_interval_minutes)
    inside = feed
    if start is not None:
        inside = inside.where(stamp >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        inside = inside.where(stamp <= F.lit(end).cast("timestamp_ntz"))
    found = slot_days(inside, keys, step_minutes, ts, end_of_interval_minutes)
    low, high = _grid(feed, ts, end_of_interval_minutes, start, end)
    expected = (feed if series is None else series).select(*keys).distinct()
    return _over_grid(found, expected, keys, step_minutes, low, high)


def _counts(days: DataFrame, keys: Sequence[str], step_minutes: int) -> DataFrame:
    ones = " + ".join(f"bit_count({w})" for w in _words(step_minutes))
    expected = F.col("_high") - F.col("_low") + 1
    return days.select(
        *keys,
        "day",
        expected.alias("expected"),
        "readings",
        (expected - F.expr(ones)).alias("missing"),
        (F.col("readings") - F.expr(ones)).alias("repeated"),
    )


def coverage_of_year(days: DataFrame, keys: Sequence[str], year: int, step_minutes: int = 5) -> DataFrame:
    """:func:`coverage` over a calendar year, from :func:`slot_days` of any number of files."""
    of_year = days.where(F.year("day") == year)
    low = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    high = F.lit(f"{year}-12-31 23:59:00").cast("timestamp_ntz")
    over = _over_grid(merged(of_year, keys, step_minutes), days.select(*keys).distinct(), keys, step_minutes, low, high)
    return _counts(over, keys, step_minutes)


def coverage(
    feed: DataFrame,
    keys: Sequence[str],
    step_minutes: int = 5,
    ts: str = "date_time",
    end_of_interval_minutes: int = 0,
    series: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """``keys…, day, expected, readings, missing, repeated`` of every series on every day.

    The grid runs from ``start`` up to and including ``end``; without them from the feed's first to
    its last stamp, which costs one more pass over the stamps. ``series`` lists the series that should
    report; without it they are those found. A day without any reading has a row, too.
    """
    days = _days(feed, keys, step_minutes, ts, end_of_interval_minutes, series, start, end)
    return _counts(days, keys, step_minutes)


def missing_slots(
    feed: DataFrame,
    keys: Sequence[str],
    step_minutes: int = 5,
    ts: str = "date_time",
    end_of_interval_minutes: int = 0,
    series: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """``keys…`` and the start of each slot of the grid without a reading, under the name ``ts``.

    The grid and the series are those of :func:`coverage`. Only the zeros of the bitmaps become rows.
    """
    days = _days(feed, keys, step_minutes, ts, end_of_interval_minutes, series, start, end)
    words = ", ".join(_words(step_minutes))
    zeros = F.expr(
        f"filter(sequence(_low, _high), s -> shiftrightunsigned(element_at(array({words}), cast(s div {_WORD} AS INT) + 1), s % {_WORD}) & 1 = 0)"
    )
    slots = days.select(*keys, "day", F.explode(zeros).alias("_slot"))
    start_of = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("_slot") * step_minutes)
    return slots.select(*keys, start_of.alias(ts))
