"""Model time: hour spines, and the mapping between timestamps and (horizon, period).

A dispatch model solves a year as a chain of horizons ``r11, r12, …`` of equal length. The
mapping to timestamps is arithmetic on the hour number, so tables are stamped row by row;
no mapping table is joined.
"""

from __future__ import annotations

import calendar as _calendar
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.functions import (
    add_hours,
    days_in_year,
    hour_of_year,
    hours_in_year,
    year_start,
)

# First hour (1-based) of 28 February and of 29 February.
FIRST_HOUR_FEB28 = 1393
FIRST_HOUR_FEB29 = 1417
HOURS_PER_DAY = 24
COMMON_YEAR_HOURS = 8760

LEAP_POLICIES = ("skip_feb28", "skip_feb29", "first_8760", "full")


@dataclass(frozen=True)
class HorizonMap:
    """Where a model year sits in the chain of horizons.

    The year starts at period ``first_time`` of horizon ``first_horizon`` and ends at
    period ``last_time`` of horizon ``last_horizon``.

    ``leap`` says how a leap year fits the model's 8,760 hours: leave out 28 February,
    leave out 29 February, stop after 8,760 hours, or model all 8,784 hours.
    """

    horizon_length: int = 70
    first_horizon: int = 11
    first_time: int = 45
    last_horizon: int = 136
    last_time: int = 54
    leap: str = "skip_feb28"

    def __post_init__(self) -> None:
        if self.leap not in LEAP_POLICIES:
            raise ValueError(f"leap must be one of {LEAP_POLICIES}, not {self.leap!r}")
        if not 1 <= self.first_time <= self.horizon_length:
            raise ValueError("first_time must lie within a horizon")
        if not 1 <= self.last_time <= self.horizon_length:
            raise ValueError("last_time must lie within a horizon")

    @property
    def hours(self) -> int:
        """Number of hours between the first and the last period, both included."""
        full = self.last_horizon - self.first_horizon
        return full * self.horizon_length + self.last_time - self.first_time + 1

    @property
    def warm_up_hours(self) -> int:
        """Hours before the model year in the chain of horizons."""
        return (self.first_horizon - 1) * self.horizon_length + self.first_time - 1

    def check_year(self, year: int) -> None:
        """Raise if the chain of horizons is not as long as the modelled year."""
        full_leap = self.leap == "full" and _calendar.isleap(year)
        wanted = COMMON_YEAR_HOURS + (HOURS_PER_DAY if full_leap else 0)
        if self.hours != wanted:
            raise ValueError(
                f"horizons cover {self.hours} hours but {year} has {wanted} model hours"
            )

    def check_padding(self, pad_hours: int) -> bool:
        """True if hour 1 of the year is the hour that follows ``pad_hours`` of padding."""
        return self.warm_up_hours == pad_hours


def _as_column(value: Column | int) -> Column:
    return F.lit(value) if isinstance(value, int) else value


def _skipped_from(leap: str) -> int | None:
    return {"skip_feb28": FIRST_HOUR_FEB28, "skip_feb29": FIRST_HOUR_FEB29}.get(leap)


def timestamp_of_hour(hour: Column, year: Column | int, leap: str = "skip_feb28") -> Column:
    """Timestamp of the 1-based model hour of a year."""
    year = _as_column(year)
    offset = hour - 1
    skipped = _skipped_from(leap)
    if skipped is not None:
        late = (days_in_year(year) == 366) & (hour >= skipped)
        offset = offset + F.when(late, HOURS_PER_DAY).otherwise(0)
    return add_hours(year_start(year), offset)


def hour_of_timestamp(ts: Column, leap: str = "skip_feb28") -> Column:
    """1-based model hour of a timestamp; null for hours the model leaves out."""
    hour = hour_of_year(ts)
    is_leap = days_in_year(F.year(ts)) == 366
    skipped = _skipped_from(leap)
    if skipped is not None:
        after = skipped + HOURS_PER_DAY
        return F.when(~is_leap | (hour < skipped), hour).when(
            hour >= after, hour - HOURS_PER_DAY
        )
    if leap == "first_8760":
        return F.when(hour <= COMMON_YEAR_HOURS, hour)
    return hour


def horizon_columns(hour: Column, horizons: HorizonMap) -> dict[str, Column]:
    """``horizon`` label and ``period`` of a 1-based model hour."""
    position = hour + (horizons.first_time - 2)
    length = horizons.horizon_length
    block = F.floor(position / length).cast("int") + horizons.first_horizon
    return {
        "horizon": F.concat(F.lit("r"), block.cast("string")),
        "period": (F.pmod(position, F.lit(length)) + 1).cast("int"),
    }


def hour_of_horizon(horizon: Column, period: Column, horizons: HorizonMap) -> Column:
    """1-based model hour of (``r<k>``, period); null if the label is not a horizon."""
    block = F.regexp_extract(horizon, r"^r(\d+)$", 1).try_cast("int")
    inside = period.between(1, horizons.horizon_length)
    hour = (
        (block - horizons.first_horizon) * horizons.horizon_length
        + period
        - (horizons.first_time - 1)
    )
    return F.when(inside, hour).cast("int")


def stamp_horizons(
    df: DataFrame,
    year: int | Column,
    horizons: HorizonMap = HorizonMap(),
    horizon: str = "horizon",
    period: str = "period",
) -> DataFrame:
    """Replace (horizon, period) by ``date_time``; warm-up and header rows drop out."""
    if isinstance(year, int):
        horizons.check_year(year)
    hour = hour_of_horizon(F.col(horizon), F.col(period).try_cast("int"), horizons)
    return (
        df.withColumn("_hour", hour)
        .where(F.col("_hour").between(1, horizons.hours))
        .withColumn("date_time", timestamp_of_hour(F.col("_hour"), year, horizons.leap))
        .drop("_hour", horizon, period)
    )


def label_horizons(
    df: DataFrame, horizons: HorizonMap = HorizonMap(), ts: str = "date_time"
) -> DataFrame:
    """Add ``horizon`` and ``period`` to stamped rows; hours outside the model are null."""
    hour = hour_of_timestamp(F.col(ts), horizons.leap)
    inside = F.col("_hour").between(1, horizons.hours)
    labels = horizon_columns(F.col("_hour"), horizons)
    return (
        df.withColumn("_hour", hour)
        .withColumns({name: F.when(inside, col) for name, col in labels.items()})
        .drop("_hour")
    )


def expand_hours(years: DataFrame, year: str = "year") -> DataFrame:
    """Hour spine: every hour ``date_time`` of each row's year."""
    steps = F.sequence(F.lit(0), hours_in_year(F.col(year)) - 1)
    return years.withColumn("_step", F.explode(steps)).select(
        *years.columns,
        add_hours(year_start(F.col(year)), F.col("_step")).alias("date_time"),
    )


def expand_time_map(
    years: DataFrame, horizons: HorizonMap = HorizonMap(), year: str = "year"
) -> DataFrame:
    """Time map of each row's year: ``horizon, period, year, date_time``."""
    last = F.lit(horizons.hours)
    hours = years.withColumn("_hour", F.explode(F.sequence(F.lit(1), last)))
    labels = horizon_columns(F.col("_hour"), horizons)
    stamp = timestamp_of_hour(F.col("_hour"), F.col(year), horizons.leap)
    others = [F.col(c) for c in years.columns if c != year]
    return hours.select(
        *others,
        labels["horizon"].alias("horizon"),
        labels["period"].alias("period"),
        F.col(year),
        stamp.alias("date_time"),
    )


def time_map(
    spark: SparkSession,
    years: Iterable[int],
    horizons: HorizonMap = HorizonMap(leap="first_8760"),
) -> DataFrame:
    """Time map over many years, one row per modelled hour."""
    years = list(years)
    for year in years:
        horizons.check_year(year)
    values = ", ".join(f"({int(y)})" for y in years)
    frame = spark.sql(f"SELECT year FROM VALUES {values} AS years(year)")
    return expand_time_map(frame, horizons)

