"""Hourly tables from 5-minute feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import (
    after_last,
    before_first,
    drop_suffix,
    hour_start,
    named_or_unknown,
    strict_avg,
    zero_if_null,
)
from gridtally.operators.reshape import one_row_each, to_long, to_wide

# Columns of the interconnector flow feed, in feed order.
FLOW_FEED_LINKS = ["NSW_QLD", "NSW_QLD1", "TAS_VIC", "VIC_SA", "VIC_SA1", "VIC_NSW"]


def _hour(ts: str, end_of_interval_minutes: int) -> Column:
    return hour_start(F.col(ts), end_of_interval_minutes).alias("date_time")


def hourly_mean(
    feed: DataFrame,
    keys: Sequence[str],
    value: str,
    ts: str = "date_time",
    alias: str | None = None,
    fill_zero: bool = False,
    end_of_interval_minutes: int = 0,
) -> DataFrame:
    """Hourly mean of a long feed, per ``keys``.

    ``fill_zero`` counts a missing reading as 0; otherwise it makes the hour null.
    """
    mean = F.avg(zero_if_null(value)) if fill_zero else strict_avg(value)
    return feed.groupBy(_hour(ts, end_of_interval_minutes), *keys).agg(
        mean.alias(alias or value)
    )


def hourly_mean_wide(
    feed: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    ts: str = "date_time",
    fill_zero: bool = False,
    end_of_interval_minutes: int = 0,
) -> DataFrame:
    """Hourly mean of every column of a wide feed.

    Unpivot the result, not the feed: that is a twelfth of the rows. ``fill_zero`` counts a
    missing reading as 0 in hours that have another one.
    """
    means = []
    for name in columns:
        cell = F.col(f"`{name}`")
        filled = F.when(F.count(cell) > 0, F.avg(zero_if_null(cell)))
        mean = filled if fill_zero else strict_avg(cell)
        means.append(mean.alias(name))
    return feed.groupBy(_hour(ts, end_of_interval_minutes), *keys).agg(*means)


def hourly_demand(
    feed: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "date_time",
    value: str = "Demand",
    end_of_interval_minutes: int = 0,
) -> DataFrame:
    return hourly_mean(
        feed, keys, value, ts, alias="hourly_demand", end_of_interval_minutes=end_of_interval_minutes
    )


def technology_totals(
    station_hours: DataFrame, stations: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Hourly output by technology: ``date_time, keys…, Tech, output``.

    ``stations`` has one row per ``station`` with its ``Tech``, several are an error; output of
    stations it does not list is kept under ``UNKNOWN``. No broadcast is forced: Spark checks
    its size.
    """
    known = one_row_each(stations.select("station", "Tech").distinct(), "station")
    joined = station_hours.join(known, "station", "left")
    return (
        joined.groupBy("date_time", *keys, named_or_unknown("Tech").alias("Tech"))
        .agg(F.round(F.sum("output"), 3).alias("output"))
    )


def hourly_technology(
    feed: DataFrame,
    stations: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "date_time",
    value: str = "output",
) -> DataFrame:
    """Hourly output by technology from a long 5-minute feed of stations."""
    hours = hourly_mean(feed, [*keys, "station"], value, ts, alias="output", fill_zero=True)
    return technology_totals(hours, stations, keys)


def technology_wide(
    totals: DataFrame,
    technologies: Sequence[str],
    keys: Sequence[str] = (),
    other: str | None = None,
) -> DataFrame:
    """One column per technology; a technology without output in an hour is 0.

    Other technologies add to the column ``other``; without it they are an error.
    """
    columns = [*technologies, *([other] if other else [])]
    wide = to_wide(totals, ["date_time", *keys], "Tech", "output", technologies, other=other)
    return wide.fillna(0.0, subset=columns)


def hourly_price(
    feed: DataFrame, keys: Sequence[str] = (), ts: str = "date_time", value: str = "spot_price"
) -> DataFrame:
    """Hourly mean price of a long feed, per region."""
    return hourly_mean(feed, [*keys, "REGION"], value, ts, alias="spot_price")


def hourly_price_wide(
    feed: DataFrame,
    regions: Sequence[str],
    keys: Sequence[str] = (),
    ts: str = "date_time",
    end_of_interval_minutes: int = 0,
) -> DataFrame:
    """Hourly mean price of a wide feed, one column per region, as long rows."""
    hours = hourly_mean_wide(feed, regions, keys, ts, end_of_interval_minutes=end_of_interval_minutes)
    return to_long(hours, ["date_time", *keys], "REGION", "spot_price")


def split_link(flows: DataFrame, link: str = "link") -> DataFrame:
    """Link label of the feed to ``from_to``, ``from`` and ``to``.

    Parallel links (``NSW_QLD``, ``NSW_QLD1``) take the same name and stay separate rows.
    """
    pair = drop_suffix(F.col(link), "1")
    others = [F.col(c) for c in flows.columns if c != link]
    return flows.select(
        *others,
        pair.alias("from_to"),
        before_first(pair, "_").alias("from"),
        after_last(pair, "_").alias("to"),
    )


def hourly_flow(
    feed: DataFrame, keys: Sequence[str] = (), ts: str = "date_time", value: str = "flow"
) -> DataFrame:
    """Hourly mean flow of a long feed, per link."""
    return split_link(hourly_mean(feed, [*keys, "link"], value, ts, alias="flow"))


def hourly_flow_wide(
    feed: DataFrame,
    links: Sequence[str] = tuple(FLOW_FEED_LINKS),
    keys: Sequence[str] = (),
    ts: str = "date_time",
    end_of_interval_minutes: int = 0,
) -> DataFrame:
    """Hourly mean flow of a wide feed, one column per link."""
    hours = hourly_mean_wide(feed, links, keys, ts, end_of_interval_minutes=end_of_interval_minutes)
    return split_link(to_long(hours, ["date_time", *keys], "link", "flow"))
