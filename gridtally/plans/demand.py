"""Demand inputs of the dispatch model from market feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions import hour_of_year, hour_start, hours_in_year, zero_if_null
from gridtally.operators.energy import EXOGENOUS, residual_demand
from gridtally.operators.hourly import technology_totals, technology_wide
from gridtally.operators.reshape import one_row_each, to_long, to_wide
from gridtally.operators.windows import (
    CUTOFF,
    HORIZON,
    PAD_HOURS,
    TEMPLATE_HOURS,
    pad_year,
    rolling_horizons,
)
from gridtally.sources.model_files import RESERVES

# table of rolling horizons -> column of the padded year
HORIZON_TABLES = {"DEMAND": "Residual_demand", **{c: c for c in RESERVES}}


def hourly_technology_wide_feed(
    feed: DataFrame,
    stations: DataFrame,
    keys: Sequence[str] = ("REGION",),
    end_of_interval_minutes: int = 0,
) -> DataFrame:
    """Hourly output by technology from a wide feed, one column per station.

    The feed is made long first: one mean per row combines before the shuffle, where a mean per
    station would be hundreds of columns. A missing reading is 0; a station without any reading
    in an hour, such as one of another region, adds no row.
    """
    ids = ["date_time", *keys]
    readings = to_long(feed, ids, "station", "output")
    hour = hour_start(F.col("date_time"), end_of_interval_minutes)
    hours = readings.groupBy(hour.alias("date_time"), *keys, "station")
    means = hours.agg(F.count("output").alias("_n"), F.avg(zero_if_null("output")).alias("output"))
    long = means.where(F.col("_n") > 0).drop("_n")
    return technology_totals(long, stations, keys)


def zonal_inputs(
    demand: DataFrame,
    technologies: DataFrame,
    reserves: DataFrame | None = None,
    pad: int = PAD_HOURS,
    template: int = TEMPLATE_HOURS,
    hydro: bool = True,
) -> DataFrame:
    """Padded year per region: ``REGION, year, t``, demand, exogenous and residual demand.

    ``demand`` is the hourly demand, ``technologies`` the hourly output by technology (long).
    All regions and years are one table. Two ``reserves`` for one region and hour are an error.
    """
    # what is dispatched is not subtracted from demand
    wide = technology_wide(technologies, EXOGENOUS, ["REGION"], other="Dispatched")
    hours = residual_demand(demand, wide, ["REGION"], hydro)
    year = F.year("date_time")
    indexed = hours.select(
        "REGION",
        year.alias("year"),
        hour_of_year(F.col("date_time")).alias("t"),
        "Demand",
        *EXOGENOUS,
        F.col("Residual").alias("Residual_demand"),
    )
    entry = pad_year(indexed, hours_in_year(F.col("year")), pad, template)
    if reserves is None:
        return entry.withColumns({c: F.lit(None).cast("double") for c in RESERVES})
    hourly = one_row_each(reserves.select("REGION", "t", *RESERVES), ["REGION", "t"])
    return entry.join(hourly, ["REGION", "t"], "left")


def demand_tables(
    demand: DataFrame,
    technologies: DataFrame,
    reserves: DataFrame | None = None,
    hydro: bool = True,
    horizon: int = HORIZON,
    cutoff: int = CUTOFF,
    horizons: int | None = None,
    pad: int = PAD_HOURS,
    template: int = TEMPLATE_HOURS,
) -> dict[str, DataFrame]:
    """The zonal input tables: the padded year and one rolling-horizon table per series.

    ``demand`` and ``technologies`` are hourly tables per region.

    Horizon tables are long: ``REGION, year, horizon, period, value``.
    """
    entry = zonal_inputs(demand, technologies, reserves, pad, template, hydro)
    placed = rolling_horizons(entry, horizon, cutoff, horizons)
    tables = {"DataEntry_1": entry}
    for name, column in HORIZON_TABLES.items():
        tables[name] = placed.select(
            "REGION", "year", "horizon", "period", F.col(column).alias("value")
        )
    return tables


def horizon_matrix(table: DataFrame, horizons: int) -> DataFrame:
    """A horizon table with one row per period and one column per horizon."""
    labelled = table.withColumn("horizon", F.col("horizon").cast("string"))
    columns = [str(k) for k in range(1, horizons + 1)]
    return to_wide(labelled, ["REGION", "year", "period"], "horizon", "value", columns)
