"""Plant table for one model year from the assumption tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.operators.reshape import yearly_to_long

PLANT_KEYS = ["STATION", "DUID", "REGION", "REGION_KEY"]

# Columns of the plant table, in template order.
PLANT_COLUMNS = [
    "STATION", "DUID", "REGION", "REGION_KEY", "CAPACITY", "CARBON INTENSITY",
    "EFFICIENCY_LOSS", "GEN_TECH_TEXT", "GEN_TECH", "GEN_TYPE", "HYDRO_UNITS_KEY",
    "INITIAL_ENERGY_STOCK_IN_DAMS", "HYDRO_DAM_CAPACITY", "HYDRO_DISCHARGE_CAPACITY",
    "COST_WATER_SPILL", "FUEL_TYPE_TEXT", "FUEL_TYPE", "HEATRATE_GJ", "HEATRATE",
    "MAXP_FACTOR", "MIN_DOWNTIME", "MIN_UPTIME", "MINP_ISP", "MINP_GHD", "MINP_FACTOR",
    "RAMPDOWN_ISP", "RAMPDOWN_GHD", "RAMPDOWNFACTOR", "RAMPUP_ISP", "RAMPUP_GHD",
    "RAMPUPFACTOR", "SHUTRAMPFACTOR", "STARTCOST_ISP", "STARTCOST_GHD", "STARTCOST",
    "STARTRAMPFACTOR", "VARCOST", "INITIAL_STORAGE_STOCK", "MAX_OUTPUT_HOURS",
    "MIN_OUTPUT_HOURS", "MAX_STORAGE", "COMPLETE",
]


def left_join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which a null key matches a null key."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_right_{c}"]) for c in on]
    )
    return left.join(renamed, same, "left").drop(*[f"_right_{c}" for c in on])


def plant_table(
    specs: DataFrame,
    capacity: DataFrame,
    cost: DataFrame,
    year: int,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Plants available in ``year`` with that year's ``CAPACITY`` and ``VARCOST``.

    ``capacity`` has columns ``Cap <year>``, ``cost`` columns ``SRMC…<year>``; only those
    of the year are read. Plants without capacity or cost data are kept.
    """
    sized = yearly_to_long(capacity, PLANT_KEYS, "Cap ", "CAPACITY", year)
    priced = yearly_to_long(cost, PLANT_KEYS, "SRMC", "VARCOST", year)
    available = specs.where(
        (F.col("AvaliableDate") <= year) & (F.col("ExpectedRetirementYear") >= year)
    )
    joined = left_join_null_safe(available, sized, PLANT_KEYS)
    joined = left_join_null_safe(joined, priced, [*PLANT_KEYS, "year"])
    return joined.select(*[F.col(f"`{c}`") for c in columns or PLANT_COLUMNS])
