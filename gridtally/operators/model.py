"""Dispatch-model tables: dispatch, prices, exogenous series and storage, made long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.operators.calendar import (
    HorizonMap,
    hour_of_timestamp,
    stamp_horizons,
    timestamp_of_hour,
)
from gridtally.operators.reshape import one_row_each, to_long
from gridtally.operators.windows import PAD_HOURS

# Fixed values.
UNIT_COLUMNS = [
    "STATION", "DUID", "REGION", "REGION_KEY", "CAPACITY", "FUEL_TYPE_TEXT",
    "INITIAL_ENERGY_STOCK_IN_DAMS", "HYDRO_DAM_CAPACITY", "VARCOST",
]
EXOGENOUS_SERIES = ["Demand", "Wind", "Solar", "Hydro"]
STORAGE_THRESHOLD = 0.0001


def unit_metadata(units: DataFrame) -> DataFrame:
    """The columns of the plant table that results use; ``DUID`` becomes ``unit``."""
    return units.select(*UNIT_COLUMNS).withColumnRenamed("DUID", "unit")


def region_key(units: DataFrame) -> DataFrame:
    """Distinct ``REGION, REGION_KEY`` pairs."""
    return units.select("REGION", "REGION_KEY").distinct()


def stamped_long(
    wide: DataFrame,
    year: int,
    name: str,
    value: str,
    horizons: HorizonMap = HorizonMap(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Model table keyed by (horizon, period), one column per unit, to long rows."""
    ids = ["date_time", *keys]
    return to_long(stamp_horizons(wide, year, horizons), ids, name, value)


def model_dispatch(
    wide: DataFrame,
    units: DataFrame,
    year: int,
    horizons: HorizonMap = HorizonMap(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Unit output per hour with the unit's metadata; unknown units are kept.

    A unit that ``units`` lists twice is an error.
    """
    long = stamped_long(wide, year, "unit", "output", horizons, keys)
    return long.join(one_row_each(units, "unit"), "unit", "left")


def model_price(
    wide: DataFrame,
    regions: DataFrame,
    year: int,
    horizons: HorizonMap = HorizonMap(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Marginal price per hour and region; columns that are no region key drop out.

    A region key with two names is an error.
    """
    long = stamped_long(wide, year, "region", "spot_price", horizons, keys)
    keyed = long.withColumn("region", F.col("region").try_cast("int"))
    # the region key decides which rows stay, so its nulls must not match
    names = regions.where(F.col("REGION").isNotNull()).select(
        F.col("REGION_KEY").cast("int").alias("region"), F.col("REGION").alias("_name")
    )
    return keyed.join(one_row_each(names.distinct(), "region"), "region").select(
        "date_time", *keys, F.col("_name").alias("REGION"), "spot_price"
    )


def model_flow(
    wide: DataFrame,
    link_columns: DataFrame,
    year: int,
    horizons: HorizonMap = HorizonMap(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Flows per hour and link, from a body whose columns are known by position.

    ``wide`` has ``horizon, period`` and one column per link named by its position;
    ``link_columns`` (``position, from_node, to_node``) has a row per column of the body,
    so its size is that of one row. Missing flows are 0.
    """
    long = stamped_long(wide, year, "position", "flow", horizons, keys)
    joined = long.join(link_columns, "position")
    return joined.withColumn("flow", F.coalesce("flow", F.lit(0.0))).drop("position")


def stamped_flow(
    long: DataFrame, year: int, horizons: HorizonMap = HorizonMap()
) -> DataFrame:
    """Flows per hour from long rows with ``horizon, period, flow`` and other columns, such as the run
    and the ends of the link. Missing flows are 0."""
    return stamp_horizons(long, year, horizons).withColumn("flow", F.coalesce("flow", F.lit(0.0)))


def exogenous_series(
    zonal: DataFrame,
    regions: DataFrame,
    year: int,
    horizons: HorizonMap = HorizonMap(),
    pad_hours: int = PAD_HOURS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Zonal inputs of the model year as rows ``date_time, REGION, FUEL_TYPE_TEXT, output``.

    ``Time`` numbers the hours of the padded year, in a leap year all 8,784; the padding on
    either side is left out, and so are the hours that the model leaves out. A region key with
    two names is an error.
    """
    horizons.check_year(year)
    hour = F.col("Time") - pad_hours
    stamped = zonal.withColumn("date_time", timestamp_of_hour(hour, year, "all"))
    own = (hour >= 1) & (F.year("date_time") == year)
    modelled = hour_of_timestamp(F.col("date_time"), horizons.leap).isNotNull()
    names = one_row_each(regions.select("REGION", "REGION_KEY").distinct(), "REGION_KEY")
    named = stamped.where(own & modelled).join(names, "REGION_KEY", "left")
    ids = ["date_time", *keys, "REGION"]
    return to_long(
        named.select(*ids, *EXOGENOUS_SERIES), ids, "FUEL_TYPE_TEXT", "output"
    )


def storage_net_output(
    charge: DataFrame,
    discharge: DataFrame,
    units: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Charge, discharge and net output of storage units in the hours they are active.

    Both inputs are long: ``date_time, unit`` and ``charge`` or ``discharge``. A unit that
    ``units`` lists twice is an error.
    """
    ids = ["date_time", "unit", *keys]
    both = charge.join(discharge, ids, "left")
    active = (F.col("charge") > STORAGE_THRESHOLD) | (F.col("discharge") > STORAGE_THRESHOLD)
    rounded = both.where(active).withColumns(
        {"charge": F.round("charge", 3), "discharge": F.round("discharge", 3)}
    )
    net = rounded.withColumn("output", F.col("discharge") - F.col("charge"))
    return net if units is None else net.join(one_row_each(units, "unit"), "unit", "left")
