"""Facts of a backtest from model files and market feeds."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.operators import model, network
from gridtally.operators.calendar import HorizonMap, hour_of_timestamp
from gridtally.operators.network import Network
from gridtally.operators.reshape import stack
from gridtally.operators.windows import PAD_HOURS
from gridtally.plans.results import SIDES, Facts

MODEL, ACTUAL = SIDES


def _side(frame: DataFrame, side: str) -> DataFrame:
    return frame.withColumn("side", F.lit(side))


def model_facts(
    dispatch: DataFrame,
    prices: DataFrame,
    flows: DataFrame,
    link_columns: DataFrame,
    zonal: DataFrame,
    units: DataFrame,
    year: int,
    horizons: HorizonMap = HorizonMap(),
    grid: Network = Network(),
    pad_hours: int = PAD_HOURS,
) -> Facts:
    """Model outputs (wide, keyed by horizon and period) as facts.

    Warns if hour 1 of the year in the outputs is not the hour that follows the padding of
    the zonal inputs, as the two then are shifted against each other.
    """
    if not horizons.check_padding(pad_hours):
        shift = horizons.warm_up_hours - pad_hours
        warnings.warn(f"model outputs start {shift} hours after the padding", stacklevel=2)
    regions = model.region_key(units)
    flow = model.model_flow(flows, link_columns, year, horizons)
    output = model.model_dispatch(dispatch, units, year, horizons)
    exogenous = model.exogenous_series(zonal, regions, year, horizons, pad_hours)
    columns = ["date_time", "REGION", "FUEL_TYPE_TEXT", "output"]
    return Facts(
        prices=_side(model.model_price(prices, regions, year, horizons), MODEL),
        flows=_side(network.name_links(flow, grid, ends=True), MODEL),
        output=_side(output.select(*columns), MODEL),
        exogenous=_side(exogenous.select(*columns), MODEL),
    )


def actual_facts(
    technologies: DataFrame,
    prices: DataFrame,
    flows: DataFrame,
    horizons: HorizonMap | None = None,
) -> Facts:
    """Hourly tables of the market as facts: by technology, by region and by link.

    With ``horizons``, hours that the model leaves out of a leap year are left out here, too.
    """
    if horizons is not None:
        modelled = hour_of_timestamp(F.col("date_time"), horizons.leap).isNotNull()
        technologies, prices, flows = (t.where(modelled) for t in (technologies, prices, flows))
    output = technologies.select(
        "date_time", "REGION", F.col("Tech").alias("FUEL_TYPE_TEXT"), "output"
    )
    links = flows.select("date_time", F.col("from_to").alias("link"), "flow")
    return Facts(
        prices=_side(prices.select("date_time", "REGION", "spot_price"), ACTUAL),
        flows=_side(links, ACTUAL),
        output=_side(output, ACTUAL),
    )


def both_sides(*facts: Facts) -> Facts:
    """Stack the facts of several sides."""
    exogenous = [f.exogenous for f in facts if f.exogenous is not None]
    return Facts(
        prices=stack(f.prices for f in facts),
        flows=stack(f.flows for f in facts),
        output=stack(f.output for f in facts),
        exogenous=stack(exogenous) if exogenous else None,
    )
