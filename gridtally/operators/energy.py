"""Generation by fuel, residual demand and dispatch weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import (
    UNKNOWN,
    deadband,
    gigawatt_hours,
    named_or_unknown,
    strict_sum,
    zero_if_null,
)
from gridtally.operators.grains import aggregate_by
from gridtally.operators.reshape import stack, to_wide, with_zero_columns

IMPORTS = "Imports"
DEMAND = "Demand"
EXOGENOUS = ["Wind", "Solar", "Hydro"]


def output_by_fuel(output: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Unit output summed per hour, region and fuel; null if a unit's output is null."""
    return output.groupBy(*keys, "date_time", "REGION", "FUEL_TYPE_TEXT").agg(
        strict_sum("output").alias("output")
    )


def generation_table(
    output: DataFrame,
    fuels: Sequence[str],
    exogenous: DataFrame | None = None,
    balance: DataFrame | None = None,
    keys: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Hourly table per region: one column per fuel, and net ``Imports``.

    ``output`` holds unit or fuel rows; dispatch, exogenous series and imports are stacked
    instead of joined, summed per fuel, and made wide last, so that the many unit rows meet
    one sum each and not one per column. Fuels that are null or not listed are counted under
    ``UNKNOWN``. Missing values are 0, values within the deadband are 0, all are rounded to
    3 decimals. A fuel that is both dispatched and exogenous in an hour is summed, or an
    error with ``strict``.
    """
    ids = [*keys, "date_time", "REGION"]

    def rows(frame: DataFrame, source: str, fuel: Column, value: str) -> DataFrame:
        return frame.select(
            *keys,
            "date_time",
            named_or_unknown("REGION").alias("REGION"),
            fuel.alias("FUEL_TYPE_TEXT"),
            F.col(value).cast("double").alias("output"),
            F.lit(source).alias("source"),
        )

    fuel = F.col("FUEL_TYPE_TEXT")
    listed = F.when(fuel.isin(list(fuels)), fuel).otherwise(F.lit(UNKNOWN))
    parts = [rows(output, "dispatch", listed, "output")]
    if exogenous is not None:
        parts.append(rows(exogenous, "exogenous", listed, "output"))
    columns = [*[f for f in fuels if f != UNKNOWN], UNKNOWN]
    if balance is not None:
        parts.append(rows(balance, "imports", F.lit(IMPORTS), "Net"))
        columns.append(IMPORTS)
    total = strict_sum("output")
    if strict:
        problem = F.concat("FUEL_TYPE_TEXT", F.lit(" is both dispatched and exogenous"))
        several = F.min("source") != F.max("source")
        total = F.when(several, F.raise_error(problem).cast("double")).otherwise(total)
    fuel_rows = stack(parts).groupBy(*ids, "FUEL_TYPE_TEXT").agg(total.alias("output"))
    wide = to_wide(fuel_rows, ids, "FUEL_TYPE_TEXT", "output", columns)
    return wide.withColumns(
        {c: F.round(deadband(zero_if_null(c)), 3) for c in columns}
    )


def _value_columns(table: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in table.columns if c not in (*keys, "date_time", "REGION")]


def generation_totals(
    table: DataFrame, grain: str, keys: Sequence[str] = (), by_year: bool = False
) -> DataFrame:
    """Generation per region in GWh, from the hourly values already rounded."""
    totals = [
        gigawatt_hours(F.sum(F.col(c))).alias(c) for c in _value_columns(table, keys)
    ]
    return aggregate_by(table, grain, [*keys, "REGION"], totals, by_year)


def dispatch_weights(
    table: DataFrame, keys: Sequence[str] = (), exclude: Sequence[str] = (DEMAND,)
) -> DataFrame:
    """Hourly ``weight`` per region: total generation and net imports, without demand."""
    parts = [F.col(c) for c in _value_columns(table, keys) if c not in exclude]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return table.select(*keys, "date_time", "REGION", total.alias("weight"))


def weights_wide(
    weights: DataFrame, regions: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Weights with one column ``<region>_W`` per region."""
    return to_wide(weights, [*keys, "date_time"], "REGION", "weight", regions, "_W")


def residual_demand(
    demand: DataFrame,
    technologies: DataFrame,
    keys: Sequence[str] = (),
    hydro: bool = True,
) -> DataFrame:
    """Demand less wind, solar and hydro generation, per hour.

    ``demand`` has ``hourly_demand``; ``technologies`` is the wide hourly table, in which an
    absent technology counts as 0. ``hydro=False`` leaves hydro to the model. Hours without
    demand are kept, with a null residual. Both inputs come out of an aggregation on the
    same keys, so the join adds no shuffle.
    """
    ids = ["date_time", *keys]
    complete = with_zero_columns(technologies, EXOGENOUS).select(*ids, *EXOGENOUS)
    joined = demand.select(*ids, F.col("hourly_demand").alias("Demand")).join(
        complete, ids, "full"
    )
    filled = joined.withColumns({c: zero_if_null(c) for c in EXOGENOUS})
    net = F.col("Demand") - F.col("Wind") - F.col("Solar")
    if hydro:
        net = net - F.col("Hydro")
    return filled.withColumn("Residual", net)
