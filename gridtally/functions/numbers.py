"""Rounding, deadband, unit scaling and weighted means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEADBAND = 0.0001
MWH_PER_GWH = 1000


def deadband(value: Column, width: float = DEADBAND) -> Column:
    """Values closer to zero than ``width`` become 0."""
    return F.when(F.abs(value) < width, F.lit(0.0)).otherwise(value)


def gigawatt_hours(value: Column, digits: int = 3) -> Column:
    return F.round(value / MWH_PER_GWH, digits)


def _strict(complete: Column, value: Column, weight: Column, skip_nulls: bool) -> Column:
    both = value.isNotNull() & weight.isNotNull()
    if skip_nulls:
        return F.try_divide(
            F.sum(F.when(both, value * weight)), F.sum(F.when(both, weight))
        )
    return F.when(
        F.count(F.when(complete, F.lit(1))) == F.count(F.lit(1)),
        F.try_divide(F.sum(value * weight), F.sum(weight)),
    )


def weighted_mean(value: Column, weight: Column, skip_nulls: bool = False) -> Column:
    """Weighted mean in which a row of weight 0 may lack a value.

    Null if a weight is null, if a value with non-zero weight is null, or if the weights
    sum to zero. ``skip_nulls`` leaves incomplete rows out instead.
    """
    complete = weight.isNotNull() & (value.isNotNull() | (weight == 0))
    return _strict(complete, value, weight, skip_nulls)


def weighted_ratio(value: Column, weight: Column, skip_nulls: bool = False) -> Column:
    """Dot product over the sum of weights: null if any value or weight is null."""
    return _strict(value.isNotNull() & weight.isNotNull(), value, weight, skip_nulls)
