"""Null rules, decided once.

Spark skips nulls in ``sum`` and ``avg``. Backtest tables must not: one missing hour
makes the day unknown, so the strict forms return null if any input is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _complete(value: Column, where: Column | None) -> Column:
    """True when every row of the group (that satisfies ``where``) has a value."""
    if where is None:
        return F.count(value) == F.count(F.lit(1))
    return F.count(F.when(where, value)) == F.count(F.when(where, F.lit(1)))


def strict_sum(value: Column | str, where: Column | None = None) -> Column:
    """Sum that is null if any value is null; ``where`` restricts the rows summed."""
    value = _col(value)
    summed = F.sum(value if where is None else F.when(where, value))
    return F.when(_complete(value, where), summed)


def strict_avg(value: Column | str) -> Column:
    """Mean that is null if any value is null."""
    value = _col(value)
    return F.when(_complete(value, None), F.avg(value))


def lenient_sum(value: Column | str) -> Column:
    """Sum that ignores nulls and is 0 when all values are null."""
    return F.coalesce(F.sum(_col(value)), F.lit(0.0))


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(0.0))


def named_or_unknown(label: Column | str) -> Column:
    """Null labels get their own bucket, so that they join and group like any other."""
    return F.coalesce(_col(label), F.lit(UNKNOWN))
