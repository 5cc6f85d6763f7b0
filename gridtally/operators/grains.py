"""Daily, monthly and whole-period grouping.

The group key is a date or a month number; the text label is made after aggregation, once
per group instead of once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "month", "period")


def aggregate_by(
    df: DataFrame,
    grain: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    by_year: bool = False,
    ts: str = "date_time",
) -> DataFrame:
    """Aggregate to ``day`` (``MM/dd/yy``), ``month`` (``MM``) or the whole ``period``.

    Months of different years share a row, as do all years of a period; ``by_year`` adds
    a ``year`` column that keeps them apart.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    groups: list[Column] = [F.col(k) for k in keys]
    if by_year and grain != "day":
        groups.append(F.year(ts).alias("year"))
    if grain == "day":
        groups.append(F.to_date(ts).alias("day"))
    elif grain == "month":
        groups.append(F.month(ts).alias("month"))
    out = df.groupBy(*groups).agg(*aggregates)
    if grain == "day":
        return out.withColumn("day", F.date_format("day", "MM/dd/yy"))
    if grain == "month":
        return out.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    return out
