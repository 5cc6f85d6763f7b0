"""Padded years and overlapping rolling horizons.

Both copy a row to the few positions it takes in the result. Positions follow from the
row's own index ``t``, so neither needs a window, a sort or a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the solver's input template.
PAD_HOURS = 720
TEMPLATE_HOURS = 9504
HORIZON = 100
CUTOFF = 30


def pad_year(
    df: DataFrame,
    length: Column | int,
    pad: int = PAD_HOURS,
    template: Column | int = TEMPLATE_HOURS,
    t: str = "t",
) -> DataFrame:
    """Wrap a series of ``length`` rows to the template's length.

    The first ``pad`` rows come first, then the whole series, then its last rows again
    until the template is full. ``t`` is the 1-based row index, in and out. ``length`` and
    ``template`` may be columns, for series of different lengths in one table.
    """
    length = F.lit(length) if isinstance(length, int) else length
    template = F.lit(template) if isinstance(template, int) else template
    here = F.col(t).cast("int")
    tail = F.greatest(template - length - pad, F.lit(0))
    positions = F.array(
        F.when(here <= pad, here),
        here + pad,
        F.when(here > length - tail, here + pad + tail),
    )
    places = F.array_compact(positions)
    others = [c for c in df.columns if c != t]
    return df.select(F.explode(places).alias(t), *others)


def rolling_horizons(
    df: DataFrame,
    horizon: int = HORIZON,
    cutoff: int = CUTOFF,
    horizons: int | None = None,
    t: str = "t",
) -> DataFrame:
    """Place each row in every horizon that covers it: adds ``horizon`` and ``period``.

    Horizon ``k`` covers ``horizon`` rows from ``(k - 1) * (horizon - cutoff) + 1``; each
    shares ``cutoff`` rows with the next. ``horizons`` is the number of horizons in the
    template; without it the last horizons are as short as the series leaves them.
    """
    if not 0 <= cutoff < horizon:
        raise ValueError("cutoff must be at least 0 and smaller than horizon")
    stride = horizon - cutoff
    here = F.col(t).cast("int")
    first = F.greatest(
        F.lit(1), F.ceil((here - horizon) / stride).cast("int") + F.lit(1)
    )
    last = F.floor((here - 1) / stride).cast("int") + F.lit(1)
    if horizons is not None:
        last = F.least(last, F.lit(horizons))
    covering = F.when(first <= last, F.sequence(first, last))
    others = [c for c in df.columns if c != t]
    return (
        df.withColumn("horizon", F.explode(covering))
        .withColumn("period", (here - (F.col("horizon") - 1) * stride).cast("int"))
        .select("horizon", "period", t, *others)
    )
