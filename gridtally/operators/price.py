"""Mean and load-weighted prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions import strict_avg, weighted_mean, weighted_ratio
from gridtally.operators.grains import aggregate_by
from gridtally.operators.network import REGIONS
from gridtally.operators.reshape import stack, to_wide


def price_wide(
    prices: DataFrame, regions: Sequence[str] = tuple(REGIONS), keys: Sequence[str] = ()
) -> DataFrame:
    """Hourly prices with one column per region."""
    return to_wide(prices, [*keys, "date_time"], "REGION", "spot_price", regions)


def over_hours(wide: DataFrame, hours: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Hourly rows with one for every ``date_time`` of ``hours``, null where there was none.

    The strict means see rows only: an hour that the feed lacks for all regions has none.
    """
    spine = hours.select("date_time").distinct()
    if keys:
        spine = wide.select(*keys).distinct().crossJoin(spine)
    return wide.join(spine, [*keys, "date_time"], "full")


def mean_price(
    wide: DataFrame,
    grain: str,
    regions: Sequence[str] = tuple(REGIONS),
    keys: Sequence[str] = (),
    by_year: bool = False,
    skip_nulls: bool = False,
) -> DataFrame:
    """Mean price per region; null if an hour lacks a price, unless ``skip_nulls``.

    Hours without a row are not seen; :func:`over_hours` adds them.
    """
    mean = F.avg if skip_nulls else strict_avg
    return aggregate_by(wide, grain, keys, [mean(r).alias(r) for r in regions], by_year)


def price_and_weight_wide(
    prices: DataFrame,
    weights: DataFrame,
    regions: Sequence[str] = tuple(REGIONS),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Hourly ``<region>`` price and ``<region>_W`` weight side by side.

    Hours that only one table has are kept. Prices and weights are matched by region name.
    """
    ids = [*keys, "date_time"]
    weight_name = F.concat("REGION", F.lit("_W")).alias("column")
    rows = stack(
        [
            prices.select(
                *ids, F.col("REGION").alias("column"), F.col("spot_price").alias("value")
            ),
            weights.select(*ids, weight_name, F.col("weight").alias("value")),
        ]
    )
    columns = [name for r in regions for name in (r, f"{r}_W")]
    return to_wide(rows, ids, "column", "value", columns)


def load_weighted_price(
    wide: DataFrame,
    grain: str,
    regions: Sequence[str] = tuple(REGIONS),
    keys: Sequence[str] = (),
    by_year: bool = False,
    skip_nulls: bool = False,
) -> DataFrame:
    """Load-weighted price per region, from :func:`price_and_weight_wide`.

    For days and months an hour without a price or weight makes the result null; for the
    whole period an hour of weight 0 may lack a price. ``skip_nulls`` leaves such hours out.
    """
    mean = weighted_mean if grain == "period" else weighted_ratio
    columns = [
        mean(F.col(r), F.col(f"{r}_W"), skip_nulls).alias(r) for r in regions
    ]
    return aggregate_by(wide, grain, keys, columns, by_year)
