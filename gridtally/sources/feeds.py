"""Readers for the 5-minute market feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.hourly import FLOW_FEED_LINKS
from gridtally.sources.files import read_any, typed

Paths = str | Sequence[str]

# Column names of the feeds.
STAMP = "DateTime"
ENERGY_SOURCE = "CO2E_ENERGY_SOURCE"
PRICE_SUFFIX = "1.Price_5min"


def _source(source: bool) -> list[str]:
    return ["source"] if source else []


def _types(labels: Sequence[str]) -> dict[str, str]:
    return {STAMP: "timestamp_ntz", **{label: "string" for label in labels}}


def _stamped(df: DataFrame, ts: str = STAMP) -> DataFrame:
    others = [F.col(f"`{c}`") for c in df.columns if c != ts]
    return df.select(F.col(ts).cast("timestamp_ntz").alias("date_time"), *others)


def read_station_metadata(spark: SparkSession, path: Paths, fmt: str = "csv") -> DataFrame:
    """``station, Tech``. The first column is the station; blank technologies are null."""
    raw = read_any(spark, path, fmt)
    source = [c for c in raw.columns if c.strip(" .#").endswith(ENERGY_SOURCE)]
    if len(source) != 1:
        raise ValueError(f"expected one {ENERGY_SOURCE} column, found {source}")
    tech = F.trim(F.col(f"`{source[0]}`"))
    return raw.select(
        F.col(f"`{raw.columns[0]}`").alias("station"), F.nullif(tech, F.lit("")).alias("Tech")
    )


def read_demand_feed(
    spark: SparkSession, paths: Paths, fmt: str = "csv", region: str = r"Demand_([A-Z]+)", source: bool = False
) -> DataFrame:
    """``date_time, Demand, REGION``; one region per file, named in the file name.

    In all feeds ``source`` adds the path of the file that a row comes from.

    The feed's three columns are time, demand and pre-dispatch, whatever they are called.
    """
    raw = read_any(spark, paths, fmt, ("REGION", region), source)
    labels = ["REGION", *_source(source)]
    named = raw.toDF(STAMP, "Demand", "Predispatch", *labels)
    return _stamped(typed(named.select(STAMP, "Demand", *labels), _types(labels)))


def read_generation_feed(
    spark: SparkSession,
    paths: Paths,
    fmt: str = "csv",
    region: str = r"Generation_([A-Z]+)",
    source: bool = False,
) -> DataFrame:
    """``date_time, REGION`` and one column per station, from quarterly pieces.

    Stations that a piece lacks are null there. Columns ``<station>.<suffix>`` take the
    station's name.
    """
    raw = read_any(spark, paths, fmt, ("REGION", region), source)
    stations = [c.split(".")[0] for c in raw.columns]
    if len(set(stations)) != len(stations):
        raise ValueError("two columns of the generation feed have the same station name")
    return _stamped(typed(raw.toDF(*stations), _types(["REGION", *_source(source)])))


def read_price_feed(spark: SparkSession, paths: Paths, fmt: str = "csv", source: bool = False) -> DataFrame:
    """``date_time`` and one column per region, named without the feed's suffix."""
    raw = read_any(spark, paths, fmt, source=source)
    names = [c.removesuffix(PRICE_SUFFIX) for c in raw.columns]
    return _stamped(typed(raw.toDF(*names), _types(_source(source))))


def read_flow_feed(
    spark: SparkSession,
    paths: Paths,
    fmt: str = "csv",
    links: Sequence[str] = tuple(FLOW_FEED_LINKS),
    source: bool = False,
) -> DataFrame:
    """``date_time`` and one column per link; the feed's columns are known by order."""
    raw = read_any(spark, paths, fmt, source=source).toDF(STAMP, *links, *_source(source))
    return _stamped(typed(raw, _types(_source(source))))
