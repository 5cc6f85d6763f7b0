"""Registered queries that go through files: readers, the layer of hourly tables, writers.

Each derives its files from the driver's tables, in a new folder of the shared one, and reads them back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import queries, views
from checks.exports import export, new_folder
from gridtally.operators import model, network, plants
from gridtally.operators.hourly import FLOW_FEED_LINKS
from gridtally.operators.network import REGIONS
from gridtally.operators.reshape import stack
from gridtally.plans import demand
from gridtally.plans.results import write_results
from gridtally.plans.workflows import MarketYear
from gridtally.sources import feeds, model_files
from gridtally.sources.staging import stage

# a year's feed comes in pieces of ten days
_PIECE = ["year", "piece"]


def _pieces() -> list[Column]:
    decade = F.least(F.floor((F.dayofmonth("date_time") - 1) / 10), F.lit(2)).cast("string")
    return [F.year("date_time").alias("year"), F.concat(F.date_format("date_time", "MM"), decade).alias("piece")]


def _stamp() -> Column:
    return F.col("date_time").cast("string").alias(feeds.STAMP)


def _years(readings: DataFrame) -> list[int]:
    rows = readings.select(F.year("date_time").alias("year")).distinct().orderBy("year").collect()
    return [row.year for row in rows]


def _hourly(
    spark: SparkSession, readings: DataFrame, raw: str, read: Callable[[MarketYear], DataFrame]
) -> DataFrame:
    hourly = new_folder(spark, "hourly")
    return stack(read(MarketYear(spark, raw, hourly, year)) for year in _years(readings))


def feed_files_demand(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly demand from feed files that come in two deliveries, the second built beside the first."""
    readings = queries.feed(spark, sf)
    raw, hourly = new_folder(spark, "raw"), new_folder(spark, "hourly")
    early = F.col("REGION").isin(REGIONS[:3])
    out = []
    for delivery in (readings.where(early), readings.where(~early)):
        rows = delivery.select(_stamp(), F.col("value").alias("SCADA"), F.lit(0).alias("P5MIN"), "REGION", *_pieces())
        export(rows, raw, "Demand_{REGION}1_{year}_{piece}.csv", ["REGION", *_PIECE])
        out = [MarketYear(spark, raw, hourly, year).demand() for year in _years(delivery)]
    return stack(out)


def feed_files_generation(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly output by technology from wide files, whose columns differ by region."""
    readings = queries.feed(spark, sf)
    raw = new_folder(spark, "raw")
    for event, region in views.FEED_REGION.items():
        station = views.STATIONS[event]
        own = readings.where(F.col("REGION") == region)
        rows = own.select(_stamp(), F.col("value").alias(f"{station}.MW"), *_pieces())
        export(rows, raw, f"Generation_{region}1_{{year}}_{{piece}}.csv", _PIECE)
    known = {**dict.fromkeys(views.STATIONS.values(), ""), **views.STATION_TECHNOLOGY}
    stations = queries.inline(spark, f"DUID, {feeds.ENERGY_SOURCE}", known)
    for year in _years(readings):
        export(stations, raw, f"Metadata_{year}_{{n}}.csv")
    return _hourly(spark, readings, raw, MarketYear.technologies)


def _half_hours(readings: DataFrame, label: str, names: dict[str, str]) -> DataFrame:
    """Mean reading per half hour, a column for each label under its name in the feed."""
    half = F.when(F.minute("date_time") < 30, ":00:00").otherwise(":30:00")
    slot = F.concat(F.date_format("date_time", "yyyy-MM-dd HH"), half).alias(feeds.STAMP)
    cells = [F.avg(F.when(F.col(label) == k, F.col("value"))).alias(n) for k, n in names.items()]
    return readings.groupBy(slot, *_pieces()).agg(*cells).select(feeds.STAMP, *(f"`{n}`" for n in names.values()), *_PIECE)


def feed_files_price(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly prices from files wide by region; an hour that lacks a half is null."""
    readings = queries.feed(spark, sf)
    rows = _half_hours(readings, "REGION", {r: f"{r}{feeds.PRICE_SUFFIX}" for r in REGIONS})
    raw = export(rows, new_folder(spark, "raw"), "Price_{year}_{piece}.csv", _PIECE)
    return _hourly(spark, readings, raw, MarketYear.prices)


def feed_files_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly flows from files wide by link, whose columns are known by order."""
    readings = queries.feed(spark, sf)
    rows = _half_hours(readings, "link", {k: f"flow_{i}" for i, k in enumerate(FLOW_FEED_LINKS)})
    raw = export(rows, new_folder(spark, "raw"), "Flow_{year}_{piece}.csv", _PIECE)
    return _hourly(spark, readings, raw, MarketYear.flows)


def reserve_files(spark: SparkSession, sf: str) -> DataFrame:
    """Zonal inputs with hourly reserve requirements that come from files."""
    items = views.table(spark, sf, "lineitem").select(
        "l_suppkey", F.dayofyear("l_shipdate").alias("t"), "l_quantity"
    )
    sums = views.supplied(spark, sf, items).groupBy("REGION", "t").agg(
        F.sum("l_quantity").alias("OPERATING_RESERVE_UP"), F.count(F.lit(1)).alias("OPERATING_RESERVE_DOWN")
    )
    folder = export(sums, new_folder(spark, "reserves"), "Reserves_{n}.csv")
    reserves = model_files.read_reserves(spark, folder)
    inputs = queries.regional_demand_inputs(spark, sf)
    return demand.zonal_inputs(*inputs, reserves, pad=24, template=8832)


def plant_files(spark: SparkSession, sf: str) -> DataFrame:
    """The plant table of a year from assumption files."""
    names = ("specs", "capacity", "cost")
    tables = zip(names, queries.plant_inputs(spark, sf), strict=True)
    folders = [export(t, new_folder(spark, n), f"{n}_{{n}}.csv") for n, t in tables]
    found = plants.plant_table(*model_files.read_assumptions(spark, *folders), queries.PLANT_YEAR)
    whole = [c for c in plants.PLANT_COLUMNS if c not in (*plants.PLANT_KEYS, "CAPACITY", "VARCOST")]
    return found.withColumns({c: F.col(c).cast("long") for c in whole})


def _units(spark: SparkSession, sf: str) -> DataFrame:
    folder = export(queries.units(spark, sf), new_folder(spark, "units"), "INPUT_DATA_GENERATION_{n}.csv")
    return model_files.read_unit_metadata(spark, folder)


def unit_files(spark: SparkSession, sf: str) -> DataFrame:
    return _units(spark, sf)


def _model_table(wide: DataFrame, name: str) -> DataFrame:
    """A table of the model, written as one file and read back."""
    ordered = wide.withColumn("_at", F.expr("cast(substr(horizon, 2) AS int) * 1000 + period"))
    spark = wide.sparkSession
    return model_files.read_model_table(spark, export(ordered, new_folder(spark, name), f"{name}.csv", order="_at"))


def dispatch_files(spark: SparkSession, sf: str) -> DataFrame:
    wide, metadata = queries.dispatch_wide(spark, sf)
    units = metadata.withColumnRenamed("unit", "DUID")
    others = [c for c in model.UNIT_COLUMNS if c not in units.columns]
    units = units.withColumns({c: F.lit(None).cast("string") for c in others})
    folder = export(units, new_folder(spark, "units"), "INPUT_DATA_GENERATION_{n}.csv")
    known = model_files.read_unit_metadata(spark, folder)
    found = model.model_dispatch(_model_table(wide, "Electricity_dispatch"), known, queries.MODEL_YEAR)
    return found.select("date_time", "unit", "output", "CAPACITY", "FUEL_TYPE_TEXT")


def price_files(spark: SparkSession, sf: str) -> DataFrame:
    wide = _model_table(queries.price_by_key(spark, sf), "SystemMarginalPrice")
    return model.model_price(wide, model.region_key(_units(spark, sf)), queries.MODEL_YEAR)


def _flow_rows(wide: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """The body below two rows with the ends of each column, all as text."""
    body = wide.select(
        F.expr("cast(substr(horizon, 2) AS int) * 1000 + period").alias("_at"),
        *(F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns),
    )
    heads = [
        ", ".join([str(k), "null", "null", *(f"'{pair[k]}'" for pair in pairs)]) for k in range(2)
    ]
    rows = ", ".join(f"({h})" for h in heads)
    columns = ", ".join(f"`{c}`" for c in body.columns)
    # cast as the body's, since a column of nulls only has no type
    head = wide.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")
    return head.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in body.dtypes)).unionByName(body)


def flow_files(spark: SparkSession, sf: str) -> DataFrame:
    wide, pairs = queries.flow_wide(queries.model_side_flows(spark, sf))
    rows = _flow_rows(wide, list(pairs.values()))
    folder = export(rows, new_folder(spark, "flows"), "IC_Flows_Hourly.csv", order="_at", header=False)
    body, links = model_files.read_model_flows(spark, folder)
    return network.name_links(model.model_flow(body, links, queries.MODEL_YEAR))


def flow_files_of_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Flows of several runs, one for each return flag, in one read; every second run's file has its
    columns the other way round."""
    folder = new_folder(spark, "runs")
    ends = ["date_time", "from_node", "to_node"]
    flows = views.region_flows(spark, sf, "l_returnflag").groupBy("l_returnflag", *ends).agg(F.sum("flow").alias("flow"))
    flows = stage(flows, "run-flows")
    runs = [row[0] for row in flows.select("l_returnflag").distinct().orderBy("l_returnflag").collect()]
    for k, run in enumerate(runs):
        wide, pairs = queries.flow_wide(flows.where(F.col("l_returnflag") == run).drop("l_returnflag"))
        names = list(pairs)[::-1] if k % 2 else list(pairs)
        rows = _flow_rows(wide.select("horizon", "period", *names), [pairs[n] for n in names])
        export(rows, folder, f"{run}_IC_Flows_Hourly.csv", order="_at", header=False)
    found = model_files.read_flow_runs(spark, folder, run=r"^([A-Z])_")
    return network.name_links(model.stamped_flow(found, queries.MODEL_YEAR))


def zonal_files(spark: SparkSession, sf: str) -> DataFrame:
    """Exogenous series from zonal inputs with the region key in the file name."""
    folder = new_folder(spark, "zonal")
    export(queries.zonal(spark, sf), folder, "INPUT_DATA_ZONAL_{REGION_KEY}.csv", ["REGION_KEY"])
    found = model_files.read_zonal(spark, folder)
    return model.exogenous_series(found, queries.region_key(spark, sf), queries.MODEL_YEAR)


def result_files(spark: SparkSession, sf: str) -> DataFrame:
    """Daily result tables as written, read back with the side from the folder, side by side."""
    live = queries.comparison(spark, sf)
    out = new_folder(spark, "results")
    write_results({"Price.DailyAvPrice": live.mean_price("day"), "IC_Flows.DailyFlows": live.link_flows("day")}, out)
    prices, flows = (spark.read.parquet(f"{out}/{t}") for t in ("Price/DailyAvPrice", "IC_Flows/DailyFlows"))
    return queries.rounded(flows.join(prices, ["side", "day"], "full"), queries.PRICE_DIGITS, REGIONS)


def result_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and hours of the hourly result tables, counted while they are written in total order."""
    live = queries.comparison(spark, sf)
    live = replace(live, facts=queries.DriverFacts(spark, sf).staged())
    tables = {"Price.DATA": live.prices, "IC_Flows.DATA": live.priced_flows, "IC_Flows.FlowInOut": live.balance}
    counted = write_results(tables, new_folder(spark, "results"), total_order=True)
    rows = [(name, c["rows"], c["first"], c["last"]) for name, c in counted.items()]
    return spark.createDataFrame(rows, "table string, rows long, first timestamp_ntz, last timestamp_ntz")


def links_found(spark: SparkSession, sf: str) -> DataFrame:
    """Daily flows with a column for each link that the data have."""
    return replace(queries.comparison(spark, sf), links=None).link_flows("day")


QUERIES = {
    "feed_files_demand": feed_files_demand,
    "feed_files_generation": feed_files_generation,
    "feed_files_price": feed_files_price,
    "feed_files_flow": feed_files_flow,
    "reserve_files": reserve_files,
    "plant_files": plant_files,
    "unit_files": unit_files,
    "dispatch_files": dispatch_files,
    "price_files": price_files,
    "flow_files": flow_files,
    "flow_files_of_runs": flow_files_of_runs,
    "zonal_files": zonal_files,
    "result_files": result_files,
    "result_counts": result_counts,
    "links_found": links_found,
}
