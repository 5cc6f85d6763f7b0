"""Registered queries: every library table on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from checks.views import table
from gridtally.functions import days_in_year
from gridtally.operators import (
    calendar,
    completeness,
    energy,
    hourly,
    model,
    network,
    plants,
    price,
    windows,
)
from gridtally.operators.network import REGIONS, VIRTUAL
from gridtally.operators.reshape import to_long, to_wide
from gridtally.plans.demand import demand_tables, horizon_matrix, hourly_technology_wide_feed
from gridtally.plans.results import Comparison, Facts
from gridtally.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]

LINKS = [f"{a}_{b}" for a in REGIONS for b in REGIONS]
TECHNOLOGIES = ["Coal", "Solar", "Wind", "UNKNOWN"]
MODEL_YEAR = 2020
PLANT_YEAR = 1998
PLANT_YEARS = range(1995, 2002)
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PAD_DAYS = 30
TEMPLATE_DAYS = 400
N_HORIZONS = 6


def rounded(df: DataFrame, digits: int, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def inline(spark: SparkSession, columns: str, pairs: dict[str, str]) -> DataFrame:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


# --- hourly tables from the 5-minute feed


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """Readings in whole cents, labelled as station, region and link."""
    return views.events_feed(spark, sf).select(
        "date_time",
        F.rint(F.col("value") * 100).alias("value"),
        views.mapped("event_type", views.STATIONS).alias("station"),
        views.mapped("event_type", views.FEED_REGION).alias("REGION"),
        views.mapped("event_type", views.FEED_LINK).alias("link"),
    )


def hourly_demand(spark: SparkSession, sf: str) -> DataFrame:
    return hourly.hourly_demand(feed(spark, sf), ["REGION"], value="value")


def station_technology(spark: SparkSession) -> DataFrame:
    return inline(spark, "station, Tech", views.STATION_TECHNOLOGY)


def wide_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The feed with one column per station, a row per reading."""
    labels = sorted(views.STATIONS.values())
    cells = [F.when(F.col("station") == s, F.col("value")).alias(s) for s in labels]
    return feed(spark, sf).select("date_time", *cells)


def hourly_generation_wide_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Missing readings are 0, so that a station's mean is over all rows of the hour."""
    return hourly_technology_wide_feed(wide_feed(spark, sf), station_technology(spark), [])


def hourly_generation(spark: SparkSession, sf: str) -> DataFrame:
    return hourly.technology_wide(
        hourly.hourly_technology(feed(spark, sf), station_technology(spark), value="value"),
        TECHNOLOGIES,
    )


def hourly_price(spark: SparkSession, sf: str) -> DataFrame:
    return price.price_wide(hourly.hourly_price(feed(spark, sf), value="value"))


def hourly_flow(spark: SparkSession, sf: str) -> DataFrame:
    return hourly.hourly_flow(feed(spark, sf), value="value")


def daily_price_from_feed(spark: SparkSession, sf: str) -> DataFrame:
    wide = hourly_price(spark, sf)
    return rounded(price.mean_price(wide, "day", skip_nulls=True), 8, REGIONS)


def residual_demand(spark: SparkSession, sf: str) -> DataFrame:
    demand = hourly.hourly_demand(feed(spark, sf), value="value")
    return energy.residual_demand(demand, hourly_generation(spark, sf))


def missing_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hours without a reading between the feed's first and last hour, per station."""
    return completeness.missing_slots(feed(spark, sf), ["station"], 60)


def missing_readings(spark: SparkSession, sf: str) -> DataFrame:
    """The same for 5-minute slots, with stamps that name the end of an interval, per region."""
    return completeness.missing_slots(feed(spark, sf), ["REGION"], 5, end_of_interval_minutes=5)


def feed_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Readings, gaps and repeats of every link on every day of January 2024."""
    days = completeness.coverage(
        feed(spark, sf), ["link"], 5, start="2024-01-01 00:00:00", end="2024-01-31 23:55:00"
    )
    return days.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def regional_demand_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    readings = feed(spark, sf)
    demand = hourly.hourly_demand(readings, ["REGION"], value="value")
    return demand, hourly.hourly_technology(
        readings, station_technology(spark), ["REGION"], value="value"
    )


def zonal_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Padded year per region, with a day of padding and the template of a leap year."""
    demand, technologies = regional_demand_inputs(spark, sf)
    return demand_tables(demand, technologies, pad=24, template=8832)["DataEntry_1"]


def demand_horizons(spark: SparkSession, sf: str) -> DataFrame:
    demand, technologies = regional_demand_inputs(spark, sf)
    return demand_tables(demand, technologies, pad=24, template=8832)["DEMAND"]


# --- calendar


def time_map(spark: SparkSession, sf: str) -> DataFrame:
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return calendar.expand_time_map(years, calendar.HorizonMap(leap="first_8760"))


def hour_spine(spark: SparkSession, sf: str) -> DataFrame:
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return calendar.expand_hours(years)


def readings_by_horizon(spark: SparkSession, sf: str) -> DataFrame:
    labelled = calendar.label_horizons(feed(spark, sf).select("date_time"))
    return labelled.groupBy("horizon", "period").agg(F.count(F.lit(1)).alias("readings"))


def padded_year(spark: SparkSession, sf: str) -> DataFrame:
    days = views.daily_series(spark, sf).drop("date_time")
    return windows.pad_year(days, days_in_year(F.col("year")), PAD_DAYS, TEMPLATE_DAYS)


def rolling_horizons(spark: SparkSession, sf: str) -> DataFrame:
    placed = windows.rolling_horizons(padded_year(spark, sf))
    return placed.select(
        "year", "horizon", "period",
        F.col("quantity").alias("DEMAND"),
        F.col("n_items").alias("OPERATING_RESERVE_UP"),
        F.col("returned").alias("OPERATING_RESERVE_DOWN"),
    )


def horizon_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Rolling horizons as a matrix: a row per period, a column per horizon."""
    placed = rolling_horizons(spark, sf).select(
        F.lit("ALL").alias("REGION"), "year", "horizon", "period",
        F.col("DEMAND").alias("value"),
    )
    return horizon_matrix(placed, N_HORIZONS)


# --- plant and model tables


def plant_inputs(
    spark: SparkSession, sf: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Specs, capacity (wide by year) and cost (wide by year) of the suppliers."""
    key = F.col("s_suppkey")
    ids = [
        F.col("s_name").alias("STATION"),
        F.concat(F.lit("D"), key.cast("string")).alias("DUID"),
        "REGION",
        "REGION_KEY",
    ]
    nation = views.nations(spark, sf, "s_nationkey", "REGION_KEY")
    stations = table(spark, sf, "supplier").join(nation, "s_nationkey")
    others = [
        c for c in plants.PLANT_COLUMNS
        if c not in (*plants.PLANT_KEYS, "CAPACITY", "VARCOST")
    ]
    specs = stations.select(
        *ids,
        (F.lit(1990) + F.floor(F.col("s_acctbal") / 1000)).cast("int").alias("AvaliableDate"),
        (F.lit(2005) - F.floor(F.col("s_acctbal") / 800)).cast("int")
        .alias("ExpectedRetirementYear"),
        *[(key + i).alias(c) for i, c in enumerate(others)],
    )
    items = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("y"),
        "l_quantity", "l_extendedprice",
    )
    yearly = items.groupBy("s_suppkey").agg(
        *[F.sum(F.when(F.col("y") == y, F.col("l_quantity"))).alias(f"Cap {y}")
          for y in PLANT_YEARS],
        *[F.min(F.when(F.col("y") == y, F.col("l_extendedprice"))).alias(f"SRMC {y}")
          for y in PLANT_YEARS],
    )
    sized = stations.join(yearly, "s_suppkey")
    capacity = sized.select(*ids, *[F.col(f"`Cap {y}`") for y in PLANT_YEARS])
    cost = sized.select(*ids, *[F.col(f"`SRMC {y}`") for y in PLANT_YEARS])
    return specs, capacity, cost


def plant_table(spark: SparkSession, sf: str) -> DataFrame:
    return plants.plant_table(*plant_inputs(spark, sf), PLANT_YEAR)


def units(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as generating units."""
    size = F.col("p_size")
    node = (size % 5 + 1).cast("int")
    return table(spark, sf, "part").select(
        F.col("p_name").alias("STATION"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("DUID"),
        views.region_of("p_size % 5 + 1").alias("REGION"),
        node.alias("REGION_KEY"),
        size.cast("double").alias("CAPACITY"),
        views.mapped("p_type", views.TECHNOLOGY).alias("FUEL_TYPE_TEXT"),
        (size * 2).cast("double").alias("INITIAL_ENERGY_STOCK_IN_DAMS"),
        (size * 3).cast("double").alias("HYDRO_DAM_CAPACITY"),
        F.col("p_retailprice").alias("VARCOST"),
    )


def unit_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return model.unit_metadata(units(spark, sf))


def region_key(spark: SparkSession, sf: str) -> DataFrame:
    return model.region_key(units(spark, sf))


def dispatch_wide(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """One unit per part type, wide, and metadata of the units; STANDARD has none."""
    parts = table(spark, sf, "part")
    items = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    sums = (
        items.join(parts.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
        .groupBy("l_shipdate", "p_type")
        .agg(F.sum("l_quantity").alias("output"))
    )
    by_day = to_wide(sums, ["l_shipdate"], "p_type", "output", PART_TYPES)
    wide = by_day.select(*views.model_index("l_shipdate"), *PART_TYPES)
    metadata = (
        parts.where(F.col("p_type") != "STANDARD")
        .groupBy(F.col("p_type").alias("unit"))
        .agg(F.sum("p_size").cast("double").alias("CAPACITY"))
        .withColumn("FUEL_TYPE_TEXT", views.mapped("unit", views.TECHNOLOGY))
    )
    return wide, metadata


def model_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    return model.model_dispatch(*dispatch_wide(spark, sf), MODEL_YEAR)


def price_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Prices wide by region key; key 9 is no region."""
    by_day = price.price_wide(
        views.prices(spark, sf).where(F.col("side") == "Model"), REGIONS
    )
    return by_day.select(
        *views.model_index("date_time"),
        *[F.col(r).alias(str(i)) for i, r in enumerate(REGIONS, 1)],
        F.col(REGIONS[0]).alias("9"),
    )


def model_price(spark: SparkSession, sf: str) -> DataFrame:
    return model.model_price(price_by_key(spark, sf), region_key(spark, sf), MODEL_YEAR)


def flow_wide(flows: DataFrame) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """Region flows wide by link, and the ends of each link."""
    nodes = range(1, len(REGIONS) + 1)
    pairs = {f"{a}_{b}": (a, b) for a in nodes for b in nodes}
    named = flows.withColumn("pair", F.concat_ws("_", "from_node", "to_node"))
    by_day = to_wide(named, ["date_time"], "pair", "flow", list(pairs))
    return by_day.select(*views.model_index("date_time"), *[F.col(p) for p in pairs]), pairs


def model_side_flows(spark: SparkSession, sf: str) -> DataFrame:
    return views.region_flows(spark, sf).where(F.col("side") == "Model")


def model_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Flows of the model side, wide by link position, made long and named."""
    wide, pairs = flow_wide(model_side_flows(spark, sf))
    rows = ", ".join(f"('{p}', {a}, {b})" for p, (a, b) in pairs.items())
    links = spark.sql(f"SELECT * FROM VALUES {rows} AS t(position, from_node, to_node)")
    return network.name_links(model.model_flow(wide, links, MODEL_YEAR))


def zonal(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per day and customer region as zonal inputs, a day per hour number."""
    orders = views.delivered_orders(spark, sf, "o_orderdate", "o_orderpriority")

    def count(label: str) -> Column:
        return F.count(F.when(F.col("o_orderpriority") == label, F.lit(1))).cast("double")

    return (
        orders.groupBy("o_orderdate", F.col("to_node").alias("REGION_KEY"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("Demand"),
            count("1-URGENT").alias("Wind"),
            count("2-HIGH").alias("Solar"),
            count("5-LOW").alias("Hydro"),
        )
        .withColumn("Time", views.model_day("o_orderdate") + 1)
        .drop("o_orderdate")
    )


def exogenous_series(spark: SparkSession, sf: str) -> DataFrame:
    return model.exogenous_series(zonal(spark, sf), region_key(spark, sf), MODEL_YEAR)


def storage_net_output(spark: SparkSession, sf: str) -> DataFrame:
    """Returned quantity is charge, accepted quantity discharge, per day and part."""
    items = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("date_time"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("unit"),
        "l_returnflag", "l_quantity",
    )

    def moved(flag: str, name: str) -> DataFrame:
        rows = items.where(F.col("l_returnflag") == flag)
        return rows.groupBy("date_time", "unit").agg(F.sum("l_quantity").alias(name))

    metadata = unit_metadata(spark, sf).select("unit", "REGION", "CAPACITY")
    return model.storage_net_output(moved("R", "charge"), moved("A", "discharge"), metadata)


# --- comparison tables


def exogenous(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per day and customer region as demand, urgent ones also as exogenous wind."""
    orders = views.delivered_orders(
        spark, sf,
        F.when(F.col("o_orderstatus") == "O", "Model").otherwise("Actual").alias("side"),
        F.col("o_orderdate").alias("date_time"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0).alias("urgent"),
    )
    ids = ["side", "date_time", "REGION"]
    sums = orders.groupBy(*ids).agg(
        F.count(F.lit(1)).cast("double").alias("Demand"), F.sum("urgent").alias("Wind")
    )
    return to_long(sums, ids, "FUEL_TYPE_TEXT", "output")


class DriverFacts:
    """The facts of a comparison on the driver's tables, each built when first used."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = spark, sf

    @cached_property
    def prices(self) -> DataFrame:
        return views.prices(self.spark, self.sf)

    @cached_property
    def flows(self) -> DataFrame:
        return network.name_links(
            views.node_flows(views.region_flows(self.spark, self.sf)), ends=True
        )

    @cached_property
    def output(self) -> DataFrame:
        return views.dispatch(self.spark, self.sf)

    @cached_property
    def exogenous(self) -> DataFrame:
        return exogenous(self.spark, self.sf)

    def staged(self) -> Facts:
        """The same facts from one pass over the line items, written once."""
        shipped = stage(views.shipments(self.spark, self.sf), "shipments")
        flows = views.node_flows(views.region_flows_of(shipped))
        return Facts(
            views.prices_of(shipped), network.name_links(flows, ends=True), views.dispatch_of(shipped),
            self.exogenous,
        ).staged()


def comparison(spark: SparkSession, sf: str, **options) -> Comparison:
    return Comparison(
        DriverFacts(spark, sf), ["Demand", *views.FUELS], LINKS, **options
    )


PRICE_DIGITS = 6


def mean_price(grain: str, **options) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        frame = comparison(spark, sf, **options).mean_price(grain)
        return rounded(frame, PRICE_DIGITS, REGIONS)

    return query


def load_weighted_price(grain: str, **options) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        frame = comparison(spark, sf, **options).load_weighted_price(grain)
        return rounded(frame, PRICE_DIGITS, REGIONS)

    return query


def link_flows(grain: str, **options) -> Query:
    return lambda spark, sf: comparison(spark, sf, **options).link_flows(grain)


def balance_totals(grain: str, **options) -> Query:
    return lambda spark, sf: comparison(spark, sf, **options).balance_totals(grain)


def generation_totals(grain: str, **options) -> Query:
    return lambda spark, sf: comparison(spark, sf, **options).generation_totals(grain)


def region_balance(**options) -> Query:
    return lambda spark, sf: comparison(spark, sf, **options).balance


def price_hourly_wide(spark: SparkSession, sf: str) -> DataFrame:
    return comparison(spark, sf).prices


def network_flows(spark: SparkSession, sf: str) -> DataFrame:
    return comparison(spark, sf).flows


def priced_flows(spark: SparkSession, sf: str) -> DataFrame:
    return comparison(spark, sf).priced_flows


REVENUE_LINKS = [
    *[link for link in LINKS if link not in set(network.LINK_RECODE.values())],
    *[link for link in network.LINK_RECODE if link.split("_")[1] not in VIRTUAL],
]


def link_revenue(spark: SparkSession, sf: str) -> DataFrame:
    priced = comparison(spark, sf).priced_flows
    wide = network.link_revenue_wide(priced, REVENUE_LINKS, ["side"])
    return rounded(wide, 0, REVENUE_LINKS)


def generation_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return comparison(spark, sf).generation


def output_by_fuel(spark: SparkSession, sf: str) -> DataFrame:
    return energy.output_by_fuel(views.dispatch(spark, sf), ["side"])


def dispatch_weights(spark: SparkSession, sf: str) -> DataFrame:
    return energy.weights_wide(comparison(spark, sf).weights, REGIONS, ["side"])


def results_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All whole-period tables; the facts are written once, as many tables use each."""
    live = comparison(spark, sf, skip_nulls=True)
    facts = DriverFacts(spark, sf).staged()
    return rounded(replace(live, facts=facts).summary(), 0, ["value"])


QUERIES: dict[str, Query] = {
    "hourly_demand": hourly_demand,
    "hourly_generation": hourly_generation,
    "hourly_generation_wide_feed": hourly_generation_wide_feed,
    "hourly_price": hourly_price,
    "hourly_flow": hourly_flow,
    "daily_price_from_feed": daily_price_from_feed,
    "residual_demand": residual_demand,
    "zonal_inputs": zonal_inputs,
    "demand_horizons": demand_horizons,
    "missing_hours": missing_hours,
    "missing_readings": missing_readings,
    "feed_coverage": feed_coverage,
    "time_map": time_map,
    "hour_spine": hour_spine,
    "readings_by_horizon": readings_by_horizon,
    "padded_year": padded_year,
    "rolling_horizons": rolling_horizons,
    "horizon_columns": horizon_columns,
    "plant_table": plant_table,
    "unit_metadata": unit_metadata,
    "region_key": region_key,
    "model_dispatch": model_dispatch,
    "model_price": model_price,
    "model_flow": model_flow,
    "exogenous_series": exogenous_series,
    "storage_net_output": storage_net_output,
    "price_hourly_wide": price_hourly_wide,
    "mean_price_period": mean_price("period", skip_nulls=True),
    "mean_price_daily": mean_price("day"),
    "mean_price_monthly": mean_price("month", skip_nulls=True),
    "mean_price_monthly_strict": mean_price("month", by_year=True),
    "network_flows": network_flows,
    "priced_flows": priced_flows,
    "link_flows_annual": link_flows("period"),
    "link_flows_daily": link_flows("day"),
    "link_flows_monthly": link_flows("month"),
    "link_flows_by_year": link_flows("period", by_year=True),
    "region_balance_hourly": region_balance(),
    "region_balance_strict": region_balance(strict=True),
    "region_balance_daily": balance_totals("day"),
    "region_balance_monthly": balance_totals("month"),
    "region_balance_annual": balance_totals("period"),
    "link_revenue": link_revenue,
    "output_by_fuel": output_by_fuel,
    "generation_hourly": generation_hourly,
    "generation_daily": generation_totals("day"),
    "generation_monthly": generation_totals("month"),
    "generation_annual": generation_totals("period"),
    "dispatch_weights": dispatch_weights,
    "load_weighted_price_period": load_weighted_price("period", skip_nulls=True),
    "load_weighted_price_daily": load_weighted_price("day"),
    "load_weighted_price_monthly": load_weighted_price("month", skip_nulls=True),
    "load_weighted_price_monthly_strict": load_weighted_price("month", by_year=True),
    "results_summary": results_summary,
}
