"""The driver's tables, seen as market data.

Every view reads whole tables and is exact: money is summed in whole cents and quantities
are whole numbers, so results do not depend on the order of addition.

* A nation's region is its region key + 1 as node number: 1 NSW … 5 VIC.
* ``side`` is the line status of a line item: ``O`` is the model, the rest is actual.
* The supplier's region is where energy is produced, the customer's where it goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.network import REGIONS

# part type -> technology; STANDARD has none on purpose, LARGE is not a dispatch fuel
TECHNOLOGY = {
    "PROMO": "Wind", "SMALL": "Solar", "MEDIUM": "Hydro", "ECONOMY": "Coal", "LARGE": "Gas",
}
FUELS = ["Coal", "Gas", "Hydro", "Solar", "Wind"]

# event type -> station, price region, link label of the feed, technology (click has none)
STATIONS = {
    "click": "CLK1", "error": "ERR1", "purchase": "PUR1", "signup": "SGN1", "view": "VIW1",
}
STATION_TECHNOLOGY = {"ERR1": "Coal", "PUR1": "Wind", "SGN1": "Solar", "VIW1": "Wind"}
FEED_REGION = {
    "click": "NSW", "error": "QLD", "purchase": "SA", "signup": "TAS", "view": "VIC",
}
FEED_LINK = {
    "click": "NSW_QLD", "error": "NSW_QLD1", "purchase": "TAS_VIC", "signup": "VIC_SA",
    "view": "VIC_SA1",
}


# declared, so that no job reads file footers while a plan is built
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey LONG, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, "
    "value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def mapped(column: str, pairs: dict[str, str]) -> Column:
    """Fixed label lookup; labels not listed are null."""
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return F.expr(f"CASE {column} {cases} END")


def _side() -> Column:
    return F.when(F.col("l_linestatus") == "O", "Model").otherwise("Actual").alias("side")


def region_of(node: str) -> Column:
    """Region name of a node number from 1 to 5, an SQL expression."""
    names = ", ".join(f"'{r}'" for r in REGIONS)
    return F.expr(f"element_at(array({names}), {node})")


def _cents(column: str) -> Column:
    return F.rint(F.col(column) * 100).cast("long")


def events_feed(spark: SparkSession, sf: str) -> DataFrame:
    """5-minute readings: ``date_time, event_type, value``."""
    return table(spark, sf, "events").select(
        F.col("ts").alias("date_time"), "event_type", "value"
    )


def nations(spark: SparkSession, sf: str, key: str, node: str) -> DataFrame:
    """``key, node, REGION`` per nation."""
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias(key),
        (F.col("n_regionkey") + 1).alias(node),
        region_of("n_regionkey + 1").alias("REGION"),
    )


def supplied(spark: SparkSession, sf: str, items: DataFrame) -> DataFrame:
    """Line items (with ``l_suppkey``) and ``from_node, REGION`` of their supplier.

    The items are joined to one table after the other: Spark takes the size of a join to be
    the product of its inputs, so supplier with nation would seem larger than it is.
    """
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    nation = nations(spark, sf, "s_nationkey", "from_node")
    return (
        items.join(supplier, "l_suppkey")
        .join(nation, "s_nationkey")
        .drop("l_suppkey", "s_nationkey")
    )


def delivered_orders(spark: SparkSession, sf: str, *columns: Column | str) -> DataFrame:
    """``columns`` of orders with ``to_node, REGION`` of the customer who placed them."""
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    nation = nations(spark, sf, "c_nationkey", "to_node")
    orders = table(spark, sf, "orders").select("o_custkey", *columns)
    return (
        orders.join(customer, "o_custkey")
        .join(nation, "c_nationkey")
        .drop("o_custkey", "c_nationkey")
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """``side, date_time, REGION, spot_price``: mean value of the line items supplied."""
    items = table(spark, sf, "lineitem").select(
        _side(), F.col("l_shipdate").alias("date_time"), "l_suppkey",
        _cents("l_extendedprice").alias("cents"),
    )
    mean = F.sum("cents").cast("double") / (F.count(F.lit(1)) * 100)
    return (
        supplied(spark, sf, items)
        .groupBy("side", "date_time", "REGION")
        .agg(mean.alias("spot_price"))
    )


def fuels(spark: SparkSession, sf: str) -> DataFrame:
    """``l_partkey, is_dispatch, FUEL_TYPE_TEXT``."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.lit(True).alias("is_dispatch"),
        mapped("p_type", TECHNOLOGY).alias("FUEL_TYPE_TEXT"),
    )


def dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """``side, date_time, REGION, FUEL_TYPE_TEXT, output``: quantity per region and fuel."""
    items = table(spark, sf, "lineitem").select(
        _side(), F.col("l_shipdate").alias("date_time"), "l_suppkey", "l_partkey",
        F.col("l_quantity").alias("output"),
    )
    return supplied(spark, sf, items.join(fuels(spark, sf), "l_partkey")).select(
        "side", "date_time", "REGION", "FUEL_TYPE_TEXT", "output"
    )


def region_flows(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """``side, date_time, from_node, to_node, flow`` between physical regions; other columns of
    the line items as further ``keys``.

    Line items are joined to orders and suppliers once and summed straight away; all flow
    tables are linear in the flow, so they work on the sums.
    """
    items = table(spark, sf, "lineitem").select(
        _side(), F.col("l_shipdate").alias("date_time"), "l_orderkey", "l_suppkey", "l_quantity",
        *keys,
    )
    orders = delivered_orders(spark, sf, F.col("o_orderkey").alias("l_orderkey")).drop("REGION")
    return (
        supplied(spark, sf, items)
        .drop("REGION")
        .join(orders, "l_orderkey")
        .groupBy("side", "date_time", "from_node", "to_node", *keys)
        .agg(F.sum("l_quantity").alias("flow"))
    )


def node_flows(flows: DataFrame) -> DataFrame:
    """Region flows as the model reports them: through a virtual node where there is one.

    NSW-QLD flows pass QNI, SA-VIC flows ML, TAS-VIC flows M1 or (even days) M2; each then
    is two rows, one per half. Other flows are one row.
    """

    def between(a: int, b: int) -> Column:
        low, high = F.least("from_node", "to_node"), F.greatest("from_node", "to_node")
        return (low == a) & (high == b)

    even = F.dayofmonth("date_time") % 2 == 0
    via = (
        F.when(between(1, 2), F.lit(6))
        .when(between(3, 5), F.lit(7))
        .when(between(4, 5), F.when(even, F.lit(9)).otherwise(F.lit(8)))
    )
    start, end, middle = F.col("from_node"), F.col("to_node"), F.col("via")
    halves = F.when(
        middle.isNull(), F.array(F.struct(start.alias("a"), end.alias("b")))
    ).otherwise(
        F.array(
            F.struct(start.alias("a"), middle.alias("b")),
            F.struct(middle.alias("a"), end.alias("b")),
        )
    )
    rows = flows.withColumn("via", via).withColumn("half", F.explode(halves))
    return rows.select(
        "side", "date_time", F.col("half.a").alias("from_node"),
        F.col("half.b").alias("to_node"), "flow",
    )


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    """All that prices, dispatch and flows need of the line items, from one pass over them.

    ``side, date_time, from_node, REGION, to_node, is_dispatch, FUEL_TYPE_TEXT`` and ``cents,
    n, quantity``: a few hundred rows per day. Items without an order have no ``to_node``,
    items without a part are no dispatch.
    """
    items = table(spark, sf, "lineitem").select(
        _side(), F.col("l_shipdate").alias("date_time"), "l_suppkey", "l_partkey", "l_orderkey",
        _cents("l_extendedprice").alias("cents"), "l_quantity",
    )
    orders = delivered_orders(spark, sf, F.col("o_orderkey").alias("l_orderkey")).drop("REGION")
    joined = (
        supplied(spark, sf, items.join(fuels(spark, sf), "l_partkey", "left"))
        .drop("REGION")  # named after the shuffles, from its node
        .join(orders, "l_orderkey", "left")
    )
    return joined.groupBy(
        "side", "date_time", "from_node", "to_node",
        F.coalesce("is_dispatch", F.lit(False)).alias("is_dispatch"), "FUEL_TYPE_TEXT",
    ).agg(
        F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("quantity"),
    ).withColumn("REGION", region_of("from_node"))


def prices_of(shipped: DataFrame) -> DataFrame:
    """:func:`prices` from shipments."""
    mean = F.sum("cents").cast("double") / (F.sum("n") * 100)
    return shipped.groupBy("side", "date_time", "REGION").agg(mean.alias("spot_price"))


def dispatch_of(shipped: DataFrame) -> DataFrame:
    """:func:`dispatch` from shipments."""
    return shipped.where("is_dispatch").select(
        "side", "date_time", "REGION", "FUEL_TYPE_TEXT", F.col("quantity").alias("output")
    )


def region_flows_of(shipped: DataFrame) -> DataFrame:
    """:func:`region_flows` from shipments."""
    return (
        shipped.where(F.col("to_node").isNotNull())
        .groupBy("side", "date_time", "from_node", "to_node")
        .agg(F.sum("quantity").alias("flow"))
    )


def daily_series(spark: SparkSession, sf: str) -> DataFrame:
    """``year, t, date_time, n_items, quantity``: shipped per day, ``t`` the day of the year."""
    days = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_shipdate").alias("date_time"))
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count(F.lit(1)).cast("double").alias("n_items"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
            .alias("returned"),
        )
    )
    return days.select(
        F.year("date_time").alias("year"), F.dayofyear("date_time").alias("t"), "date_time",
        "quantity", "n_items", "returned",
    )


FIRST_DAY = "1995-01-01"


def model_day(ts: str) -> Column:
    """0-based day number, which stands for the hour number of the model."""
    return F.datediff(F.to_date(ts), F.lit(FIRST_DAY).cast("date"))


def model_index(ts: str, length: int = 70) -> tuple[Column, Column]:
    """(horizon, period) columns of a day read as a model hour."""
    position = model_day(ts)
    horizon = F.concat(F.lit("r"), (F.floor(position / length) + 1).cast("string"))
    return horizon.alias("horizon"), (position % length + 1).alias("period")
