"""Operators on small literal tables, with the awkward cases."""

import pytest
from pyspark.sql import functions as F

from gridtally.operators import energy, hourly, model, network, plants, price, reshape
from gridtally.operators.grains import aggregate_by
from gridtally.operators.network import LINK_RECODE, NODES, REGIONS, VIRTUAL, Network

TS = "date_time timestamp_ntz"


# --- reshape


def test_to_long_keeps_nulls(spark, rows):
    df = spark.createDataFrame([(1, 2.0, None)], "id int, `a.x` double, b double")
    assert rows(reshape.to_long(df, ["id"], "k", "v")) == [(1, "a.x", 2.0), (1, "b", None)]
    assert rows(reshape.to_long(df, ["id"], "k", "v", ["b"])) == [(1, "b", None)]


def test_to_wide(spark, rows):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", None), (2, "b", 3.0), (2, "z", 9.0)],
                               "id int, k string, v double")
    wide = reshape.to_wide(df.where("k <> 'z'"), ["id"], "k", "v", ["a", "b"], "_W")
    assert wide.columns == ["id", "a_W", "b_W"]
    assert rows(wide) == [(1, 2.0, None), (2, None, 3.0)]
    rest = reshape.to_wide(df, ["id"], "k", "v", ["a", "b"], other="rest")
    assert rows(rest) == [(1, 2.0, None, None), (2, None, 3.0, 9.0)]


@pytest.mark.parametrize("label", ["z", None])
def test_to_wide_refuses_labels_that_are_not_listed(spark, label):
    df = spark.createDataFrame([(1, "a", 2.0), (1, label, 9.0)], "id int, k string, v double")
    with pytest.raises(Exception, match="k not among the columns"):
        reshape.to_wide(df, ["id"], "k", "v", ["a"]).select("a").collect()


def test_node_names_may_hold_underscores(spark, rows):
    few = network.Network({1: "N_1", 2: "N_2"}, (), {})
    many = network.Network({k: f"N_{k}" for k in range(1, 151)}, (), {})
    flows = spark.createDataFrame([("N_1_N_2",), ("X_Y_Z",)], "link string")
    for grid in (few, many):
        found = network.resolve_links(flows, grid)
        assert rows(found, "link", "from_virtual", "to_virtual", "from_to", "from", "to") == [
            ("N_1_N_2", "N_1", "N_2", "N_1_N_2", "N_1", "N_2"), ("X_Y_Z", "X", "Z", "X_Y_Z", "X", "Z")]


def test_links_of_one_name_stay_apart(spark, rows):
    """A_B_C is both A to B_C and A_B to C: apart in all tables, an error by name alone."""
    grid = network.Network({1: "A", 2: "A_B", 3: "B_C", 4: "C"}, (), {"A_B_C_C": "A_C"})
    assert grid.ambiguous_links() == ["A_B_C"] and not Network().ambiguous_links()
    data = [(0, 1, 3, 1000.0), (0, 2, 4, 5000.0), (0, 1, 4, 7000.0)]
    ids = "hour int, from_node int, to_node int, flow double"
    numbered = spark.createDataFrame(data, ids).select(
        F.expr("TIMESTAMP_NTZ'2021-01-01' + make_dt_interval(0, hour)").alias("date_time"), "from_node", "to_node", "flow")
    named = network.name_links(numbered, grid, ends=True)
    flows = network.resolve_links(named, grid)
    apart = [("A_B_C", "A", "B_C", 1.0), ("A_B_C", "A_B", "C", 5.0), ("A_C", "A", "C", 7.0)]
    assert rows(network.link_flows(flows, "period", network=grid), "from_to", "from", "to", "flow") == apart
    balance = network.region_balance(flows, network=grid)
    assert rows(balance, "REGION", "In", "Out") == [
        ("A", 0.0, 8000.0), ("A_B", 0.0, 5000.0), ("B_C", 1000.0, 0.0), ("C", 12000.0, 0.0)]
    priced = flows.withColumns({"price_from": F.lit(1.0), "price_to": F.lit(2.0)})
    assert rows(network.link_revenue(priced, network=grid, ends=True), "link", "from_virtual", "to_virtual", "annual_revenue") == [
        (n, a, b, 1000 * f) for n, a, b, f in apart]
    for wide in (network.link_flows_wide(flows, "period", ["A_B_C", "A_C"], network=grid),
                 network.link_revenue_wide(priced, ["A_B_C", "A_C"], network=grid)):
        with pytest.raises(Exception, match="more than one row for"):
            wide.collect()
    with pytest.raises(Exception, match="more than one pair of nodes is named A_B_C"):
        network.resolve_links(named.drop("from_virtual", "to_virtual"), grid).collect()
    with pytest.raises(ValueError, match="more than one link"):
        grid.ends_of("A_B_C")
    with pytest.raises(ValueError, match="same name"):
        network.Network({1: "A", 2: "A"}, (), {})


def test_recoded_by_ends_not_by_name(spark, rows):
    """Only the link that the recode names is recoded, not another one of its name."""
    grid = network.Network({1: "A", 2: "V", 3: "B"}, ("V",), {"A_V": "A_B", "V_B": "A_B"})
    flows = spark.createDataFrame([("A_V", None, None), ("A_V", "A_V", "x"), ("V_B", "V", "B")],
                                  "link string, from_virtual string, to_virtual string")
    assert rows(network.resolve_links(flows, grid), "link", "from_to", "from", "to") == [
        ("A_V", "A_B", "A", "B"), ("A_V", "A_V", "A_V", "x"), ("V_B", "A_B", "A", "B")]


def test_keys_of_metadata_are_unique(spark, rows, at):
    """A key that stands twice would multiply rows: an error in each join on it."""
    twice = spark.createDataFrame([("u", 1), ("u", 2), (None, 3), (None, 4)], "unit string, CAPACITY int")
    hours = spark.createDataFrame([(at("01-01 00:00"), "u", 1.0)], f"{TS}, unit string, charge double")
    other = hours.withColumnRenamed("charge", "discharge")
    with pytest.raises(Exception, match="more than one row for unit u"):
        model.storage_net_output(hours, other, twice).collect()
    once = twice.where("CAPACITY <> 2")
    assert rows(model.storage_net_output(hours, other, once), "unit", "CAPACITY") == [("u", 1)]
    with pytest.raises(Exception, match="more than one row for a, b 1, x"):
        pairs = spark.createDataFrame([(1, "x", 1), (1, "x", 1), (1, "y", 2)], "a int, b string, c int")
        reshape.one_row_each(pairs, ["a", "b"]).collect()
    prices = spark.createDataFrame([("r11", 45, 5.0)], "horizon string, period int, `1` double")
    with pytest.raises(Exception, match="more than one row for region 1"):
        names = spark.createDataFrame([("NSW", 1), ("QLD", 1)], "REGION string, REGION_KEY int")
        model.model_price(prices, names, 2021).collect()


def test_leap_year_round_trip(spark, rows, at):
    """Padded hours of 2020 come back with the stamps they had, under every leap policy."""
    from gridtally.operators.calendar import HorizonMap, hour_of_year
    from gridtally.operators.windows import pad_year

    series = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2020-01-01', TIMESTAMP_NTZ'2020-12-31 23:00:00',"
                       " INTERVAL 1 HOUR)) AS date_time").withColumn("t", hour_of_year(F.col("date_time")))
    source = series.select(F.lit("NSW").alias("REGION"), F.lit(2020).alias("year"), "t", F.col("t").cast("double").alias("Demand"))
    padded = pad_year(source, F.lit(8784), 720, 10300)
    zonal = padded.select(F.col("t").alias("Time"), "Demand", *(F.lit(0.0).alias(c) for c in ("Wind", "Solar", "Hydro")),
                          F.lit(1).alias("REGION_KEY"))
    keys = spark.createDataFrame([("NSW", 1)], "REGION string, REGION_KEY int")
    for leap, hours in (("skip_feb28", 8760), ("skip_feb29", 8760), ("first_8760", 8760), ("all", 8784)):
        try:
            horizons = HorizonMap(leap=leap)
            found = model.exogenous_series(zonal, keys, 2020, horizons).where("FUEL_TYPE_TEXT = 'Demand'")
        except ValueError:  # the default horizons hold 8,760 hours
            continue
        joined = found.join(series, "date_time", "left")
        assert found.count() == hours and joined.where("NOT output <=> t").count() == 0, leap


def test_to_wide_takes_any_name(spark, rows):
    names = ["O'Brien \\ Co", "MIDDLE EAST", "a.b"]
    df = spark.createDataFrame([(1, n, float(i)) for i, n in enumerate(names)], "id int, k string, v double")
    wide = reshape.to_wide(df, ["id"], "k", "v", names)
    assert wide.columns == ["id", *names] and rows(wide) == [(1, 0.0, 1.0, 2.0)]


def test_to_wide_refuses_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", None)], "id int, k string, v double")
    with pytest.raises(Exception, match="more than one row for k a"):
        reshape.to_wide(df, ["id"], "k", "v", ["a"]).collect()


def test_yearly_to_long(spark, rows):
    df = spark.createDataFrame(
        [("p", 1.0, 2.0, 9.0)], "DUID string, `Cap 2021` double, `Cap 2022` double, `Note 1` double"
    )
    assert rows(reshape.yearly_to_long(df, ["DUID"], "Cap ", "MW")) == [
        ("p", 2021, 1.0), ("p", 2022, 2.0)
    ]
    assert rows(reshape.yearly_to_long(df, ["DUID"], "Cap ", "MW", 2022)) == [("p", 2022, 2.0)]
    none = reshape.yearly_to_long(df, ["DUID"], "Cap ", "MW", 1999)
    assert none.columns == ["DUID", "year", "MW"] and none.count() == 0


def test_stack_and_zero_columns(spark, rows):
    a = spark.createDataFrame([(1, 2.0)], "id int, x double")
    b = spark.createDataFrame([(3.0, 4)], "y double, id int")
    assert rows(reshape.stack([a, b]), "id", "x", "y") == [(1, 2.0, None), (4, None, 3.0)]
    assert rows(reshape.with_zero_columns(a, ["x", "Wind"])) == [(1, 2.0, 0.0)]


def test_grains(spark, rows, at):
    df = spark.createDataFrame(
        [("s", at("01-01 00:00"), 1.0), ("s", at("01-01 05:00"), 2.0),
         ("s", at("12-01 00:00"), 4.0), ("s", at("01-09 00:00", 2022), 8.0)],
        f"side string, {TS}, v double",
    )
    total = [F.sum("v").alias("v")]
    assert rows(aggregate_by(df, "day", ["side"], total)) == [
        ("s", "01/01/21", 3.0), ("s", "01/09/22", 8.0), ("s", "12/01/21", 4.0)
    ]
    assert rows(aggregate_by(df, "month", ["side"], total)) == [("s", "01", 11.0), ("s", "12", 4.0)]
    assert rows(aggregate_by(df, "month", ["side"], total, by_year=True)) == [
        ("s", 2021, "01", 3.0), ("s", 2021, "12", 4.0), ("s", 2022, "01", 8.0)
    ]
    assert rows(aggregate_by(df, "period", [], total)) == [(15.0,)]
    with pytest.raises(ValueError, match="grain"):
        aggregate_by(df, "week", [], total)


# --- hourly


def test_hourly_mean(spark, rows, at):
    feed = spark.createDataFrame(
        [("a", at("01-01 00:00"), 1.0), ("a", at("01-01 00:55"), 3.0),
         ("a", at("01-01 01:00"), 5.0), ("b", at("01-01 00:00"), 4.0), ("b", at("01-01 00:05"), None)],
        f"k string, {TS}, v double",
    )
    h0, h1 = at("01-01 00:00"), at("01-01 01:00")
    assert rows(hourly.hourly_mean(feed, ["k"], "v")) == sorted(
        [(h0, "a", 2.0), (h1, "a", 5.0), (h0, "b", None)], key=repr)
    assert rows(hourly.hourly_mean(feed, ["k"], "v", fill_zero=True)) == sorted(
        [(h0, "a", 2.0), (h1, "a", 5.0), (h0, "b", 2.0)], key=repr)
    ends = hourly.hourly_mean(feed.where("k = 'a'"), ["k"], "v", end_of_interval_minutes=5)
    assert (h0, "a", 4.0) in rows(ends)


def test_technology(spark, rows, at):
    h0 = at("01-01 00:00")
    feed = spark.createDataFrame(
        [("A", h0, 1.0), ("A", at("01-01 00:05"), None), ("B", h0, 2.0), ("C", h0, 4.0)],
        f"station string, {TS}, output double",
    )
    stations = spark.createDataFrame([("A", "Wind"), ("B", "Wind")], "station string, Tech string")
    totals = hourly.hourly_technology(feed, stations)
    assert rows(totals) == sorted([(h0, "Wind", 2.5), (h0, "UNKNOWN", 4.0)], key=repr)
    wide = hourly.technology_wide(totals, ["Wind", "Solar", "UNKNOWN"])
    assert rows(wide) == [(h0, 2.5, 0.0, 4.0)]


def test_flow_feed_keeps_parallel_links(spark, rows, at):
    h0 = at("01-01 00:00")
    feed = spark.createDataFrame([(h0, 1.0, 2.0)], f"{TS}, NSW_QLD double, NSW_QLD1 double")
    found = hourly.hourly_flow_wide(feed, ["NSW_QLD", "NSW_QLD1"])
    assert rows(found, "from_to", "from", "to", "flow") == [
        ("NSW_QLD", "NSW", "QLD", 1.0), ("NSW_QLD", "NSW", "QLD", 2.0)
    ]


# --- network


def numbers():
    return {name: node for node, name in NODES.items()}


def flows_frame(spark, data, at):
    """(hour, from, to, flow) rows as named and resolved flows."""
    n = numbers()
    df = spark.createDataFrame(
        [(at(f"01-01 {h:02d}:00"), n[a], n[b], float(f)) for h, a, b, f in data],
        f"{TS}, from_node int, to_node int, flow double",
    )
    return network.resolve_links(network.name_links(df))


def test_recode_is_consistent():
    """Both halves of a path through a virtual node stand for the same physical link."""
    for link, physical in LINK_RECODE.items():
        a, b = link.split("_")
        assert (a in VIRTUAL) != (b in VIRTUAL)
        end = physical.split("_")[1] if a in VIRTUAL else physical.split("_")[0]
        assert end == (b if a in VIRTUAL else a)
    assert len(LINK_RECODE) == 16 and Network().regions == REGIONS


def test_resolved_ends(spark, rows, at):
    flows = flows_frame(spark, [(0, "NSW", "QNI", 5), (0, "QNI", "QLD", 5), (0, "VIC", "NSW", 1)], at)
    assert rows(flows, "link", "from_virtual", "to_virtual", "from_to", "from", "to") == [
        ("NSW_QNI", "NSW", "QNI", "NSW_QLD", "NSW", "QLD"),
        ("QNI_QLD", "QNI", "QLD", "NSW_QLD", "NSW", "QLD"),
        ("VIC_NSW", "VIC", "NSW", "VIC_NSW", "VIC", "NSW"),
    ]
    assert network.link_flows(flows, "period").where("from_to = 'NSW_QLD'").first().flow == 0.0
    # only the half that arrives counts
    assert rows(network.arriving(flows), "link") == [("QNI_QLD",), ("VIC_NSW",)]


def test_arriving_keeps_unknown_ends(spark):
    df = spark.createDataFrame([(None,), ("QNI",), ("NSW",)], "to_virtual string")
    assert network.arriving(df).count() == 2


def test_unknown_node(spark, rows, at):
    df = spark.createDataFrame([(at("01-01 00:00"), 1, 77, 2.0)],
                               f"{TS}, from_node int, to_node int, flow double")
    assert rows(network.name_links(df), "link", "flow") == [(None, 2.0)]


def test_balance(spark, rows, at):
    flows = flows_frame(
        spark, [(0, "NSW", "QNI", 5), (0, "QNI", "QLD", 5), (0, "QLD", "QNI", 2), (0, "QNI", "NSW", 2),
                (0, "VIC", "NSW", 1)], at)
    found = network.region_balance(flows)
    assert rows(found, "REGION", "In", "Out", "Net") == [
        ("NSW", 3.0, 5.0, -2.0), ("QLD", 5.0, 2.0, 3.0), ("VIC", 0.0, 1.0, -1.0)
    ]
    assert found.agg(F.sum("Net")).first()[0] == 0.0
    strict = network.region_balance(flows, strict=True)
    assert rows(strict.where("REGION = 'VIC'"), "In", "Out", "Net") == [(None, 1.0, None)]
    totals = network.region_balance_totals(found, "day")
    assert rows(totals.where("REGION = 'NSW'")) == [("NSW", "01/01/21", 0.003, 0.005, -0.002)]


def test_prices_at_both_ends_and_revenue(spark, rows, at):
    flows = flows_frame(spark, [(0, "VIC", "NSW", 10), (1, "VIC", "NSW", 10), (1, "SA", "VIC", 3)], at)
    prices = spark.createDataFrame(
        [(at("01-01 00:00"), "NSW", 50.0), (at("01-01 00:00"), "VIC", 20.0), (at("01-01 01:00"), "NSW", 9.0)],
        f"{TS}, REGION string, spot_price double",
    )
    priced = network.attach_prices(flows, prices)
    assert rows(priced, "link", "price_from", "price_to") == sorted(
        [("VIC_NSW", 20.0, 50.0), ("VIC_NSW", None, 9.0), ("SA_VIC", None, None)], key=repr)
    # hours without a price are left out; a link without any is 0
    assert rows(network.link_revenue(priced)) == [("SA_VIC", 0.0), ("VIC_NSW", 300.0)]


def test_daily_flows_add_up_to_annual(spark, at):
    flows = flows_frame(spark, [(h, "VIC", "NSW", 1000 * h) for h in range(24)], at)
    day = network.link_flows(flows, "day").first().flow
    assert day == network.link_flows(flows, "period").first().flow == 276.0


# --- energy


def output_frame(spark, data, at):
    return spark.createDataFrame(
        [(at(f"01-01 {h:02d}:00"), r, f, v) for h, r, f, v in data],
        f"{TS}, REGION string, FUEL_TYPE_TEXT string, output double",
    )


def test_output_by_fuel_is_strict(spark, rows, at):
    output = output_frame(spark, [(0, "SA", "Gas", 1.0), (0, "SA", "Gas", None), (0, "SA", "Coal", 2.0)], at)
    assert rows(energy.output_by_fuel(output), "FUEL_TYPE_TEXT", "output") == [
        ("Coal", 2.0), ("Gas", None)
    ]


def test_generation_table(spark, rows, at):
    output = output_frame(
        spark, [(0, "SA", "Gas", 1.23456), (0, "SA", "Gas", 2.0), (0, "SA", "Wind", 0.00005),
                (0, "SA", None, 7.0), (0, None, "Gas", 3.0), (0, "SA", "Tyres", 1.0)], at)
    exogenous = output_frame(spark, [(0, "SA", "Demand", 9.0), (0, "SA", "Wind", 1.0)], at)
    balance = spark.createDataFrame(
        [(at("01-01 00:00"), "SA", -2.0), (at("01-01 01:00"), "VIC", 4.0)], f"{TS}, REGION string, Net double")
    table = energy.generation_table(output, ["Demand", "Gas", "Wind"], exogenous, balance)
    assert table.columns[2:] == ["Demand", "Gas", "Wind", "UNKNOWN", "Imports"]
    assert rows(table.drop("date_time")) == sorted(
        [("SA", 9.0, 3.235, 1.0, 8.0, -2.0), ("UNKNOWN", 0.0, 3.0, 0.0, 0.0, 0.0),
         ("VIC", 0.0, 0.0, 0.0, 0.0, 4.0)], key=repr)
    weights = energy.dispatch_weights(table)
    assert rows(weights, "REGION", "weight") == [("SA", 10.235), ("UNKNOWN", 3.0), ("VIC", 4.0)]


def test_dispatched_and_exogenous_fuel(spark, at):
    output = output_frame(spark, [(0, "SA", "Wind", 1.0), (0, "SA", "Wind", 1.0)], at)
    exogenous = output_frame(spark, [(0, "SA", "Wind", 2.0)], at)
    assert energy.generation_table(output, ["Wind"], exogenous).first().Wind == 4.0
    assert energy.generation_table(output, ["Wind"], strict=True).first().Wind == 2.0
    with pytest.raises(Exception, match="both dispatched and exogenous"):
        energy.generation_table(output, ["Wind"], exogenous, strict=True).collect()


def test_rounding_comes_before_totals(spark, at):
    output = output_frame(spark, [(h, "SA", "Gas", 0.0004) for h in range(10)], at)
    total = energy.generation_totals(energy.generation_table(output, ["Gas"]), "day").first()
    assert total.Gas == 0.0


def test_residual_demand(spark, rows, at):
    demand = spark.createDataFrame([(at("01-01 00:00"), 10.0), (at("01-01 01:00"), 11.0)],
                                   f"{TS}, hourly_demand double")
    tech = spark.createDataFrame([(at("01-01 00:00"), 1.0, 2.0), (at("01-01 02:00"), 1.0, 1.0)],
                                 f"{TS}, Wind double, Hydro double")
    columns = ["Demand", "Wind", "Solar", "Hydro", "Residual"]
    assert rows(energy.residual_demand(demand, tech), *columns) == sorted(
        [(10.0, 1.0, 0.0, 2.0, 7.0), (11.0, 0.0, 0.0, 0.0, 11.0), (None, 1.0, 0.0, 1.0, None)], key=repr)
    assert (10.0, 1.0, 0.0, 2.0, 9.0) in rows(energy.residual_demand(demand, tech, hydro=False), *columns)


# --- prices


def test_mean_price_needs_every_hour(spark, rows, at):
    prices = spark.createDataFrame(
        [(at("01-01 00:00"), "NSW", 10.0), (at("01-01 01:00"), "NSW", 30.0), (at("01-01 00:00"), "QLD", 5.0)],
        f"{TS}, REGION string, spot_price double")
    wide = price.price_wide(prices, ["NSW", "QLD"])
    assert rows(price.mean_price(wide, "day", ["NSW", "QLD"])) == [("01/01/21", 20.0, None)]
    assert rows(price.mean_price(wide, "month", ["NSW", "QLD"], skip_nulls=True)) == [("01", 20.0, 5.0)]


def test_mean_price_over_hours(spark, rows, at):
    """23 of 24 hours make a day unknown also if no region has a row for the other."""
    from gridtally.operators.calendar import expand_hours
    from gridtally.plans.results import Comparison, Facts

    prices = spark.createDataFrame(
        [("Model", at(f"01-0{d} {h:02}:00"), "NSW", 10.0) for d in (1, 2) for h in range(24) if (d, h) != (2, 7)],
        f"side string, {TS}, REGION string, spot_price double")
    hours = expand_hours(spark.sql("SELECT 2021 AS year")).where("date_time < '2021-01-03'")
    found = Comparison(Facts(prices, None, None), [], [], ["NSW"], hours=hours)
    assert rows(found.mean_price("day")) == [("Model", "01/01/21", 10.0), ("Model", "01/02/21", None)]
    assert rows(found.mean_price("month")) == [("Model", "01", None)]


def test_load_weighted_price(spark, rows, at):
    h0, h1 = at("01-01 00:00"), at("01-01 01:00")
    prices = spark.createDataFrame([(h0, "NSW", 10.0), (h1, "NSW", 30.0), (h0, "QLD", 5.0)],
                                   f"{TS}, REGION string, spot_price double")
    weights = spark.createDataFrame([(h0, "NSW", 3.0), (h1, "NSW", 1.0), (h0, "QLD", 2.0), (h1, "QLD", 0.0)],
                                    f"{TS}, REGION string, weight double")
    regions = ["NSW", "QLD"]
    wide = price.price_and_weight_wide(prices, weights, regions)
    assert rows(price.load_weighted_price(wide, "day", regions)) == [("01/01/21", 15.0, None)]
    assert rows(price.load_weighted_price(wide, "period", regions)) == [(15.0, 5.0)]
    zero = price.price_and_weight_wide(prices, weights.withColumn("weight", F.lit(0.0)), regions)
    assert rows(price.load_weighted_price(zero, "period", regions)) == [(None, None)]


# --- model tables


def model_index(spark, hours):
    """Horizon and period of the first hours of the model year, plus warm-up."""
    return [(f"r{11 + (h + 43) // 70}", (h + 43) % 70 + 1) for h in hours]


def test_model_dispatch(spark, rows, at):
    index = model_index(spark, [1, 2]) + [("r1", 1), (None, None)]
    wide = spark.createDataFrame([(k, p, 1.0, 2.0) for k, p in index],
                                 "horizon string, period int, U1 double, U2 double")
    units = spark.createDataFrame([("U1", "SA", "Gas")], "unit string, REGION string, FUEL_TYPE_TEXT string")
    found = model.model_dispatch(wide, units, 2021)
    assert rows(found, "date_time", "unit", "output", "REGION") == sorted(
        [(at(f"01-01 0{h}:00"), u, v, r) for h in (0, 1) for u, v, r in (("U1", 1.0, "SA"), ("U2", 2.0, None))],
        key=repr)


def test_model_price_drops_other_columns(spark, rows):
    (k, p), = model_index(spark, [1])
    wide = spark.createDataFrame([(k, p, 1.0, None, 3.0)],
                                 "horizon string, period int, `1` double, `2` double, total double")
    keys = spark.createDataFrame([("NSW", 1), ("QLD", 2), (None, 3)], "REGION string, REGION_KEY int")
    assert rows(model.model_price(wide, keys, 2021), "REGION", "spot_price") == [("NSW", 1.0), ("QLD", None)]


def test_exogenous_series(spark, rows, at):
    zonal = spark.createDataFrame(
        [(t, 1.0 * t, 0.0, 0.0, 0.0, 1) for t in (720, 721, 9480, 9481)] + [(721, 5.0, 0.0, 0.0, 0.0, 9)],
        "Time int, Demand double, Wind double, Solar double, Hydro double, REGION_KEY int")
    keys = spark.createDataFrame([("NSW", 1)], "REGION string, REGION_KEY int")
    found = model.exogenous_series(zonal, keys, 2021)
    assert found.count() == 12
    assert rows(found.where("FUEL_TYPE_TEXT = 'Demand'"), "date_time", "REGION", "output") == sorted(
        [(at("01-01 00:00"), "NSW", 721.0), (at("12-31 23:00"), "NSW", 9480.0), (at("01-01 00:00"), None, 5.0)],
        key=repr)


def test_storage(spark, rows, at):
    h = at("01-01 00:00")
    charge = spark.createDataFrame([(h, "B1", 1.23456), (h, "B2", 0.0), (h, "B3", 0.00005), (h, "B4", 2.0)],
                                   f"{TS}, unit string, charge double")
    discharge = spark.createDataFrame([(h, "B1", 0.5), (h, "B2", 3.0), (h, "B3", 0.0)],
                                      f"{TS}, unit string, discharge double")
    found = model.storage_net_output(charge, discharge)
    assert rows(found, "unit", "charge", "discharge", "output") == [
        ("B1", 1.235, 0.5, -0.7350000000000001), ("B2", 0.0, 3.0, 3.0), ("B4", 2.0, None, None)
    ]


def test_region_key(spark, rows):
    units = spark.createDataFrame([("NSW", 1), ("NSW", 1), ("QLD", 2)], "REGION string, REGION_KEY int")
    assert rows(model.region_key(units)) == [("NSW", 1), ("QLD", 2)]


# --- plants


def test_plant_table(spark, rows):
    assert len(plants.PLANT_COLUMNS) == len(set(plants.PLANT_COLUMNS)) == 42
    ids = "STATION string, DUID string, REGION string, REGION_KEY int"
    specs = spark.createDataFrame(
        [("S", "A", "NSW", 1, 2000, 2030), ("S", "B", "NSW", 1, 2022, 2030), ("S", "C", "NSW", 1, 1990, 2020),
         ("S", "D", None, None, 2021, 2021), ("S", "E", "SA", 3, 2000, 2030)],
        f"{ids}, AvaliableDate int, ExpectedRetirementYear int")
    capacity = spark.createDataFrame(
        [("S", "A", "NSW", 1, 10.0, 11.0), ("S", "D", None, None, 40.0, 41.0)],
        f"{ids}, `Cap 2021` double, `Cap 2022` double")
    cost = spark.createDataFrame(
        [("S", "A", "NSW", 1, 1.0, 2.0), ("S", "D", None, None, 4.0, 5.0), ("S", "E", "SA", 3, 6.0, 7.0)],
        f"{ids}, `SRMC 2021` double, `SRMC 2022` double")
    found = plants.plant_table(specs, capacity, cost, 2021, ["DUID", "CAPACITY", "VARCOST"])
    # null keys match; without capacity there is no year to match a cost
    assert rows(found) == [("A", 10.0, 1.0), ("D", 40.0, 4.0), ("E", None, None)]
