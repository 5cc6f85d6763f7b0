"""Readers, writers, staging and whole workflows on small files."""

import csv
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtally.operators import model
from gridtally.operators.calendar import HorizonMap
from gridtally.operators.hourly import (
    hourly_demand,
    hourly_flow_wide,
    hourly_price_wide,
    technology_totals,
)
from gridtally.operators.network import REGIONS
from gridtally.plans.backtest import actual_facts, both_sides, model_facts
from gridtally.plans.demand import demand_tables, horizon_matrix, hourly_technology_wide_feed
from gridtally.plans.results import Comparison, write_results
from gridtally.plans.workflows import (
    MarketYear,
    compare,
    prepare_demand,
    prepare_plants,
    storage_tables,
)
from gridtally.sources import feeds, files, layer, model_files
from gridtally.sources.staging import SETTING, stage, staging_folder


def write_csv(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows(lines)
    return str(path)


def stamps(n, start=datetime(2021, 1, 1)):
    return [(start + timedelta(minutes=5 * i)).isoformat(" ") for i in range(n)]


@pytest.fixture(scope="module")
def feed_files(tmp_path_factory):
    """Two hours of feeds: station A reads 12, station B (second piece only) reads 24."""
    root = tmp_path_factory.mktemp("feeds")
    t = stamps(24)
    return {
        "root": str(root),
        "meta": write_csv(root / "Metadata_2021.csv",
                          [["x", " CO2E_ENERGY_SOURCE"], ["A", "Wind"], ["B", "Coal"], ["C", ""]]),
        "demand": [
            write_csv(root / f"Demand_{r}1_2021.csv", [["t", "d", "p"], *[[s, v, 0] for s in t]])
            for r, v in (("NSW", 100), ("SA", 50))
        ],
        "generation": [
            write_csv(root / "Generation_NSW1_2021_Q1.csv",
                      [["DateTime", "A.MW", "C.MW"], *[[s, 12, ""] for s in t[:12]]]),
            write_csv(root / "Generation_NSW1_2021_Q2.csv",
                      [["DateTime", "B.MW", "A.MW"], *[[s, 24, 12 if i % 2 else ""]
                                                       for i, s in enumerate(t[12:])]]),
        ],
        "price": write_csv(
            root / "Price_2021.csv",
            [["DateTime", *[f"{r}1.Price_5min" for r in ("NSW", "QLD", "SA", "TAS", "VIC")]],
             *[[s, 10, 20, 30, 40, 50] for s in t]]),
        "flow": write_csv(
            root / "Flow_2021.csv",
            [["DateTime", "a", "b", "c", "d", "e", "f"], *[[s, 1, 2, 3, 4, 5, 6] for s in t]]),
    }


@pytest.fixture(scope="module")
def model_folder(tmp_path_factory):
    """Two modelled hours and one of warm-up."""
    root = tmp_path_factory.mktemp("model")
    index = [["r1", 1], ["r11", 45], ["r11", 46]]
    plants = ["STATION", "DUID", "REGION", "REGION_KEY", "CAPACITY", "FUEL_TYPE_TEXT",
              "INITIAL_ENERGY_STOCK_IN_DAMS", "HYDRO_DAM_CAPACITY", "VARCOST", "COMPLETE"]
    write_csv(root / "INPUT_DATA_GENERATION.csv",
              [plants, ["One", "U1", "NSW", 1, 100, "Coal", "", "", 5, 1],
               ["Two", "U2", "QLD", 2, 50, "Gas", "", "", 9, 1]])
    for key, demand in ((1, 70), (2, 40)):
        write_csv(root / f"INPUT_DATA_ZONAL_{key}.csv",
                  [["Time", "Demand", "Wind", "Solar", "Hydro"],
                   *[[t, demand, 1, 0, 0] for t in (720, 721, 722)]])
    write_csv(root / "Outputs_Electricity_dispatch.csv", [["", "", "U1", "U2"], *[[*i, 60, 20] for i in index]])
    write_csv(root / "SystemMarginalPrice.csv", [["", "", "1", "2", "9"], *[[*i, 11, 22, 0] for i in index]])
    write_csv(root / "IC_Flows_Hourly.csv", [["", "", 1, 6], ["", "", 6, 2], *[[*i, 8, ""] for i in index[:2]],
                                  [*index[2], 8, 8]])
    write_csv(root / "Outputs_Charge_Units.csv", [["", "", "U1", "U2"], *[[*i, 3, 0] for i in index]])
    write_csv(root / "Outputs_Discharge_Units.csv", [["", "", "U1", "U2"], *[[*i, 1, 0] for i in index]])
    write_csv(root / "Outputs_Storage_Level.csv", [["", "", "U1", "U2"], *[[*i, 9, 8] for i in index]])
    return root


def test_storage_tables(spark, rows, model_folder):
    tables = storage_tables(spark, str(model_folder), 2021)
    h0, h1 = datetime(2021, 1, 1), datetime(2021, 1, 1, 1)
    assert rows(tables["Charge_Discharge"], "date_time", "unit", "output", "REGION") == [
        (h0, "U1", -2.0, "NSW"), (h1, "U1", -2.0, "NSW")]
    assert tables["Storage_Level"].count() == 4


def test_station_metadata(spark, rows, feed_files):
    found = feeds.read_station_metadata(spark, feed_files["meta"])
    assert rows(found, "station", "Tech") == [("A", "Wind"), ("B", "Coal"), ("C", None)]


def test_demand_feed(spark, rows, feed_files):
    found = feeds.read_demand_feed(spark, feed_files["demand"])
    assert dict(found.dtypes) == {"date_time": "timestamp_ntz", "Demand": "double", "REGION": "string"}
    assert rows(found.groupBy("REGION").agg(F.sum("Demand"))) == [("NSW", 2400.0), ("SA", 1200.0)]


def test_generation_pieces_are_stacked_by_name(spark, rows, feed_files):
    feed = feeds.read_generation_feed(spark, feed_files["generation"])
    assert feed.columns[0] == "date_time" and set(feed.columns[1:]) == {"A", "B", "C", "REGION"}
    stations = feeds.read_station_metadata(spark, feed_files["meta"])
    found = hourly_technology_wide_feed(feed, stations)
    h0, h1 = datetime(2021, 1, 1), datetime(2021, 1, 1, 1)
    assert rows(found, "date_time", "REGION", "Tech", "output") == sorted(
        [(h0, "NSW", "Wind", 12.0), (h1, "NSW", "Wind", 6.0), (h1, "NSW", "Coal", 24.0)], key=repr)


def test_duplicate_stations_are_refused(spark, tmp_path):
    path = write_csv(tmp_path / "Generation_SA1.csv", [["DateTime", "A.x", "A.y"], [stamps(1)[0], 1, 2]])
    with pytest.raises(ValueError, match="same station"):
        feeds.read_generation_feed(spark, path)


def test_same_columns_in_another_order(spark, rows, tmp_path):
    a = write_csv(tmp_path / "a.csv", [["x", "y"], [1, 2]])
    b = write_csv(tmp_path / "b.csv", [["y", "x"], [3, 4]])
    assert rows(files.read_any(spark, [a, b]), "x", "y") == [("1", "2"), ("4", "3")]


def test_parquet_pieces(spark, rows, tmp_path):
    spark.range(1).select(F.lit(1.0).alias("A")).write.parquet(str(tmp_path / "p/q=1"))
    spark.range(1).select(F.lit(2.0).alias("B")).write.parquet(str(tmp_path / "p/q=2"))
    found = files.read_any(spark, str(tmp_path / "p"), "parquet")
    assert rows(found, "A", "B") == [(1.0, None), (None, 2.0)]


def test_price_and_flow_feeds(spark, feed_files):
    assert feeds.read_price_feed(spark, feed_files["price"]).columns == [
        "date_time", "NSW", "QLD", "SA", "TAS", "VIC"]
    flow = feeds.read_flow_feed(spark, feed_files["flow"])
    assert flow.columns[1:] == ["NSW_QLD", "NSW_QLD1", "TAS_VIC", "VIC_SA", "VIC_SA1", "VIC_NSW"]


def test_finding_files(spark, model_folder):
    found = files.matching_files(spark, str(model_folder), files.ZONAL_FILES)
    assert found.count() == 2
    assert files.only_file(spark, str(model_folder), "*Electricity_dispatch*").endswith("Outputs_Electricity_dispatch.csv")
    with pytest.raises(ValueError, match="several"):
        files.only_file(spark, str(model_folder), files.ZONAL_FILES)
    with pytest.raises(ValueError, match="no file"):
        files.only_file(spark, str(model_folder), "nothing*")


def test_model_files(spark, rows, model_folder):
    body, links = model_files.read_model_flows(spark, str(model_folder / "IC_Flows_Hourly.csv"))
    assert rows(links) == [("1", 1, 6), ("2", 6, 2)]
    found = model.model_flow(body, links, 2021)
    assert rows(found, "from_node", "to_node", "flow") == [(1, 6, 8.0), (1, 6, 8.0), (6, 2, 0.0), (6, 2, 8.0)]
    zonal = model_files.read_zonal(spark, str(model_folder))
    assert rows(zonal.groupBy("REGION_KEY").agg(F.sum("Demand"))) == [(1, 210.0), (2, 120.0)]
    units = model_files.read_unit_metadata(spark, str(model_folder / "INPUT_DATA_GENERATION.csv"))
    assert dict(units.dtypes)["CAPACITY"] == "double" and len(units.columns) == 9


def test_assumptions(spark, tmp_path):
    keys = ["STATION", "DUID", "REGION", "REGION_KEY"]
    specs = write_csv(tmp_path / "specs.csv", [[*keys, "AvaliableDate", "ExpectedRetirementYear", "COMPLETE"],
                                               ["S", "A", "NSW", 1, 2000, 2030, 1]])
    cap = write_csv(tmp_path / "cap.csv", [[*keys, "Cap 2021"], ["S", "A", "NSW", 1, 10]])
    cost = write_csv(tmp_path / "cost.csv", [[*keys, "SRMC 2021"], ["S", "A", "NSW", 1, 3]])
    from gridtally.operators.plants import plant_table

    tables = model_files.read_assumptions(spark, specs, cap, cost)
    found = plant_table(*tables, 2021, ["DUID", "CAPACITY", "VARCOST", "COMPLETE"])
    assert [tuple(r) for r in found.collect()] == [("A", 10.0, 3.0, 1.0)]
    layer.write_plants(found, str(tmp_path / "plants"))
    assert spark.read.parquet(str(tmp_path / "plants")).count() == 1
    with pytest.raises(ValueError, match="lacks"):
        model_files.read_assumptions(spark, specs, write_csv(tmp_path / "bad.csv", [["a"], [1]]), cost)


def test_hourly_layer(spark, rows, tmp_path):
    path = str(tmp_path / "price")
    data = [(datetime(y, 1, 1, h), r, float(h)) for y in (2020, 2021) for h in range(3) for r in ("NSW", "SA")]
    table = spark.createDataFrame(data, "date_time timestamp_ntz, REGION string, spot_price double")
    layer.write_hourly(table, path)
    assert rows(layer.read_hourly(spark, path), "date_time", "REGION", "spot_price") == sorted(data, key=repr)
    some = layer.read_hourly(spark, path, [2021], ["SA"])
    assert some.count() == 3
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2021" in plan.split("PartitionFilters")[1]
    # writing one year again leaves the other alone
    layer.write_hourly(table.where("date_time >= '2021-01-01' AND REGION = 'SA'"), path)
    assert spark.read.parquet(path).count() == len(data)


def demand_file(path, months, region="NSW", step=5, value=1.0, skip=()):
    lines = ["DateTime,Demand,Predispatch"]
    for month in months:
        stamp = datetime(2021, month, 1)
        while stamp.month == month:
            if stamp not in skip:
                lines.append(f"{stamp:%Y-%m-%d %H:%M:%S},{value},0")
            stamp += timedelta(minutes=step)
    path.write_text("\n".join(lines) + "\n")


def test_layer_grows_by_the_files_that_are_new(spark, tmp_path):
    raw, hourly = tmp_path / "raw", tmp_path / "hourly"
    raw.mkdir()

    def months(market, *regions):
        found = market.demand(list(regions) or None).groupBy(F.month("date_time").alias("m")).count().collect()
        return {r.m: r["count"] for r in found}

    def builds():
        return len(list((hourly / "Demand" / "manifest").glob("part-*.parquet")))

    market = MarketYear(spark, str(raw), str(hourly), 2021)
    demand_file(raw / "Demand_NSW1_2021_1.csv", [1, 2, 3])
    assert months(market) == {1: 744, 2: 672, 3: 744} and builds() == 1
    # a region that no file has costs no second build
    assert months(market, "NSW", "TAS") == {1: 744, 2: 672, 3: 744} and builds() == 1
    for k in (2, 3, 4):
        demand_file(raw / f"Demand_NSW1_2021_{k}.csv", range(3 * k - 2, 3 * k + 1))
    assert len(months(market)) == 12 and sum(months(market).values()) == 8760 and builds() == 2
    days = market.coverage("Demand")
    assert days.count() == 365 and days.where("missing > 0 OR repeated > 0").count() == 0
    assert MarketYear(spark, str(raw), str(hourly), 2021, gaps="refuse").demand().count() == 8760
    # a file that changed takes the place of its earlier rows
    demand_file(raw / "Demand_NSW1_2021_2.csv", [4, 5], value=7.5)
    found = {r.m: r.v for r in market.demand().groupBy(F.month("date_time").alias("m")).agg(F.avg("hourly_demand").alias("v")).collect()}
    assert builds() == 3 and found[4] == 7.5 and found[1] == 1.0 and 6 not in found
    with pytest.raises(ValueError, match="NSW 8640 missing, 0 repeated, first on 2021-06-01"):
        MarketYear(spark, str(raw), str(hourly), 2021, gaps="refuse").demand()
    # what the manifest does not list is not seen: a write that was cut off
    cut = hourly / "Demand/data/build=cut/year=2021/REGION=NSW"
    cut.mkdir(parents=True)
    (cut / "part-0.parquet").write_bytes(b"half a file")
    assert market.demand().count() == 8760 - 720
    # without raw files the table is served as it is
    assert MarketYear(spark, "/nowhere", str(hourly), 2021).demand().count() == 8760 - 720
    with pytest.raises(ValueError, match="no Demand file of 1999"):
        MarketYear(spark, str(raw), str(hourly), 1999).demand()
    # a file without an hour of its year adds none, and is not read again
    demand_file(raw / "Demand_SA1_2022_2021.csv", [12])
    other = MarketYear(spark, str(raw), str(hourly), 2022)
    for _ in range(2):
        with pytest.raises(ValueError, match="no hours of 2022"):
            other.demand()
    assert builds() == 4


def test_stamps_at_the_end_of_an_interval(spark, rows, tmp_path):
    lines = [f"2021-01-01 {h:02}:{m:02}:00,{h * 60 + m},0" for h in range(3) for m in range(0, 60, 5)]
    (tmp_path / "Demand_SA1_2021.csv").write_text("DateTime,Demand,Predispatch\n" + "\n".join(lines[1:]) + "\n")
    market = MarketYear(spark, str(tmp_path), str(tmp_path / "hourly"), 2021, end_of_interval_minutes=5)
    found = rows(market.demand(), "date_time", "hourly_demand")
    # 00:05 to 01:00 are the readings of the hour from 00:00
    assert found[0] == (datetime(2021, 1, 1, 0), sum(range(5, 65, 5)) / 12)
    assert [t for t, _ in found] == [datetime(2021, 1, 1, h) for h in range(3)]
    first = market.coverage("Demand").orderBy("day").first()
    assert (first.expected, first.readings, first.missing) == (288, 35, 253)


def test_staging(spark, rows):
    df = spark.range(5)
    staged = stage(df, "numbers")
    assert rows(staged) == rows(df)
    assert spark.conf.get(SETTING) == staging_folder(spark)
    assert (staging_folder(spark) + "/numbers-") in staged.inputFiles()[0]
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()


def test_demand_workflow(spark, rows, feed_files, tmp_path):
    demand = hourly_demand(feeds.read_demand_feed(spark, feed_files["demand"]), ["REGION"])
    feed = feeds.read_generation_feed(spark, feed_files["generation"])
    stations = feeds.read_station_metadata(spark, feed_files["meta"])
    technologies = hourly_technology_wide_feed(feed, stations)
    reserves = spark.createDataFrame(
        [("NSW", 721, 3.0, 4.0)],
        "REGION string, t int, OPERATING_RESERVE_UP double, OPERATING_RESERVE_DOWN double")
    tables = demand_tables(demand, technologies, reserves)
    entry = tables["DataEntry_1"]
    # the first hours come back after the padding
    assert rows(entry.where("REGION = 'NSW'"), "t", "Demand", "Wind", "Solar", "Residual_demand",
                "OPERATING_RESERVE_UP") == sorted(
        [(1, 100.0, 12.0, 0.0, 88.0, None), (2, 100.0, 6.0, 0.0, 94.0, None),
         (721, 100.0, 12.0, 0.0, 88.0, 3.0), (722, 100.0, 6.0, 0.0, 94.0, None)], key=repr)
    assert rows(tables["DEMAND"].where("REGION = 'NSW'"), "horizon", "period", "value") == sorted(
        [(1, 1, 88.0), (1, 2, 94.0), (10, 91, 88.0), (10, 92, 94.0), (11, 21, 88.0), (11, 22, 94.0)],
        key=repr)
    up = tables["OPERATING_RESERVE_UP"].where("value IS NOT NULL")
    assert rows(up, "horizon", "period", "value") == [(10, 91, 3.0), (11, 21, 3.0)]
    matrix = horizon_matrix(tables["DEMAND"], 11)
    assert matrix.columns == ["REGION", "year", "period", *[str(k) for k in range(1, 12)]]
    layer.write_zonal(tables, str(tmp_path / "zonal"))
    back = spark.read.parquet(str(tmp_path / "zonal/DEMAND"))
    assert back.count() == tables["DEMAND"].count()


@pytest.fixture(scope="module")
def backtest(spark, feed_files, model_folder):
    folder = model_folder
    units = model_files.read_unit_metadata(spark, str(folder / "INPUT_DATA_GENERATION.csv"))
    with pytest.warns(UserWarning, match="24 hours after the padding"):
        modelled = model_facts(
            model_files.read_model_table(spark, str(folder / "Outputs_Electricity_dispatch.csv")),
            model_files.read_model_table(spark, str(folder / "SystemMarginalPrice.csv")),
            *model_files.read_model_flows(spark, str(folder / "IC_Flows_Hourly.csv")),
            model_files.read_zonal(spark, str(folder)),
            units, 2021, HorizonMap(),
        )
    stations = feeds.read_station_metadata(spark, feed_files["meta"])
    actual = actual_facts(
        hourly_technology_wide_feed(feeds.read_generation_feed(spark, feed_files["generation"]), stations),
        hourly_price_wide(feeds.read_price_feed(spark, feed_files["price"]), REGIONS),
        hourly_flow_wide(feeds.read_flow_feed(spark, feed_files["flow"])),
    )
    facts = both_sides(modelled, actual)
    links = ["NSW_QLD", "TAS_VIC", "VIC_SA", "VIC_NSW"]
    return Comparison(facts, ["Demand", "Wind", "Coal", "Gas"], links)


def test_backtest(spark, rows, backtest):
    tree = backtest.tree()
    assert len(tree) == 40
    assert rows(tree["Model.Price.AvPrice"]) == [(11.0, 22.0, None, None, None)]
    assert rows(tree["Actual.Price.DailyAvPrice"]) == [("01/01/21", 10.0, 20.0, 30.0, 40.0, 50.0)]
    # 8 MW in one hour reaches QLD; parallel links of the feed add up
    assert rows(tree["Model.IC_Flows.DailyFlows"]) == [("01/01/21", 0.008, None, None, None)]
    assert rows(tree["Actual.IC_Flows.DailyFlows"]) == [("01/01/21", 0.006, 0.006, 0.018, 0.012)]
    net = tree["Actual.IC_Flows.AnnualFIO"]
    assert rows(net, "REGION", "annual_net") == [
        ("NSW", 0.006), ("QLD", 0.006), ("SA", 0.018), ("TAS", -0.006), ("VIC", -0.024)]
    generation = rows(tree["Model.Gen_Dis.DATA"].where("date_time = '2021-01-01 01:00:00'").drop("date_time"))
    assert generation == [("NSW", 70.0, 1.0, 60.0, 0.0, 0.0, -8.0), ("QLD", 40.0, 1.0, 0.0, 20.0, 0.0, 8.0)]
    assert rows(tree["Model.IC_Flows.Revenue"]) == [("QNI_QLD", 88.0)]
    weighted = rows(tree["Model.Price.Daily_LW_AvPrice"])
    assert weighted == [("01/01/21", 11.0, 22.0, None, None, None)]


def test_backtest_from_staged_facts(spark, rows, backtest, tmp_path):
    from dataclasses import replace

    staged = replace(backtest, facts=backtest.facts.staged())
    wanted, found = backtest.summary(), staged.summary()
    assert rows(found) == rows(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan
    write_results({k: v for k, v in staged.tree().items() if "Annual" in k}, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "Actual/Gen_Dis/AnnualGen"))
    assert back.count() == staged.tree()["Actual.Gen_Dis.AnnualGen"].count()
    balance = staged.balance
    write_results({"IC_Flows.FlowInOut": balance}, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "IC_Flows/FlowInOut"))
    assert rows(back, *balance.columns) == rows(balance)


def test_scenarios_ride_along(spark, rows, backtest):
    """A further key gives each scenario the tables it would have on its own."""
    from dataclasses import fields, replace

    facts = backtest.facts
    twice = {
        f.name: getattr(facts, f.name).withColumn("scenario", F.explode(F.array(F.lit("a"), F.lit("b"))))
        for f in fields(facts)
    }
    both = replace(backtest, facts=type(facts)(**twice), keys=("side", "scenario"))
    alone = rows(backtest.summary())
    found = both.summary()
    for scenario in ("a", "b"):
        one = found.where(F.col("scenario") == scenario).drop("scenario")
        assert rows(one) == alone


def test_workflows(spark, rows, feed_files, model_folder, backtest, tmp_path):
    market = MarketYear(spark, feed_files["root"], str(tmp_path / "hourly"), 2021)
    tables = prepare_demand(market, str(tmp_path / "zonal"), ["NSW"])
    assert rows(tables["DataEntry_1"].select("REGION").distinct()) == [("NSW",)]
    assert spark.read.parquet(str(tmp_path / "zonal/DEMAND")).count() == 6
    with pytest.warns(UserWarning, match="padding"):
        found = compare(market, str(model_folder), backtest.fuels, backtest.links)
    assert rows(found.summary()) == rows(backtest.summary())
    # the second time raw files are not needed
    again = MarketYear(spark, "/nowhere", str(tmp_path / "hourly"), 2021)
    assert rows(again.prices()) == rows(market.prices())
    with pytest.raises(Exception, match="Price|nowhere"):
        MarketYear(spark, feed_files["root"], str(tmp_path / "hourly"), 1999).prices()


def test_compare_over_the_whole_year(spark, feed_files, model_folder, backtest, tmp_path):
    market = MarketYear(spark, feed_files["root"], str(tmp_path / "hourly"), 2021)
    with pytest.warns(UserWarning, match="padding"):
        found = compare(market, str(model_folder), backtest.fuels, backtest.links, whole_year=True)
    for table in (found.mean_price("day"), found.load_weighted_price("day")):
        days = table.groupBy("side").agg(F.count("*").alias("n"), F.count("NSW").alias("known")).collect()
        assert {(r.side, r.n, r.known) for r in days} == {("Model", 365, 0), ("Actual", 365, 0)}


def test_prepare_plants(spark, tmp_path):
    from gridtally.operators.plants import PLANT_COLUMNS, PLANT_KEYS

    others = [c for c in PLANT_COLUMNS if c not in (*PLANT_KEYS, "CAPACITY", "VARCOST")]
    ids = ["S", "A", "NSW", 1]
    specs = write_csv(
        tmp_path / "specs.csv",
        [[*PLANT_KEYS, "AvaliableDate", "ExpectedRetirementYear", *others],
         [*ids, 2000, 2030, *range(len(others))], ["S", "B", "NSW", 1, 2025, 2030, *others]])
    cap = write_csv(tmp_path / "cap.csv", [[*PLANT_KEYS, "Cap 2021", "Cap 2022"], [*ids, 10, 11]])
    cost = write_csv(tmp_path / "cost.csv", [[*PLANT_KEYS, "SRMC_2021"], [*ids, 3]])
    prepare_plants(spark, specs, cap, cost, 2021, str(tmp_path / "plants"))
    back = spark.read.parquet(str(tmp_path / "plants"))
    assert back.columns == PLANT_COLUMNS
    assert [(r.DUID, r.CAPACITY, r.VARCOST) for r in back.collect()] == [("A", 10.0, 3.0)]


def test_region_keys_of_several_digits(spark, tmp_path):
    for key in range(1, 13):
        (tmp_path / f"INPUT_DATA_ZONAL_{key}.csv").write_text("Time,Demand,Wind,Solar,Hydro\n1,1,2,3,4\n")
    found = model_files.read_zonal(spark, str(tmp_path))
    assert sorted(r.REGION_KEY for r in found.collect()) == list(range(1, 13))
    (tmp_path / "INPUT_DATA_ZONAL_X.csv").write_text("Time,Demand,Wind,Solar,Hydro\n1,1,2,3,4\n")
    with pytest.raises(Exception, match="no REGION_KEY in the file name"):
        model_files.read_zonal(spark, str(tmp_path)).collect()


def test_text_that_is_no_number_is_an_error(spark, rows):
    df = spark.createDataFrame([("1.5", "BLACK"), ("NA", None)], "v string, fuel string")
    assert rows(files.typed(df, {"fuel": "string"})) == [(1.5, "BLACK"), (None, None)]
    with pytest.raises(Exception, match="fuel is to be double, but holds BLACK"):
        files.typed(df, {}).collect()


def test_a_station_with_two_technologies_is_an_error(spark, at, rows):
    hours = spark.createDataFrame([(at("01-01 00:00"), "A1", 3.0)], "date_time timestamp_ntz, station string, output double")
    twice = spark.createDataFrame([("A1", "Coal"), ("A1", "Coal")], "station string, Tech string")
    assert rows(technology_totals(hours, twice), "Tech", "output") == [("Coal", 3.0)]
    differing = spark.createDataFrame([("A1", "Coal"), ("A1", "Gas")], "station string, Tech string")
    with pytest.raises(Exception, match="more than one row for station A1"):
        technology_totals(hours, differing).collect()


def test_flows_of_many_runs(spark, rows, tmp_path):
    """Files with columns in different orders, known by two header rows each."""
    index = [["r11", 45], ["r11", 46]]
    write_csv(tmp_path / "a_IC_Flows_Hourly.csv", [["", "", 1, 2], ["", "", 2, 5], *[[*i, 3, 4] for i in index]])
    write_csv(tmp_path / "b_IC_Flows_Hourly.csv", [["", "", 2, 1, "5.0"], ["", "", 5, 2, 4], *[[*i, 7, "", "NA"] for i in index]])
    found = model_files.read_flow_runs(spark, str(tmp_path), run=r"^(.)_")
    assert rows(found.where("period = 45").drop("period", "horizon"), "run", "from_node", "to_node", "flow") == sorted(
        [("a", 1, 2, 3.0), ("a", 2, 5, 4.0), ("b", 2, 5, 7.0), ("b", 1, 2, None), ("b", 5, 4, None)], key=repr)
    long = model.stamped_flow(found, 2021)
    assert rows(long.groupBy("run").agg(F.sum("flow"), F.count("flow"))) == [("a", 14.0, 4), ("b", 14.0, 6)]


@pytest.mark.parametrize("lines, problem", [
    ([["", "", 1], ["r11", 45, 3]], "not two header rows"),
    ([["", "", 1], ["", "", 2], ["r11", 45, 3, 4]], "a cell beyond"),
    ([["", "", 1], ["", "", 2], ["r11", 45, "x"]], "flow is to be double"),
])
def test_flow_files_that_do_not_fit(spark, tmp_path, lines, problem):
    write_csv(tmp_path / "a_IC_Flows_Hourly.csv", lines)
    with pytest.raises(Exception, match=problem):
        model_files.read_flow_runs(spark, str(tmp_path), run=r"^(.)_").collect()


def test_reserves_from_files(spark, tmp_path):
    path = write_csv(tmp_path / "reserves.csv", [
        ["t", "OPERATING_RESERVE_DOWN", "OPERATING_RESERVE_UP", "REGION"], [1, 2, 3, "NSW"], [2, "NA", 4, "NSW"]])
    found = model_files.read_reserves(spark, path).collect()
    assert [tuple(r) for r in found] == [("NSW", 1, 3.0, 2.0), ("NSW", 2, 4.0, None)]


def test_results_in_total_order(spark, tmp_path):
    """Ranges of time of the files do not overlap, though one hour holds most rows."""
    hours = spark.range(4000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'Model' ELSE 'Actual' END AS side",
        "timestamp_ntz'2021-01-01' + make_dt_interval(0, CAST(CASE WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS int)) AS date_time",
        "concat('R', id % 5) AS REGION", "CAST(id AS double) AS value",
    )
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        counted = write_results({"A.DATA": hours, "A.NONE": hours.where("value < 0")}, str(tmp_path), total_order=True)
    finally:
        spark.conf.set(setting, before)
    assert counted["A.DATA"] == {"rows": 4000, "first": datetime(2021, 1, 1), "last": datetime(2021, 1, 3, 1)}
    assert counted["A.NONE"].get("rows", 0) == 0
    back = spark.read.parquet(str(tmp_path / "A/DATA"))
    assert back.count() == 4000
    ranges = back.groupBy("side", F.col("_metadata.file_path").alias("file")).agg(
        F.min("date_time").alias("first"), F.max("date_time").alias("last")).orderBy("side", "first", "last").collect()
    assert len(ranges) > 4
    for one, other in zip(ranges, ranges[1:]):
        assert one.side != other.side or one.last <= other.first


def test_labels_found_in_the_data(spark):
    from gridtally.operators.reshape import found_labels

    df = spark.sql("SELECT * FROM VALUES ('b'), ('a'), ('b'), (null) AS t(link)")
    assert found_labels(df, "link", at_most=2) == ["a", "b"]
    assert found_labels(df.where("false"), "link") == []
    with pytest.raises(ValueError, match="more than 1 labels"):
        found_labels(df, "link", at_most=1)
