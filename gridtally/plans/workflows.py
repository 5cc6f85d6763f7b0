"""The workflows from files to files.

Raw feeds of a year lie in one folder, named ``Metadata_<year>``, ``Demand_<region>1_<year>``,
``Generation_<region>1_<year>_<piece>``, ``Price_<year>`` and ``Flow_<year>``. The hourly tables
made from them are kept in a second folder, which a later call extends by the files that are new.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.calendar import HorizonMap, expand_hours, hour_of_timestamp
from gridtally.operators.completeness import slot_days
from gridtally.operators.hourly import hourly_demand, hourly_flow_wide, hourly_price_wide
from gridtally.operators.model import stamped_long, storage_net_output
from gridtally.operators.network import REGIONS, Network
from gridtally.operators.plants import plant_table
from gridtally.plans.backtest import actual_facts, both_sides, model_facts
from gridtally.plans.demand import demand_tables, hourly_technology_wide_feed
from gridtally.plans.results import Comparison
from gridtally.sources import feeds, files, layer, model_files


class MarketYear:
    """Hourly tables of a market year, kept up to date with the raw feeds, file by file.

    Without raw files of the year the tables are served as they are. ``end_of_interval_minutes`` is the
    length of an interval if stamps name its end. ``gaps`` says what happens if a feed lacks slots of
    the year, or has some twice: ``report`` leaves it to the caller, who asks :meth:`coverage`;
    ``refuse`` makes it an error.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: str,
        hourly: str,
        year: int,
        end_of_interval_minutes: int = 0,
        gaps: str = "report",
        step_minutes: int = 5,
    ) -> None:
        if gaps not in ("report", "refuse"):
            raise ValueError("gaps must be report or refuse")
        self.spark, self.raw, self.hourly, self.year = spark, raw, hourly.rstrip("/"), year
        self.shift, self.gaps, self.step_minutes = end_of_interval_minutes, gaps, step_minutes

    def _listed(self, name: str) -> DataFrame:
        return files.listed_files(self.spark, self.raw, f"{name}_*{self.year}*")

    def _table(self, name: str) -> layer.HourlyTable:
        return layer.HourlyTable(self.spark, f"{self.hourly}/{name}")

    def _hourly(
        self,
        name: str,
        feed_of: Callable[[list[str]], DataFrame],
        hours_of: Callable[[DataFrame], DataFrame],
        keys: Sequence[str] = (),
        regions: Sequence[str] | None = None,
    ) -> DataFrame:
        def build(paths: list[str]) -> layer.Built:
            feed = feed_of(paths)
            slots = slot_days(feed, [*keys, "source"], self.step_minutes, end_of_interval_minutes=self.shift)
            return layer.Built(hours_of(feed), slots)

        table, found = self._table(name), self._listed(name)
        built = table.update(found, self.year, build)
        if not built and table.manifest().where(F.col("year") == self.year).isEmpty():
            raise ValueError(f"no {name} file of {self.year} in {self.raw}")
        if self.gaps == "refuse":
            self._refuse_gaps(name)
        return table.read(self.year, regions)

    def coverage(self, name: str) -> DataFrame:
        """``REGION`` (if the feed has it), ``day, expected, readings, missing, repeated`` of a feed:
        ``Demand``, ``Generation``, ``Price`` or ``Flow``, once its table has been built."""
        return self._table(name).coverage(self.year, self.step_minutes)

    def _refuse_gaps(self, name: str) -> None:
        days = self.coverage(name)
        bad = days.where("missing > 0 OR repeated > 0")
        keys = [c for c in days.columns if c == "REGION"]
        sums = bad.groupBy(*keys).agg(F.sum("missing"), F.sum("repeated"), F.min("day")).orderBy(*keys).limit(10)
        found = [
            f"{' '.join(map(str, row[: len(keys)]))} {row[-3]} missing, {row[-2]} repeated, first on {row[-1]}".strip()
            for row in sums.collect()
            if row[-1] is not None
        ]
        if found:
            raise ValueError(f"{name} of {self.year}: " + "; ".join(found))

    def demand(self, regions: Sequence[str] | None = None) -> DataFrame:
        return self._hourly(
            "Demand",
            lambda paths: feeds.read_demand_feed(self.spark, paths, source=True),
            lambda feed: hourly_demand(feed, ["REGION", "source"], end_of_interval_minutes=self.shift),
            ["REGION"],
            regions,
        )

    def technologies(self, regions: Sequence[str] | None = None) -> DataFrame:
        def hours_of(feed: DataFrame) -> DataFrame:
            found = [row.path for row in self._listed("Metadata").select("path").collect()]
            if not found:
                raise ValueError(f"no Metadata file of {self.year} in {self.raw}")
            stations = feeds.read_station_metadata(self.spark, sorted(found))
            return hourly_technology_wide_feed(feed, stations, ["REGION", "source"], self.shift)

        return self._hourly(
            "Generation",
            lambda paths: feeds.read_generation_feed(self.spark, paths, source=True),
            hours_of,
            ["REGION"],
            regions,
        )

    def prices(self, regions: Sequence[str] = tuple(REGIONS)) -> DataFrame:
        return self._hourly(
            "Price",
            lambda paths: feeds.read_price_feed(self.spark, paths, source=True),
            lambda feed: hourly_price_wide(
                feed,
                [c for c in feed.columns if c not in ("date_time", "source")],
                ["source"],
                end_of_interval_minutes=self.shift,
            ),
            regions=regions,
        )

    def flows(self) -> DataFrame:
        return self._hourly(
            "Flow",
            lambda paths: feeds.read_flow_feed(self.spark, paths, source=True),
            lambda feed: hourly_flow_wide(feed, keys=["source"], end_of_interval_minutes=self.shift),
        )


def prepare_demand(
    market: MarketYear,
    out: str,
    regions: Sequence[str] = tuple(REGIONS),
    reserves: DataFrame | str | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Write the zonal inputs of the regions; ``options`` are those of ``demand_tables``.

    ``reserves`` are the hourly reserve requirements, or the path of their files.
    """
    if isinstance(reserves, str):
        reserves = model_files.read_reserves(market.spark, reserves)
    wanted = F.col("REGION").isin(list(regions))
    tables = demand_tables(
        market.demand(regions).where(wanted),
        market.technologies(regions).where(wanted),
        reserves,
        **options,
    )
    layer.write_zonal(tables, out)
    return tables


def prepare_plants(
    spark: SparkSession,
    specs: str,
    capacity: str,
    cost: str,
    year: int,
    out: str,
    text: Sequence[str] = (),
) -> DataFrame:
    """Write the plant table of a year from the assumption files; ``text`` names text columns."""
    tables = model_files.read_assumptions(spark, specs, capacity, cost, text=text)
    plants = plant_table(*tables, year)
    layer.write_plants(plants, out)
    return plants


def storage_tables(
    spark: SparkSession, model: str, year: int, horizons: HorizonMap = HorizonMap()
) -> dict[str, DataFrame]:
    """Net output and level of storage units, from the outputs of one run.

    The files are ``…Charge_Units``, ``…Discharge_Units`` and ``…Storage_Level``; hours come
    from the horizons, as in every other output.
    """

    def long(name: str, value: str) -> DataFrame:
        path = files.only_file(spark, model, f"*{name}*")
        wide = model_files.read_model_table(spark, path)
        return stamped_long(wide, year, "unit", value, horizons)

    units = model_files.read_unit_metadata(
        spark, files.only_file(spark, model, files.UNIT_FILES)
    )
    charge, discharge = long("Charge_Units", "charge"), long("Discharge_Units", "discharge")
    return {
        "Charge_Discharge": storage_net_output(charge, discharge, units),
        "Storage_Level": long("Storage_Level", "level"),
    }


def compare(
    market: MarketYear,
    model: str,
    fuels: Sequence[str],
    links: Sequence[str],
    horizons: HorizonMap = HorizonMap(),
    network: Network = Network(),
    whole_year: bool = False,
) -> Comparison:
    """Compare the model files in a folder with the market of the same year.

    The folder holds the unit table and zonal inputs (``INPUT…``) and the outputs
    ``…Electricity_dispatch``, ``…SystemMarginalPrice`` and ``…IC_Flows_Hourly`` of one run;
    several runs are an error. ``whole_year`` lays mean prices over all modelled hours of the year,
    so that one without any row makes its day, month and period unknown.
    """
    spark = market.spark

    def only(pattern: str) -> str:
        return files.only_file(spark, model, pattern)

    modelled = model_facts(
        model_files.read_model_table(spark, only("*Electricity_dispatch*")),
        model_files.read_model_table(spark, only("*SystemMarginalPrice*")),
        *model_files.read_model_flows(spark, only("*IC_Flows_Hourly*")),
        model_files.read_zonal(spark, model),
        model_files.read_unit_metadata(spark, only(files.UNIT_FILES)),
        market.year,
        horizons,
        network,
    )
    actual = actual_facts(
        market.technologies(network.regions),
        market.prices(network.regions),
        market.flows(),
        horizons,
    )
    hours = None
    if whole_year:
        year = spark.sql(f"SELECT {int(market.year)} AS year")
        modelled_hour = hour_of_timestamp(F.col("date_time"), horizons.leap).isNotNull()
        hours = expand_hours(year).where(modelled_hour)
    return Comparison(
        both_sides(modelled, actual), fuels, links, network.regions, network=network, hours=hours
    )
