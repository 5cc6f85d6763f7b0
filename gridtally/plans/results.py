"""Model results and market actuals in the same tables.

Both sides are long facts with a ``side`` column, so every table is computed once for all
sides. Extra grouping columns (scenario, run) go into ``keys`` and ride along the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridtally.operators import energy, network, price
from gridtally.operators.network import REGIONS, Network
from gridtally.operators.reshape import found_labels, stack, to_long, to_wide
from gridtally.sources.staging import stage

SIDES = ("Model", "Actual")


@dataclass(frozen=True)
class Facts:
    """Hourly facts, all with ``keys…, date_time``.

    * ``prices``: ``REGION, spot_price``
    * ``flows``: ``link, flow``, or with its ends already resolved
    * ``output``: ``REGION, FUEL_TYPE_TEXT, output`` per unit or fuel
    * ``exogenous``: the same columns, for demand and exogenous generation
    """

    prices: DataFrame
    flows: DataFrame
    output: DataFrame
    exogenous: DataFrame | None = None

    def staged(self, keys: Sequence[str] = ("side",)) -> Facts:
        """Write each fact once; the tables are then read from there, not recomputed.

        Output is summed per fuel before it is written.
        """
        output = energy.output_by_fuel(self.output, keys)
        return Facts(
            prices=stage(self.prices, "prices"),
            flows=stage(self.flows, "flows"),
            output=stage(output, "output"),
            exogenous=None if self.exogenous is None else stage(self.exogenous, "exogenous"),
        )


@dataclass(frozen=True)
class Comparison:
    """The comparison tables. Each is a lazy DataFrame, built when asked for.

    ``strict`` keeps the null rules of a complete data set: a region with one direction of
    flow has no net flow, and a fuel both dispatched and exogenous is an error. ``skip_nulls`` lets mean prices ignore missing hours.
    ``hours`` lists each ``date_time`` that mean prices need; without it an hour for which no
    region has a row is not seen. Without ``links`` each link of the data has a column; the totals
    are then staged, and their labels looked up, when a table of links is asked for.
    """

    facts: Facts
    fuels: Sequence[str]
    links: Sequence[str] | None
    regions: Sequence[str] = tuple(REGIONS)
    keys: Sequence[str] = ("side",)
    network: Network = field(default_factory=Network)
    strict: bool = False
    skip_nulls: bool = False
    by_year: bool = False
    hours: DataFrame | None = None

    # prices
    @cached_property
    def prices(self) -> DataFrame:
        return price.price_wide(self.facts.prices, self.regions, self.keys)

    def _over_hours(self, wide: DataFrame) -> DataFrame:
        return wide if self.hours is None else price.over_hours(wide, self.hours, self.keys)

    def mean_price(self, grain: str) -> DataFrame:
        return price.mean_price(
            self._over_hours(self.prices), grain, self.regions, self.keys, self.by_year, self.skip_nulls
        )

    @cached_property
    def weights(self) -> DataFrame:
        return energy.dispatch_weights(self.generation, self.keys)

    @cached_property
    def prices_and_weights(self) -> DataFrame:
        return price.price_and_weight_wide(
            self.facts.prices, self.weights, self.regions, self.keys
        )

    def load_weighted_price(self, grain: str) -> DataFrame:
        return price.load_weighted_price(
            self._over_hours(self.prices_and_weights), grain, self.regions, self.keys, self.by_year,
            self.skip_nulls,
        )

    # flows
    @cached_property
    def flows(self) -> DataFrame:
        flows = self.facts.flows
        return flows if "from" in flows.columns else network.resolve_links(flows, self.network)

    @cached_property
    def priced_flows(self) -> DataFrame:
        return network.attach_prices(self.flows, self.facts.prices, self.regions, self.keys)

    def link_flows(self, grain: str) -> DataFrame:
        if self.links is not None:
            return network.link_flows_wide(
                self.flows, grain, self.links, self.keys, self.network, self.by_year
            )
        totals = network.link_flows(self.flows, grain, self.keys, self.network, self.by_year)
        totals = stage(totals.drop("from", "to"), f"link-flows-{grain}")
        ids = [c for c in totals.columns if c not in ("from_to", "flow")]
        return to_wide(totals, ids, "from_to", "flow", found_labels(totals, "from_to"))

    @cached_property
    def balance(self) -> DataFrame:
        return network.region_balance(self.flows, self.keys, self.network, self.strict)

    def balance_totals(self, grain: str) -> DataFrame:
        return network.region_balance_totals(self.balance, grain, self.keys, self.by_year)

    @cached_property
    def revenue(self) -> DataFrame:
        return network.link_revenue(self.priced_flows, self.keys, self.network)

    # generation
    @cached_property
    def generation(self) -> DataFrame:
        return energy.generation_table(
            self.facts.output, self.fuels, self.facts.exogenous, self.balance, self.keys,
            self.strict,
        )

    def generation_totals(self, grain: str) -> DataFrame:
        return energy.generation_totals(self.generation, grain, self.keys, self.by_year)

    def tables(self) -> dict[str, DataFrame]:
        """All tables, keyed ``<group>.<table>``."""
        return {
            "Price.DATA": self.prices,
            "Price.AvPrice": self.mean_price("period"),
            "Price.DailyAvPrice": self.mean_price("day"),
            "Price.MonthAvPrice": self.mean_price("month"),
            "Price.LW_AvPrice": self.load_weighted_price("period"),
            "Price.Daily_LW_AvPrice": self.load_weighted_price("day"),
            "Price.Monthly_LW_AvPrice": self.load_weighted_price("month"),
            "IC_Flows.DATA": self.priced_flows,
            "IC_Flows.AnnualFlows": self.link_flows("period"),
            "IC_Flows.DailyFlows": self.link_flows("day"),
            "IC_Flows.MonthlyFlows": self.link_flows("month"),
            "IC_Flows.Revenue": self.revenue,
            "IC_Flows.FlowInOut": self.balance,
            "IC_Flows.DailyFIO": self.balance_totals("day"),
            "IC_Flows.MonthlyFIO": self.balance_totals("month"),
            "IC_Flows.AnnualFIO": self.balance_totals("period"),
            "Gen_Dis.DATA": self.generation,
            "Gen_Dis.DailyGen": self.generation_totals("day"),
            "Gen_Dis.MonthlyGen": self.generation_totals("month"),
            "Gen_Dis.AnnualGen": self.generation_totals("period"),
        }

    def tree(self, sides: Sequence[str] = SIDES) -> dict[str, DataFrame]:
        """One table per side, keyed ``<side>.<group>.<table>``."""
        return {
            f"{side}.{name}": frame.where(F.col("side") == side).drop("side")
            for side in sides
            for name, frame in self.tables().items()
        }

    def summary(self) -> DataFrame:
        """Whole-period tables of all sides as rows ``keys…, table, REGION, item, value``.

        ``REGION`` is empty where the item itself is a region or link.
        """
        keys = list(self.keys)
        parts = [
            ("AvPrice", self.mean_price("period"), []),
            ("LW_AvPrice", self.load_weighted_price("period"), []),
            ("AnnualFlows", self.link_flows("period"), []),
            ("AnnualFIO", self.balance_totals("period"), ["REGION"]),
            ("AnnualGen", self.generation_totals("period"), ["REGION"]),
        ]
        rows = [
            _summary_rows(to_long(frame, [*keys, *ids], "item", "value"), name, keys)
            for name, frame, ids in parts
        ]
        revenue = self.revenue.withColumnsRenamed(
            {"link": "item", "annual_revenue": "value"}
        )
        return stack([*rows, _summary_rows(revenue, "Revenue", keys)])


def _summary_rows(frame: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    region = F.col("REGION") if "REGION" in frame.columns else F.lit("")
    return frame.select(
        *keys, F.lit(name).alias("table"), region.alias("REGION"), "item", "value"
    )


SORT_COLUMNS = ["year", "date_time", "day", "month", "REGION", "link"]


def ordered(frame: DataFrame) -> DataFrame:
    """Sort each file of a result table by time, then region: no shuffle for the output's order.

    ``side`` comes first, as the writer wants rows of one folder together.
    """
    present = [c for c in ["side", *SORT_COLUMNS] if c in frame.columns]
    return frame.sortWithinPartitions(*present) if present else frame


def in_total_order(frame: DataFrame) -> DataFrame:
    """Range-partitioned by what :func:`ordered` sorts by, so that the files' ranges follow each other.

    A hash of the row comes last: rows of one hour may be split over files, and their order stays.
    """
    present = [c for c in ["side", *SORT_COLUMNS] if c in frame.columns]
    if not present:
        return frame
    columns = [F.col(f"`{c}`") for c in frame.columns]
    return frame.repartitionByRange(*present, F.xxhash64(*columns))


def write_results(
    tables: dict[str, DataFrame], path: str, total_order: bool = False
) -> dict[str, dict[str, object]]:
    """Write each result table once, below ``path`` as ``<group>/<table>/side=<side>``.

    Tables of one side, from :meth:`Comparison.tree`, go to ``<side>/<group>/<table>``. With
    ``total_order`` the files of a table follow each other in time, for one shuffle a table; a reader
    of some days then skips the other files. Returns for each table what was counted while writing:
    ``rows``, and ``first`` and ``last`` hour where it has hours.
    """
    counted = {}
    for name, frame in tables.items():
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("rows")]
        if "date_time" in frame.columns:
            measures += [F.min("date_time").alias("first"), F.max("date_time").alias("last")]
        rows = ordered(in_total_order(frame) if total_order else frame).observe(seen, *measures)
        # static: folders of sides that an earlier run left go, too
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if "side" in frame.columns:
            writer = writer.partitionBy("side")
        writer.parquet(f"{path.rstrip('/')}/{PurePosixPath(*name.split('.'))}")
        counted[name] = seen.get
    return counted
