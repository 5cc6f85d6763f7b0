"""Interconnector flows: naming, physical ends, link totals, regional balance, revenue.

Long flows have one row per ``keys…, date_time, link`` with a ``flow`` in MW. ``keys`` are
any extra grouping columns, such as ``side`` or a scenario.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.functions import (
    gigawatt_hours,
    lenient_sum,
    strict_sum,
    zero_if_null,
)
from gridtally.operators.grains import aggregate_by
from gridtally.operators.reshape import literal, to_wide

# The model's nodes; the first five are physical regions.
NODES = {
    1: "NSW", 2: "QLD", 3: "SA", 4: "TAS", 5: "VIC", 6: "QNI", 7: "ML", 8: "M1", 9: "M2",
}
REGIONS = ["NSW", "QLD", "SA", "TAS", "VIC"]
VIRTUAL = ["QNI", "ML", "M1", "M2"]

# Link between a physical and a virtual node -> physical link.
LINK_RECODE = {
    "NSW_QNI": "NSW_QLD",
    "QLD_QNI": "QLD_NSW",
    "SA_ML": "SA_VIC",
    "TAS_M1": "TAS_VIC",
    "TAS_M2": "TAS_VIC",
    "VIC_ML": "VIC_SA",
    "VIC_M1": "VIC_TAS",
    "VIC_M2": "VIC_TAS",
    "QNI_NSW": "QLD_NSW",
    "QNI_QLD": "NSW_QLD",
    "ML_SA": "VIC_SA",
    "ML_VIC": "SA_VIC",
    "M1_TAS": "VIC_TAS",
    "M2_TAS": "VIC_TAS",
    "M1_VIC": "TAS_VIC",
    "M2_VIC": "TAS_VIC",
}


LINK_ENDS = ["from_virtual", "to_virtual", "from_to", "from", "to"]


@dataclass(frozen=True)
class Network:
    """Nodes, the virtual ones among them, and the physical link of each virtual link."""

    nodes: Mapping[int, str] = field(default_factory=lambda: dict(NODES))
    virtual: Sequence[str] = tuple(VIRTUAL)
    recode: Mapping[str, str] = field(default_factory=lambda: dict(LINK_RECODE))

    @property
    def regions(self) -> list[str]:
        return [name for name in self.nodes.values() if name not in self.virtual]

    def __post_init__(self) -> None:
        if len(set(self.nodes.values())) < len(self.nodes):
            raise ValueError("two nodes have the same name")

    def node_table(self, spark: SparkSession) -> DataFrame:
        """``node, name``: as many rows as the network has nodes."""
        rows = ", ".join(f"({int(k)}, {literal(v)})" for k, v in self.nodes.items())
        return spark.sql(f"SELECT node, name FROM VALUES {rows} AS nodes(node, name)")

    def ends_of(self, link: str) -> tuple[str, str]:
        """The two nodes that a name joins; other names are cut at their first and last ``_``."""
        names = set(self.nodes.values())
        found = [(a, b) for a, b in _cuts(link) if a in names and b in names]
        if len(found) > 1:
            raise ValueError(f"{link} names more than one link: {found}")
        parts = link.split("_")
        return found[0] if found else (parts[0], parts[-1])

    def ambiguous_links(self) -> list[str]:
        """Names that two pairs of nodes share: ``A_B_C`` where A, A_B, B_C and C are nodes."""
        names = set(self.nodes.values())
        longer: dict[str, list[str]] = {}
        for name in names:
            for start, rest in _cuts(name):
                if start in names:
                    longer.setdefault(rest, []).append(name)
        ends = [(rest, end) for name in names for rest, end in _cuts(name) if end in names]
        return sorted({f"{start}_{end}" for rest, end in ends for start in longer.get(rest, ())})


def _cuts(name: str) -> list[tuple[str, str]]:
    """Both sides of each ``_`` in a name."""
    return [(name[: m.start()], name[m.end() :]) for m in re.finditer("_", name)]


def name_links(flows: DataFrame, network: Network = Network(), ends: bool = False) -> DataFrame:
    """Node numbers ``from_node`` and ``to_node`` become the ``link`` name ``FROM_TO``.

    ``ends`` keeps the names of both nodes as ``from_virtual, to_virtual``: a name alone may
    stand for two links, where node names hold ``_``. A link with an unknown node has neither.
    """
    nodes = network.node_table(flows.sparkSession)
    named = flows.join(nodes.toDF("from_node", "_from"), "from_node", "left")
    named = named.join(nodes.toDF("to_node", "_to"), "to_node", "left")
    named = named.withColumn("link", F.concat("_from", F.lit("_"), "_to"))
    if ends:
        known = F.col("link").isNotNull()
        named = named.withColumns(
            {"from_virtual": F.when(known, F.col("_from")), "to_virtual": F.when(known, F.col("_to"))}
        )
    return named.drop("from_node", "to_node", "_from", "_to")


def _end(names: Sequence[str], end: int) -> str:
    """SQL for an end of a link, 1 or 2: names may hold ``_``, so the network's are tried first."""
    either = "|".join(re.escape(n) for n in sorted(names, key=lambda n: (-len(n), n)))
    known = f"nullif(regexp_extract(link, {literal(f'^({either})_({either})$')}, {end}), '')"
    return f"coalesce({known}, split_part(link, '_', {1 if end == 1 else -1}))"


def resolve_links(flows: DataFrame, network: Network = Network()) -> DataFrame:
    """Add the ends of each link: all nodes, and physical regions only.

    ``from_virtual, to_virtual`` are the link's own ends; ``from_to, from, to`` its physical
    ones. Links that are not recoded keep their name. Rows that have their own ends already
    (:func:`name_links`) keep them; else the ends of a name are the two nodes of the network
    that it joins, and names of other links are cut at their first and last ``_``. A name
    without ends that stands for several pairs of nodes is an error.
    """
    names = list(network.nodes.values())
    shared = ", ".join(literal(link) for link in network.ambiguous_links())
    own = {}
    for end, column in enumerate(LINK_ENDS[:2], 1):
        parsed = _end(names, end)
        if shared:
            problem = "raise_error(concat('more than one pair of nodes is named ', link))"
            parsed = f"CASE WHEN link IN ({shared}) THEN cast({problem} AS STRING) ELSE {parsed} END"
        own[column] = F.expr(f"coalesce({column}, {parsed})" if column in flows.columns else parsed)
    resolved = flows.withColumns(own)
    # keyed by both ends beside the name, as the name may stand for another link, too
    pairs = []
    for link, physical in network.recode.items():
        start, stop = network.ends_of(physical)
        key = ", ".join(literal(n) for n in (link, *network.ends_of(link)))
        pairs.append(f"struct({key}), struct({literal(physical)}, {literal(start)}, {literal(stop)})")
    same = "struct(link AS col1, from_virtual AS col2, to_virtual AS col3)"
    physical = f"coalesce(try_element_at(map({', '.join(pairs)}), {same}), {same})" if pairs else same
    resolved = resolved.withColumn("_physical", F.expr(physical))
    places = {c: F.col(f"_physical.col{k}") for k, c in enumerate(LINK_ENDS[2:], 1)}
    return resolved.withColumns(places).drop("_physical")


def arriving(flows: DataFrame, network: Network = Network()) -> DataFrame:
    """Leave out rows that arrive at a virtual node.

    A flow through a virtual node is two links; only the half that reaches a physical
    region counts. Rows without an end are kept.
    """
    if "to_virtual" not in flows.columns:
        return flows
    end = F.col("to_virtual")
    return flows.where(end.isNull() | ~end.isin(list(network.virtual)))


def _price_at(end: str, regions: Sequence[str]) -> Column:
    cases = " ".join(f"WHEN {literal(r)} THEN `_at_{r}`" for r in regions)
    return F.expr(f"CASE `{end}` {cases} END")


def attach_prices(
    flows: DataFrame,
    prices: DataFrame,
    regions: Sequence[str] = tuple(REGIONS),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``price_from`` and ``price_to``, the price at both physical ends.

    One join on the hour to the prices of all regions serves both ends; joining the long
    price table twice would shuffle the flows twice.
    """
    ids = [*keys, "date_time"]
    wide = to_wide(prices, ids, "REGION", "spot_price", regions)
    wide = wide.select(*ids, *[F.col(r).alias(f"_at_{r}") for r in regions])
    return flows.join(wide, ids, "left").select(
        *flows.columns,
        _price_at("from", regions).alias("price_from"),
        _price_at("to", regions).alias("price_to"),
    )


def link_flows(
    flows: DataFrame,
    grain: str,
    keys: Sequence[str] = (),
    network: Network = Network(),
    by_year: bool = False,
) -> DataFrame:
    """Flow per physical link in GWh: 1 decimal for the whole period, 3 otherwise.

    ``from`` and ``to`` are part of a link's identity, so that links of one name stay apart.
    """
    digits = 1 if grain == "period" else 3
    total = gigawatt_hours(strict_sum("flow"), digits).alias("flow")
    return aggregate_by(
        arriving(flows, network), grain, [*keys, "from_to", "from", "to"], [total], by_year
    )


def link_flows_wide(
    flows: DataFrame,
    grain: str,
    links: Sequence[str],
    keys: Sequence[str] = (),
    network: Network = Network(),
    by_year: bool = False,
) -> DataFrame:
    """:func:`link_flows` with one column per link; two links of one name are an error."""
    long = link_flows(flows, grain, keys, network, by_year).drop("from", "to")
    ids = [c for c in long.columns if c not in ("from_to", "flow")]
    return to_wide(long, ids, "from_to", "flow", links)


def region_balance(
    flows: DataFrame,
    keys: Sequence[str] = (),
    network: Network = Network(),
    strict: bool = False,
) -> DataFrame:
    """Hourly ``In``, ``Out`` and ``Net`` flow per ``REGION``.

    Each flow counts once at either end, so one aggregation gives both directions. A region
    with one direction only has 0 for the other; with ``strict`` it has null, also in Net.
    """
    ends = F.array(
        F.struct(F.col("to").alias("REGION"), F.lit(True).alias("inward")),
        F.struct(F.col("from").alias("REGION"), F.lit(False).alias("inward")),
    )
    ids = [*keys, "date_time"]
    rows = (
        arriving(flows, network)
        .select(*ids, "flow", F.explode(ends).alias("end"))
        .select(*ids, "flow", "end.REGION", "end.inward")
    )
    inward = F.col("inward")
    sums = rows.groupBy(*ids, "REGION").agg(
        strict_sum("flow", inward).alias("In"), strict_sum("flow", ~inward).alias("Out")
    )
    if not strict:
        sums = sums.withColumns({"In": zero_if_null("In"), "Out": zero_if_null("Out")})
    return sums.withColumn("Net", F.col("In") - F.col("Out"))


def region_balance_totals(
    balance: DataFrame, grain: str, keys: Sequence[str] = (), by_year: bool = False
) -> DataFrame:
    """In, out and net flow per region in GWh: ``daily_in``, ``month_net``, ``annual_out``…"""
    prefix = {"day": "daily", "month": "month", "period": "annual"}[grain]
    totals = [
        gigawatt_hours(strict_sum(c)).alias(f"{prefix}_{c.lower()}")
        for c in ("In", "Out", "Net")
    ]
    return aggregate_by(balance, grain, [*keys, "REGION"], totals, by_year)


def link_revenue(
    priced: DataFrame, keys: Sequence[str] = (), network: Network = Network(), ends: bool = False
) -> DataFrame:
    """Settlement residue per link: price difference times flow, unknown hours left out.

    Links of one name between other nodes have rows of their own; ``ends`` adds the columns that
    tell them apart, ``from_virtual, to_virtual``.
    """
    revenue = (F.col("price_to") - F.col("price_from")) * F.col("flow")
    link = "link" if "link" in priced.columns else "from_to"
    own = [c for c in LINK_ENDS[:2] if c in priced.columns]
    sums = (
        arriving(priced, network)
        .groupBy(*keys, F.col(link).alias("link"), *own)
        .agg(lenient_sum(revenue).alias("annual_revenue"))
    )
    return sums if ends else sums.drop(*own)


def link_revenue_wide(
    priced: DataFrame,
    links: Sequence[str],
    keys: Sequence[str] = (),
    network: Network = Network(),
) -> DataFrame:
    long = link_revenue(priced, keys, network)
    return to_wide(long, list(keys), "link", "annual_revenue", links)
