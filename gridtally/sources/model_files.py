"""Readers for model inputs, model outputs and assumption tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.model import EXOGENOUS_SERIES, unit_metadata
from gridtally.operators.plants import PLANT_KEYS
from gridtally.sources.files import FLOW_FILES, ZONAL_FILES, read_any, typed, with_file_label

# The text and whole-number columns of the plant tables.
PLANT_TYPES = {
    "STATION": "string",
    "DUID": "string",
    "REGION": "string",
    "REGION_KEY": "int",
    "FUEL_TYPE_TEXT": "string",
    "GEN_TECH_TEXT": "string",
    "AvaliableDate": "int",
    "ExpectedRetirementYear": "int",
}
RESERVES = ["OPERATING_RESERVE_UP", "OPERATING_RESERVE_DOWN"]


def read_unit_metadata(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return unit_metadata(typed(read_any(spark, path, fmt), PLANT_TYPES))


def _indexed(df: DataFrame) -> DataFrame:
    """The first two columns are horizon and period, whatever they are called."""
    named = df.toDF("horizon", "period", *df.columns[2:])
    return typed(named, {"horizon": "string", "period": "int"})


def read_model_table(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Dispatch, price, charge, discharge or storage level: ``horizon, period`` and values.

    One file: where the index columns have no name, files cannot be told apart by header.
    """
    return _indexed(read_any(spark, path, fmt))


def read_model_flows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Flow body and its link columns, from a CSV with two header rows and no names.

    The header rows hold the from-node and the to-node of each column. The body comes back
    as ``horizon, period`` and columns named by position; the links as ``position,
    from_node, to_node``. Header rows have no horizon, so stamping the body drops them.
    """
    raw = spark.read.option("header", "false").csv(path)
    positions = [str(i) for i in range(1, len(raw.columns) - 1)]
    from_nodes, to_nodes = (row[2:] for row in raw.take(2))
    rows = ", ".join(
        f"('{p}', {int(float(a))}, {int(float(b))})"
        for p, a, b in zip(positions, from_nodes, to_nodes, strict=True)
    )
    links = spark.sql(
        f"SELECT * FROM VALUES {rows} AS links(position, from_node, to_node)"
    )
    return _indexed(raw.toDF("horizon", "period", *positions)), links


def read_flow_runs(
    spark: SparkSession, folder: str, run: str, pattern: str = FLOW_FILES
) -> DataFrame:
    """Flows of many runs: ``run, horizon, period, from_node, to_node, flow``, a row for each cell.

    Files are as for :func:`read_model_flows`; each may have links of its own, in its own order.
    ``run`` finds the run's name in the file name. All files are read together: the two rows without
    horizon and period are known by their place in the file, and meet the other rows by file and
    position. A file without just two such rows, or with a cell beyond them, is an error.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    lines = with_file_label(
        lines, "run", run, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    parts = F.transform(F.split("value", ","), lambda x: F.trim(F.regexp_replace(x, '"', "")))
    rows = lines.where(F.trim("value") != "").select("run", "file", "block", parts.alias("parts"))
    index, cells = F.slice("parts", 1, 2), F.expr("slice(parts, 3, greatest(size(parts) - 2, 0))")
    head = F.concat_ws("", index) == ""

    # lines of a block keep their order, and blocks start in that of the file
    place = F.struct("block", F.monotonically_increasing_id().alias("line"))
    heads = rows.where(head).select("file", cells.alias("cells"), place.alias("place"))
    both = heads.groupBy("file").agg(
        F.min_by("cells", "place").alias("a"), F.max_by("cells", "place").alias("b"), F.count(F.lit(1)).alias("n")
    )
    wrong = F.raise_error(F.concat(F.lit("not two header rows in "), "file")).cast("array<struct<a:string,b:string>>")
    pairs = F.when(F.col("n") == 2, F.arrays_zip("a", "b")).otherwise(wrong)
    links = both.select("file", F.posexplode(pairs).alias("position", "ends"))

    body = rows.where(~head).select(
        "run", "file", F.get("parts", F.lit(0)).alias("horizon"), F.get("parts", F.lit(1)).alias("period"),
        F.posexplode(cells).alias("position", "flow"),
    )
    beyond = F.raise_error(F.concat(F.lit("a cell beyond the header rows in "), "file")).cast("string")
    found = body.join(links, ["file", "position"], "left").select(
        "run", "horizon", "period",
        F.when(F.col("ends").isNotNull(), F.col("ends.a")).otherwise(beyond).alias("from_node"),
        F.col("ends.b").alias("to_node"), "flow",
    )
    named = typed(found, {"run": "string", "horizon": "string", "period": "int"})
    return named.withColumns({c: F.col(c).cast("int") for c in ("from_node", "to_node")})


def read_zonal(spark: SparkSession, folder: str, fmt: str = "csv") -> DataFrame:
    """Zonal inputs of all regions; ``REGION_KEY`` is in the file name."""
    reader = spark.read.option("pathGlobFilter", ZONAL_FILES)
    raw = (
        reader.parquet(folder)
        if fmt == "parquet"
        else reader.option("header", "true").option("enforceSchema", "false").csv(folder)
    )
    labelled = with_file_label(raw, "REGION_KEY", r"_ZONAL_(\d+)")
    wanted = labelled.select("Time", *EXOGENOUS_SERIES, "REGION_KEY")
    return typed(wanted, {"Time": "int", "REGION_KEY": "int"})


def read_reserves(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Hourly reserve requirements of the template: ``REGION, t`` and both reserves."""
    raw = read_any(spark, path, fmt).select("REGION", "t", *RESERVES)
    return typed(raw, {"REGION": "string", "t": "int"})


def read_assumptions(
    spark: SparkSession,
    specs: str,
    capacity: str,
    cost: str,
    fmt: str = "csv",
    text: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plant specifications, yearly capacity and yearly cost; ``text`` names text columns."""
    types = {**PLANT_TYPES, **{c: "string" for c in text}}
    tables = [typed(read_any(spark, p, fmt), types) for p in (specs, capacity, cost)]
    for table in tables[1:]:
        lacking = set(PLANT_KEYS) - set(table.columns)
        if lacking:
            raise ValueError(f"assumption table lacks {sorted(lacking)}")
    return tuple(tables)
