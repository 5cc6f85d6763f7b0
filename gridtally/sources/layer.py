"""The layer of hourly tables, and the other tables that are written."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.completeness import coverage_of_year


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Write Parquet partitioned by columns, replacing the partitions written.

    The rebalance hint collects each partition in few files of even size: small partitions
    share a task, a large one is split over several. Rows are sorted by time, so that
    readers can skip row groups.
    """
    rows = df.hint("rebalance", *partitions)
    if "date_time" in df.columns:
        rows = rows.sortWithinPartitions(*partitions, "date_time")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def write_hourly(df: DataFrame, path: str) -> None:
    """Persist an hourly table by year, and by region if it has one."""
    dated = df.withColumn("year", F.year("date_time"))
    partitions = ["year", *(["REGION"] if "REGION" in df.columns else [])]
    write_partitioned(dated, path, partitions)


def read_hourly(
    spark: SparkSession,
    path: str,
    years: Sequence[int] | None = None,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """Read an hourly table; years and regions prune partitions."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.where(F.col("year").isin(list(years)))
    if regions is not None:
        df = df.where(F.col("REGION").isin(list(regions)))
    return df.drop("year")


@dataclass(frozen=True)
class Built:
    """What a build makes of some source files, with a ``source`` column in either table: the hourly
    rows, and the bitmaps of the slots that the files have (``completeness.slot_days``)."""

    hours: DataFrame
    slots: DataFrame


class HourlyTable:
    """An hourly table built from source files, file by file, below ``path``.

    ``data/build=<id>`` and ``slots/build=<id>`` hold what a build made of the files that were new to
    it; ``manifest`` has a row for each file and year, written after both. Only what the manifest
    lists is read, so a write that was cut off stays invisible. A file of another size or time than
    listed is built again and takes the place of its earlier rows; a region that no file has is not
    looked for again. An hour's readings are to lie in one file.
    """

    _MANIFEST = "source string, size long, modified timestamp, year int, build string, hours long, made timestamp"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def manifest(self) -> DataFrame:
        """The row in force of each source file and year."""
        try:
            rows = self.spark.read.schema(self._MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self._MANIFEST)
        row = F.struct("made", "build", "size", "modified", "hours")
        last = rows.groupBy("source", "year").agg(F.max(row).alias("row"))
        return last.select("source", "row.size", "row.modified", "year", "row.build", "row.hours", "row.made")

    def update(self, files: DataFrame, year: int, build: Callable[[list[str]], Built]) -> int:
        """Build what of ``files`` (source, path, size, modified) is not in force for the year; the
        number of files built."""
        known = self.manifest().where(F.col("year") == year)
        new = files.join(known, ["source", "size", "modified"], "left_anti").collect()
        if not new:
            return 0
        name = uuid.uuid4().hex
        built = build([row.path for row in new])
        of_year = built.hours.where(F.year("date_time") == year).withColumn("year", F.lit(year))
        partitions = ["year", *(["REGION"] if "REGION" in of_year.columns else [])]
        write_partitioned(of_year, f"{self.path}/data/build={name}", partitions)
        built.slots.write.parquet(f"{self.path}/slots/build={name}")
        written = self.spark.read.schema(of_year.schema).parquet(f"{self.path}/data/build={name}")
        counts = written.groupBy("source").agg(F.count(F.lit(1)).alias("hours"))
        listed = self.spark.createDataFrame(
            [(r.source, r.size, r.modified) for r in new], "source string, size long, modified timestamp"
        )
        rows = listed.join(counts, "source", "left").select(
            "source", "size", "modified", F.lit(year).alias("year"), F.lit(name).alias("build"),
            F.coalesce("hours", F.lit(0)).alias("hours"), F.current_timestamp().alias("made"),
        )
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return len(new)

    def _in_force(self, folder: str, year: int) -> DataFrame | None:
        """Rows below ``folder`` of the files and builds that the manifest has for a year."""
        rows = self.manifest().where(F.col("year") == year).collect()
        # a build without hours of the year has written no data
        builds = sorted({r.build for r in rows if r.hours or folder != "data"})
        if not builds:
            return None
        root = f"{self.path}/{folder}"
        found = self.spark.read.option("basePath", root).option("mergeSchema", "true")
        found = found.parquet(*(f"{root}/build={b}" for b in builds))
        # most builds are in force whole; of the others the files that were built again are left out
        current = {b: {r.source for r in rows if r.build == b} for b in builds}
        sources = F.create_map(*(F.lit(x) for b in builds for x in (b, "\n".join(sorted(current[b])))))
        listed = F.array_contains(F.split(F.try_element_at(sources, F.col("build")), "\n"), F.col("source"))
        return found.where(listed)

    def read(self, year: int, regions: Sequence[str] | None = None) -> DataFrame:
        """The hourly rows of a year, and of some regions if given; an error if nothing was built."""
        rows = self._in_force("data", year)
        if rows is None:
            raise ValueError(f"no hours of {year} in {self.path}")
        rows = rows.where(F.col("year") == year)
        if regions is not None and "REGION" in rows.columns:
            rows = rows.where(F.col("REGION").isin(list(regions)))
        return rows.drop("year", "build", "source")

    def coverage(self, year: int, step_minutes: int = 5) -> DataFrame:
        """Gaps and repeats of the source files by day (and region), from their bitmaps alone."""
        slots = self._in_force("slots", year)
        if slots is None:
            raise ValueError(f"no hours of {year} in {self.path}")
        keys = ["REGION"] if "REGION" in slots.columns else []
        return coverage_of_year(slots, keys, year, step_minutes)


def write_zonal(tables: dict[str, DataFrame], path: str) -> None:
    """Write the zonal tables for the solver, one folder per table and region."""
    for name, table in tables.items():
        write_partitioned(table, f"{path.rstrip('/')}/{name}", ["REGION"])


def write_plants(plants: DataFrame, path: str) -> None:
    plants.write.mode("overwrite").parquet(path)
