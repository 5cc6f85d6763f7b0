"""Finding input files, and reading wide tables whose columns depend on the file."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.reshape import stack

# File name patterns of model inputs.
UNIT_FILES = "INPUT*GENERATION*"
ZONAL_FILES = "INPUT*_ZONAL_*"
FLOW_FILES = "*IC_Flows_Hourly*"


def matching_files(spark: SparkSession, folder: str, pattern: str, *columns: str) -> DataFrame:
    """``path``, or other ``columns``, of the files in a folder whose name matches; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(*(columns or ["path"]))
    )


def listed_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``source, path, size, modified`` of matching files; none if the folder does not exist.

    ``source`` is the name under which rows read from the file know it.
    """
    try:
        found = matching_files(spark, folder, pattern, "_metadata.file_path", "path", "length", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "source string, path string, size long, modified timestamp")
    return found.toDF("source", "path", "size", "modified")


def only_file(spark: SparkSession, folder: str, pattern: str) -> str:
    """The one matching file; none or several is an error."""
    found = [row.path for row in matching_files(spark, folder, pattern).limit(2).collect()]
    if len(found) != 1:
        problem = "several files match" if found else "no file matches"
        raise ValueError(f"{problem} {pattern!r} in {folder}")
    return found[0]


def _csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    # enforceSchema off: a file with other column names is an error, not misread columns.
    # Spark cannot compare headers with unnamed columns, which it calls _c0, _c1, ...
    named = not any(re.fullmatch(r"_c\d+", c) for c in columns)
    reader = spark.read.option("header", "true").option("enforceSchema", str(not named).lower())
    return reader.csv(list(paths))


def with_file_label(df: DataFrame, column: str, pattern: str, *others: Column) -> DataFrame:
    """Add a label taken from the name of the file each row was read from.

    Only a table straight from a reader knows its files. A name without a label is an error.
    """
    file = F.col("_metadata.file_name")
    label = F.regexp_extract(file, pattern, 1)
    problem = F.raise_error(F.concat(F.lit(f"no {column} in the file name "), file))
    return df.select("*", F.when(label != "", label).otherwise(problem.cast("string")).alias(column), *others)


def read_any(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "csv",
    label: tuple[str, str] | None = None,
    source: bool = False,
) -> DataFrame:
    """One table from files of one schema or of different columns.

    CSV files with different columns are read per header and stacked by column name, Parquet
    files by merging schemas; a column a file lacks is null there. ``label`` is a column and
    the pattern that finds its value in the file name; ``source`` adds the file's path as the
    last column.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)

    def labelled(df: DataFrame) -> DataFrame:
        if source:
            path = F.col("_metadata.file_path").alias("source")
            df = with_file_label(df, *label, path) if label else df.select("*", path)
            return df
        return with_file_label(df, *label) if label else df

    if fmt == "parquet":
        return labelled(spark.read.option("mergeSchema", "true").parquet(*paths))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = spark.read.option("header", "true").csv(path).columns
        by_header.setdefault(tuple(header), []).append(path)
    return stack(labelled(_csv(spark, same, names)) for names, same in by_header.items())


def typed(df: DataFrame, types: dict[str, str], default: str | None = "double") -> DataFrame:
    """Cast columns by name; blanks and ``NA`` are null, other text that is no value an error."""
    columns = []
    for name, kind in df.dtypes:
        cell, wanted = F.col(f"`{name}`"), types.get(name, default)
        value = cell.try_cast(wanted) if wanted else cell
        if wanted and kind == "string" and wanted != "string":
            absent = cell.isNull() | F.upper(F.trim(cell)).isin("", "NA", "NAN", "NULL")
            text = F.concat(F.lit(f"{name} is to be {wanted}, but holds "), cell)
            problem = F.raise_error(text).cast(wanted)
            value = F.when(value.isNotNull() | absent, value).otherwise(problem)
        columns.append(value.alias(name))
    return df.select(*columns)
