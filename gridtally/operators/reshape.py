"""Wide to long and long to wide."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally.functions import first_number


def to_long(
    df: DataFrame, ids: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every column but ``ids`` becomes a (name, value) row; nulls are kept.

    Pass ``columns`` to take some only: the choice then reaches the scan, which a filter on
    the name afterwards would not.
    """
    if columns is None:
        columns = [c for c in df.columns if c not in ids]
    quoted = [F.col(f"`{c}`") for c in columns]
    return df.unpivot([F.col(f"`{c}`") for c in ids], quoted, name, value)


def yearly_to_long(
    df: DataFrame, ids: Sequence[str], prefix: str, value: str, year: int | None = None
) -> DataFrame:
    """Columns named ``<prefix>…<year>`` become (year, value) rows.

    With ``year`` only that year's columns are read.
    """
    found: dict[str, int] = {}
    for column in df.columns:
        number = re.search(r"\d+", column)
        if column.startswith(prefix) and number:
            found[column] = int(number.group())
    chosen = [c for c, y in found.items() if year is None or y == year]
    if not chosen:
        empty = df.where(F.lit(False)).select(*ids)
        return empty.withColumns(
            {"year": F.lit(None).cast("int"), value: F.lit(None).cast("double")}
        )
    long = to_long(df.select(*ids, *[F.col(f"`{c}`") for c in chosen]), ids, "_name", value)
    years = first_number(F.col("_name")).cast("int")
    return long.select(*ids, years.alias("year"), value)


def literal(text: str) -> str:
    """Text as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def only_value(name: str, wanted: str, value: str, alias: str) -> Column:
    """Aggregate: the value of the one row named ``wanted``; an error if there are several.

    Written as one SQL expression per cell, so that wide tables are quick to plan.
    """
    here = f"`{name}` = {literal(wanted)}"
    problem = literal(f"more than one row for {name} {wanted} in a group")
    return F.expr(
        f"CASE WHEN count_if({here}) > 1 THEN cast(raise_error({problem}) AS DOUBLE) "
        f"ELSE max(CASE WHEN {here} THEN `{value}` END) END AS `{alias}`"
    )


def to_wide(
    df: DataFrame,
    ids: Sequence[str],
    name: str,
    value: str,
    columns: Sequence[str],
    suffix: str = "",
    other: str | None = None,
) -> DataFrame:
    """One column per entry of ``columns``; duplicate (ids, name) rows are an error.

    The columns are given, so no job is needed to find them, and one aggregation with
    map-side combine does the work. A row with a name that is not listed is an error, or adds
    to the column ``other``; names that are null count as not listed.
    """
    cells = [only_value(name, c, value, f"{c}{suffix}") for c in columns]
    listed = ", ".join(literal(c) for c in columns)
    unlisted = f"NOT coalesce(`{name}` IN ({listed}), false)" if columns else "true"
    if other is not None:
        rest = F.expr(f"sum(CASE WHEN {unlisted} THEN `{value}` END)").alias(f"{other}{suffix}")
        return df.groupBy(*ids).agg(*cells, rest)
    problem = literal(f"{name} not among the columns: ")
    # raised row by row inside a numeric aggregate: a buffer of text would cost a sort
    stray = f"raise_error(concat({problem}, coalesce(cast(`{name}` AS STRING), 'null')))"
    guard = F.expr(f"max(CASE WHEN {unlisted} THEN cast({stray} AS DOUBLE) END) AS `__unlisted`")
    grouped = df.groupBy(*ids).agg(*cells, guard)
    # each cell refers to the guard, so that no choice of columns can lose it
    names = [f"{c}{suffix}" for c in columns]
    return grouped.select(*ids, *(F.coalesce("__unlisted", F.col(f"`{n}`")).alias(n) for n in names))


def found_labels(df: DataFrame, name: str, at_most: int = 1000) -> list[str]:
    """The distinct labels of a column, in order, as columns for :func:`to_wide`; runs a job.

    More than ``at_most`` are an error, since a wide table then is the wrong shape. Null is no label.
    """
    labels = df.where(F.col(name).isNotNull()).select(F.col(name).cast("string").alias("label")).distinct()
    found = [row.label for row in labels.orderBy("label").limit(at_most + 1).collect()]
    if len(found) > at_most:
        raise ValueError(f"{name} has more than {at_most} labels, among them {', '.join(found[:5])}")
    return found


def one_row_each(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The same rows; a key that stands in several is an error, as it would multiply a join.

    Rows without a key match nothing and are left out. One aggregation counts the rows of a key
    and keeps its first, so a repeated key gathers nowhere.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    shown = F.concat_ws(", ", *(F.col(f"`{k}`").cast("string") for k in keys))
    problem = F.raise_error(F.concat(F.lit(f"more than one row for {', '.join(keys)} "), shown))
    others = StructType([f for f in df.schema.fields if f.name not in keys])
    first = F.first(F.struct(*(F.col(f"`{c}`") for c in others.names)))
    row = F.when(F.count(F.lit(1)) > 1, problem.cast(others)).otherwise(first)
    known = df.dropna("any", subset=keys).groupBy(*keys)
    return known.agg(row.alias("_row")).select(*keys, "_row.*")


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_zero_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the columns that are absent, filled with 0."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(0.0) for c in absent}) if absent else df
