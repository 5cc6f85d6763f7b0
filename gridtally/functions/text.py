"""Text helpers for link names, feed column names and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def before_first(text: Column, separator: str) -> Column:
    """Text before the first separator; the whole text if there is none."""
    return F.split_part(text, F.lit(separator), F.lit(1))


def after_last(text: Column, separator: str) -> Column:
    """Text after the last separator; the whole text if there is none."""
    return F.split_part(text, F.lit(separator), F.lit(-1))


def drop_suffix(text: Column, pattern: str) -> Column:
    """Remove a trailing match, e.g. the ``1`` of a parallel link or region feed."""
    return F.regexp_replace(text, f"(?:{pattern})$", "")


def first_number(text: Column) -> Column:
    """First run of digits, e.g. the year in ``Cap 2030``; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit(""))


def file_extension(name: Column) -> Column:
    return F.regexp_extract(name, r"([^.]+)$", 1)


def file_prefix(name: Column) -> Column:
    """Text before the first underscore; empty if there is none."""
    return F.regexp_extract(name, r"^([^_]+)_", 1)
