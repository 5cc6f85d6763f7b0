"""Removal of boilerplate lines, by their frequency within a site.

For each host, the pages that hold a line are divided by the pages of the host; a line above a
ratio is boilerplate there and is dropped from all its pages. A line is compared without the white
space around it, by 128 bits of hash; blank lines are neither counted nor dropped.

Lines are counted once per page before the shuffle and combined by each task, so neither a hot
host nor a hot line gathers in one task. A host has at most (lines per page / ratio) boilerplate
lines, as each stands on more than that share of its pages; so one list for each host is small, and
the pages themselves are not shuffled while the lists of all hosts are small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import Workspace
from gridtally.llm.quality_rules import GAPS


def _digest(line: Column) -> Column:
    bare = F.trim(line, F.lit(GAPS))
    return F.struct(F.xxhash64(bare).alias("low"), F.xxhash64(F.lit(1), bare).alias("high"))


def _blank(line: Column) -> Column:
    return F.trim(line, F.lit(GAPS)) == ""


def boilerplate(space: Workspace, pages: DataFrame, host: Column, max_ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): the digests of each host's boilerplate lines. A null host is a host too."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    digests = F.transform(F.filter(lines, lambda x: ~_blank(x)), _digest)
    each = pages.select(host.alias("host"), F.explode(F.array_distinct(digests)).alias("line"))
    totals = pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("total"))
    totals = space.keep(totals.select(F.col("host").alias("site"), "total"), "totals")
    counts = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    often = counts.join(totals, F.col("host").eqNullSafe(F.col("site"))).where(F.col("pages") > max_ratio * F.col("total"))
    found = often.groupBy("host").agg(F.collect_list("line").alias("lines"))
    return space.keep(found.select(F.col("host").alias("site"), "lines"), "boilerplate")


def without_boilerplate(
    pages: DataFrame, host: Column, keep: list[str], max_ratio: float = 0.07, min_pages: int = 5
) -> DataFrame:
    """The columns `keep` of each row of `pages` (text), n_lines, n_dropped and kept_text.

    n_lines counts lines that are not blank. `min_pages` guards hosts of few pages. Null and empty
    texts have no lines and stay as they are. Repeated rows are pages of their own. Columns of `keep`
    with the name of a new column give way to it.
    """
    space = Workspace(pages.sparkSession, "line-dedup")
    found = boilerplate(space, pages, host, max_ratio, min_pages)
    rows = pages.select(F.struct(*keep).alias("row"), host.alias("host"), "text")
    joined = rows.join(found, F.col("host").eqNullSafe(F.col("site")), "left")
    none = F.array().cast("array<struct<low:bigint,high:bigint>>")
    joined = joined.select("row", "text", F.split("text", "\n").alias("all"), F.coalesce("lines", none).alias("drop"))
    stay = F.filter("all", lambda x: _blank(x) | ~F.array_contains("drop", _digest(x)))
    joined = joined.select("row", "text", "all", F.when(F.size("drop") > 0, stay).otherwise(F.col("all")).alias("stay"))
    full = F.size(F.filter("all", lambda x: ~_blank(x)))
    gone = F.size("all") - F.size("stay")
    counts = [
        F.when(F.col("text").isNull(), 0).otherwise(c).cast("long").alias(n)
        for c, n in ((full, "n_lines"), (gone, "n_dropped"))
    ]
    names = ("n_lines", "n_dropped", "kept_text")
    return joined.select(
        *(F.col("row")[c].alias(c) for c in keep if c not in names),
        *counts,
        F.array_join("stay", "\n").alias("kept_text"),
    )


def documents_without_boilerplate(docs: DataFrame, host: Column, **options) -> DataFrame:
    """`docs` with the same columns: text without boilerplate lines, n_chars as it then is."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), host.alias("host"), "text")
    done = without_boilerplate(rows, F.col("host"), ["row"], **options)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return done.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
