"""Spelling variants: words that differ by one edit, found by dense tiles of prefix and suffix lengths.

Two different words are one inserted, deleted or replaced code point apart if their lengths differ
by one at most, and their common prefix and suffix together reach the longer length less one. A task
holds words as matrices of code points, padded behind for prefixes and in front for suffixes, and
compares blocks of rows with blocks of rows.

Only words that may be near each other meet. For pairs whose longer word has m code points, of which
the first `head` and last `tail` are known to agree, at least half of the m - head - tail - 1 others
that must agree lie in front of the edit or behind it. So a group that is too large for one task is
dealt anew by its words' next half in front, and by their next half behind, until groups are small, or
all code points but one agree. No pair is lost, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import Workspace, gather, ship, with_group

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a group that one task compares with each other, and numbers in the arrays of a tile.
_GROUP, _TILE = 512, 1 << 21
_KEY = ["m", "head", "tail", "key"]


def counted_words(docs: DataFrame, letters: str, least_length: int, least_count: int, one_in: int) -> DataFrame:
    """(word, n): lower-cased runs of `letters`, with a code point less where the crc32 of
    `<doc_id>:<run>` is a multiple of `one_in`; a null doc_id is empty."""
    small = F.translate("text", _CAPITALS, _SMALL)
    # a run loses one code point at most, so shorter ones cannot count
    runs = F.regexp_extract_all(small, F.lit(f"([{letters}]{{{least_length},}})"), 1)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    each = docs.select(name.alias("name"), F.explode(runs).alias("run"))
    each = each.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run").cast("binary")))
    at = "cast(h % length(run) as int)"
    cut = F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")
    word = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    words = each.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, one a row: padded with 0 behind, and in front."""
    front = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    back = np.array([w.rjust(width, "\0") for w in words], dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    return front, back


def near_pairs(longer: list[str], shorter: list[str]) -> Iterator[tuple[str, str]]:
    """Pairs of distinct words one edit apart: two of `longer`, all of one length, or one of them
    and one of `shorter`, all a code point shorter."""
    width = len(longer[0])
    side = max(1, min(256, int((_TILE / width) ** 0.5)))
    front, back = _matrices(longer, width)
    for others, alike in ((longer, True), (shorter, False)):
        other_front, other_back = (front, back) if alike else _matrices(others, width)
        for i in range(0, len(longer), side):
            for j in range(i if alike else 0, len(others), side):
                apart = front[i : i + side, None] != other_front[None, j : j + side]
                prefix = apart.argmax(axis=2)
                apart = back[i : i + side, None, ::-1] != other_back[None, j : j + side, ::-1]
                near = prefix + apart.argmax(axis=2) >= width - 1
                if alike and i == j:
                    near &= np.triu(np.ones_like(near), 1)
                for a, b in zip(*np.nonzero(near), strict=True):
                    yield longer[i + a], others[j + b]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gather(batches, 4 << 20):
        found = []
        for m, words in zip(batch.column("m").to_pylist(), batch.column("words").to_pylist(), strict=True):
            longer = [w for w in words if len(w) == m]
            if longer:
                found.extend(near_pairs(longer, [w for w in words if len(w) < m]))
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row twice, by the next half of what must agree in front and behind."""
    half = F.expr("(m - head - tail) div 2")  # of m - head - tail - 1, rounded up
    rows = rows.select("word", "m", F.explode(F.array(
        F.struct((F.col("head") + half).alias("head"), "tail"), F.struct("head", (F.col("tail") + half).alias("tail"))
    )).alias("on"))
    key = F.expr("concat(substring(word, 1, on.head), ' ', right(word, on.tail))")
    return rows.select("word", "m", "on.head", "on.tail", key.alias("key"))


def links(space: Workspace, words: DataFrame) -> DataFrame:
    """(a, b): each pair of distinct words of `words` (word) that are one edit apart, once."""
    length = F.length("word")
    rows = words.select("word", F.explode(F.array(length, length + 1)).alias("m"))
    rows = rows.select("word", "m", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit("").alias("key"))
    found, step = None, 0
    while True:
        sizes = rows.groupBy(*_KEY).agg(
            F.count(F.lit(1)).alias("size"), F.max(F.length("word")).alias("longest")
        )
        # one word alone, or words that are all short for m, have no pair here
        sizes = space.keep(sizes.where("size > 1 AND longest = m"), f"sizes-{step}")
        small = (F.col("size") <= _GROUP) | F.expr("m - head - tail <= 1")
        held = with_group(rows, sizes, _KEY, "size").select("word", *_KEY, small.alias("small"))
        held = space.keep(held, f"groups-{step}")
        lists = held.where("small").groupBy(*_KEY).agg(F.collect_list("word").alias("words")).select("m", "words")
        pairs = space.keep(lists.mapInArrow(_compare, "a string, b string"), f"pairs-{step}")
        found = pairs if found is None else found.unionByName(pairs)
        rows, step = held.where("NOT small"), step + 1
        if rows.isEmpty():
            # a pair may have met in front of its edit and behind it
            once = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            return space.keep(once.distinct(), "links")
        rows = space.keep(_dealt(rows), f"rows-{step}")


def _rooted(space: Workspace, forms: DataFrame) -> DataFrame:
    """(word, root) of each word of `forms` (word, form), by pointers of twice the reach each round."""
    hops = space.keep(forms.select("word", F.col("form").alias("root")), "roots-0")
    step = 0
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = hops.join(further, "root", "left")
        moved = moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step += 1
        moved = space.keep(moved, f"roots-{step}")
        hops = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return hops


def variants(
    docs: DataFrame,
    letters: str = "A-Za-zÀ-ÿ",
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    one_in: int = 199,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each frequent word of `docs` (doc_id, text).

    Words are maximal runs of `letters` with A-Z lower-cased, of at least `least_length` code points
    and `least_count` occurrences; every occurrence in repeated rows counts. From each occurrence
    whose crc32 of `<doc_id>:<run>` is a multiple of `one_in`, one code point is taken away first.
    Words are near if one code point inserted, deleted or replaced makes one the other. A word's form
    is its near word of largest n (ties: the least in code-point order) if that is at least `ratio`
    times the word's n, else null; root is where forms lead, the word itself without a form.
    Null and empty texts have no words; an empty table has none. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    space = Workspace(spark, "spelling")
    words = space.keep(counted_words(docs, letters, least_length, least_count, one_in), "words")
    near = links(space, words.select("word"))

    other: Column = F.struct((-F.col("n")).alias("less"), F.col("other").alias("form"))
    ends = near.select(F.col("a").alias("word"), F.col("b").alias("other"))
    ends = ends.unionByName(near.select(F.col("b").alias("word"), F.col("a").alias("other")))
    named = ends.join(words.select(F.col("word").alias("other"), "n"), "other")
    best = named.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(other).alias("best"))
    chosen = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr("-best.less").alias("most"), "best.form"
    )
    good = F.expr(f"most >= {ratio} * n")
    chosen = chosen.select(
        "word", "n", "n_near", F.when(good, F.col("form")).alias("form"), F.when(good, F.col("most")).alias("form_n")
    )
    chosen = space.keep(chosen, "chosen")
    roots = _rooted(space, chosen.where("form IS NOT NULL"))
    done = chosen.join(roots, "word", "left")
    return done.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
