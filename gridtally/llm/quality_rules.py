"""Quality rules by distribution divergence, in DataFrame functions only.

Each document's histograms of character classes and of common words are compared with those of the
languages of the corpus, by Jensen-Shannon distance (0: equal, 1: nothing in common). A document
far from every language is rejected. Short documents have ragged histograms: words drawn from a
reference itself lie apart from it, the more the fewer they are, so the allowed distance grows as
texts shorten. Before that stand plain counts: words, symbols, repeated lines and passages.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import Workspace

GAPS = " \t\n\x0b\f\r"
GAP_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of each language, as any grammar lists them; a parameter.
COMMON_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un", "para", "con", "no"),
}

CLASSES = ("lower", "upper", "digit", "stop", "symbol", "other")


def words_of(text: Column) -> Column:
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(GAPS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP_PATTERN))


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def counted(docs: DataFrame, keep: Sequence[Column], languages: Mapping[str, Sequence[str]]) -> DataFrame:
    """The columns `keep`, the counts of each text, and its histograms `classes` and `common`."""
    names = [f"keep_{i}" for i in range(len(keep))]
    kept = [c.alias(n) for c, n in zip(keep, names, strict=True)]
    text = F.coalesce(F.col("text"), F.lit(""))
    common = sorted({w for words in languages.values() for w in words})
    either_case = sorted({*common, *(w.capitalize() for w in common)})

    # one select after the other: what several later columns use is computed once
    step = docs.select(*kept, text.alias("text"), words_of(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(GAPS)) != "")
    step = step.select(
        *names,
        "words",
        F.size("words").alias("n"),
        F.array_join("words", "").alias("letters"),
        F.length(_without(F.col("text"), f"[^{SYMBOLS}]+")).alias("n_symbols"),
        lines.alias("lines"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.col("n") - WINDOW),
        lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW))),
    )
    step = step.select(
        *names,
        "n",
        "n_symbols",
        F.length("letters").alias("word_chars"),
        _without(F.col("letters"), r"\p{Ll}+").alias("marks"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.col("n") > WINDOW, window).alias("windows"),
        F.transform(F.filter("words", lambda w: w.isin(either_case)), F.lower).alias("common_words"),
    )
    # most texts repeat no window; only the others are sorted
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("placed", F.when(repeats, placed))

    def value(k: Column) -> Column:
        return F.get("placed", k)["h"]

    twice = F.filter(
        F.sequence(F.lit(0), F.size("placed") - 1),
        lambda k: F.coalesce(value(k) == value(k - 1), F.lit(False))
        | F.coalesce(value(k) == value(k + 1), F.lit(False)),
    )
    starts = F.sort_array(F.transform(twice, lambda k: F.get("placed", k)["i"]))
    step = step.withColumn("starts", F.when(F.col("placed").isNotNull(), starts))
    # a window covers five words, or those up to the next window
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda a, s: F.struct((a["sum"] + F.least(F.lit(WINDOW), s - a["last"])).alias("sum"), s.alias("last")),
        lambda a: a["sum"],
    )

    marks = F.col("marks")
    upper = F.length(_without(marks, r"[^\p{Lu}]+"))
    digit = F.length(_without(marks, r"[^\p{Nd}]+"))
    stop = F.length(_without(marks, r"[^.,;:!?]+"))
    rest = F.length(_without(marks, rf"[\p{{Lu}}\p{{Nd}}.,;:!?{SYMBOLS}]+"))
    lower = F.col("word_chars") - F.length(marks)
    classes = (lower, upper, digit, stop, F.col("n_symbols"), rest)

    def times(word: str) -> Column:
        return F.size(F.filter("common_words", lambda w: w == word))

    histogram = [times(word) for word in common]
    others = F.col("n") - F.size("common_words")
    return step.select(
        *names,
        F.col("n").cast("long").alias("n_words"),
        F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"),
        F.col("n_dup_lines").cast("long"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*(c.cast("long") for c in classes)).alias("classes"),
        F.array(*(c.cast("long") for c in histogram), others.cast("long")).alias("common"),
    )


def _total(column: str, size: int) -> Column:
    return F.array(*(F.coalesce(F.sum(F.get(column, F.lit(i))), F.lit(0)) for i in range(size)))


def js_distance(counts: Column, total: Column, reference: Sequence[int]) -> Column:
    """Jensen-Shannon distance of a histogram, with its sum, from another of equal length; null if
    either is empty."""
    whole = sum(reference)
    if not whole:
        return F.lit(None).cast("double")

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def term(count: Column, q: Column) -> Column:
        p = count / total
        m = (p + q) / 2
        return (part(p, m) + part(q, m)) / 2

    shares = F.array(*(F.lit(x / whole) for x in reference))
    divergence = F.aggregate(F.zip_with(counts, shares, term), F.lit(0.0), lambda a, x: a + x)
    # rounding may leave a value just under 0
    return F.when(total > 0, F.sqrt(F.greatest(divergence, F.lit(0.0))))


def allowance(n: Column, common: int) -> Column:
    """About the sum of both distances of `n` words drawn from the reference itself.

    The divergence of a sample from its source is near chi-square / (8 n ln 2), with a degree of
    freedom for each class but one. Characters of one word are not drawn apart (numbers are digits
    throughout), so words are the sample of both histograms.
    """
    nats = 8 * math.log(2)
    return sum(F.sqrt(F.lit(free / nats) / n) for free in (common, len(CLASSES) - 1))


def judge(
    docs: DataFrame,
    keep: Sequence[str],
    languages: Mapping[str, Sequence[str]] = COMMON_WORDS,
    full_words: int = 60,
    max_distance: float = 0.46,
    slack: float = 2.0,
) -> DataFrame:
    """The columns `keep` of each row of `docs` (text, lang), its counts, distances and verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance,
    word_distance, base_failed and kept; a column of `keep` with one of these names gives way to it.
    A document is rejected if its two distances add up to more than `max_distance`; below
    `full_words` words by more than that and `slack` times what :func:`allowance` grows from
    `full_words` to its own length, so the limit has no step. The references
    are the summed histograms of all documents of each language in `languages` that pass the base
    rules, then once more without those that this rejects; a distance is that to the nearest
    language, whatever the document's own says. While no language has a reference, no document is
    compared; one that fails the base rules is rejected anyhow. Null and empty texts have no words and fail the base rules. Every row is
    judged by itself, so repeated rows all get the same verdict.
    """
    space = Workspace(docs.sparkSession, "quality-rules")
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    counts = space.keep(counted(docs, [lang, *(F.col(c) for c in keep)], languages), "counts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counts = counts.withColumn("base_failed", failed)

    wide = len({w for words in languages.values() for w in words}) + 1
    known = counts.where(F.col("keep_0").isin(list(languages)) & ~F.col("base_failed"))

    common = max((len(words) for words in languages.values()), default=0)
    # at least one word, as the limit of a text without any does not matter
    length = F.greatest(F.col("n_words"), F.lit(1))
    grown = allowance(F.least(length, F.lit(full_words)), common) - allowance(F.lit(full_words), common)
    limit = max_distance + slack * grown

    def references(rows: DataFrame) -> list:
        # at most one row for each language of the parameter
        totals = (_total("classes", len(CLASSES)).alias("classes"), _total("common", wide).alias("common"))
        return rows.groupBy("keep_0").agg(*totals).orderBy("keep_0").collect()

    def distances(rows: DataFrame, found: list) -> DataFrame:
        def nearest(column: str, total: str) -> Column:
            each = [js_distance(F.col(column), F.col(total), r[column]) for r in found]
            nearest_one = F.least(*each) if len(each) > 1 else (each or [F.lit(None).cast("double")])[0]
            return nearest_one

        rows = rows.withColumn("class_distance", nearest("classes", "word_chars"))
        rows = rows.withColumn("word_distance", nearest("common", "n_words"))
        apart = F.coalesce(F.col("class_distance") + F.col("word_distance"), F.lit(0.0))
        return rows.withColumn("far", apart > limit)

    # the second references leave out the documents that the first ones reject
    first = distances(known, references(known))
    judged = distances(counts, references(first.where(~F.col("far"))))
    far = F.col("far")
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~far)
    out = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "class_distance", "word_distance", "base_failed", "kept",
    ]
    held = [F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep, 1) if c not in out]
    return judged.select(*held, *out)


def good_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose verdict is `kept`, with the columns they came with."""
    rows = docs.select(F.col("text"), *([F.col("lang")] if "lang" in docs.columns else []), F.struct(*docs.columns).alias("row"))
    return judge(rows, ["row"], **options).where("kept").select("row.*")
