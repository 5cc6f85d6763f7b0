"""Documents that hold benchmark passages, found by latent semantic retrieval and then checked.

Passages are overlapping windows of words (lower case, punctuation left out), as TF-IDF vectors over
hashed words; document frequencies come from all documents. A randomised singular value
decomposition of the benchmark's passages gives a latent space: passages times random vectors span
its range, sums over partitions of the Gram matrix make that basis orthonormal, and sums over
partitions of the passages projected on it give the singular vectors. All passages of all documents
are compared with all items there by cosine (its denominator is the full length of the passage, so
words outside the space count against it). Of a large benchmark the space holds a part of each item
only; the least cosine is relative to that part, so that a copy is found whatever the rank.

A passage of fixed length dilutes short items and those that straddle two passages, so there is a
second, exact source of candidates: each passage around which an item's words weigh as much as the
check below asks for, found by the item's rarer words.

Candidates are checked against the words: the longest common subsequence of item and surrounding
text, each word weighing its inverse document frequency, as a share of the item; and whether the
item's answer (its last sentence) is there. A close copy needs the share, a paraphrase a smaller
share and the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import ship
from gridtally.llm.words import Words, mixed, slices

WINDOW, STRIDE, BITS, RANK, SEED = 32, 16, 18, 512, 5
#: Items compared at once; a larger benchmark is worked on in blocks of so many.
ITEM_BLOCK = 20_000
#: Rows are looked up together while they have so many (row, item) cells and entries of the index.
_CELLS = 4_000_000
#: What may be left out of the index of rare words, as a part of a candidate's share: the more, the
#: shorter the index and the more rows are looked at closely.
_COMMON = 0.6
#: Shares are rounded to six digits before they are compared.
_ROUNDING = 1e-6
_ANSWER = r"[.!?:]\s+"


def _words(column: pa.Array) -> Iterator[Words]:
    """Words without case; the sharp s has two capital letters, so it counts as two."""
    return slices(pc.replace_substring(pc.utf8_lower(column), "ß", "ss"), marks=True)


def _features(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - BITS)).astype(np.int64)


def _starts(count: int) -> np.ndarray:
    """First word of each passage of a text; the last passage ends with the text."""
    last = max(count - WINDOW, 0)
    return np.append(np.arange(0, last, STRIDE), last) if count else np.zeros(0, dtype=np.int64)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BITS, dtype=np.int64)
    n = 0
    for batch in batches:
        for words in _words(batch.column("text")):
            rows = np.repeat(np.arange(len(words.counts)), words.counts)
            pairs = np.unique((rows << BITS) | _features(words.values))
            total += np.bincount(pairs & ((1 << BITS) - 1), minlength=1 << BITS)
            n += len(words.counts)
    yield _counts(np.concatenate((total, [n])))


def _counts(total: np.ndarray, size: int = 1 << 12) -> pa.RecordBatch:
    parts = [total[b : b + size].tobytes() for b in range(0, len(total), size)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"]
    )


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
            counts = np.frombuffer(raw.as_buffer(), np.int64)
            totals[part] = totals[part] + counts if part in totals else counts
    if totals:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
            ["part", "counts"],
        )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Weight of each hashed word, from all documents; 2**BITS numbers whatever their number, which
    reach the driver in one job."""
    parts = texts.select("text").mapInArrow(_document_frequencies, "part int, counts binary")
    added = parts.repartition("part").mapInArrow(_add_counts, "part int, counts binary")
    total = np.zeros((1 << BITS) + 1, dtype=np.int64)
    for row in added.collect():
        counts = np.frombuffer(row["counts"], np.int64)
        total[row["part"] << 12 : (row["part"] << 12) + len(counts)] = counts
    return np.log((1 + total[-1]) / (1 + total[:-1])) + 1e-3


def _passages(column: pa.Array, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, features and normed TF-IDF of each passage of a few texts."""
    for words in _words(column):
        begins = words.begins()
        for row, count in enumerate(words.counts):
            for start in _starts(int(count)):
                found = _features(words.values[begins[row] + start : begins[row] + min(start + WINDOW, count)])
                names, times = np.unique(found, return_counts=True)
                vector = times * weights[names]
                yield words.first + row, names, vector / np.linalg.norm(vector)


def _random_rows(features: np.ndarray, rank: int) -> np.ndarray:
    """Random +1/-1 rows, a function of the feature alone, so that no task needs them all."""
    grid = features.astype(np.uint64)[:, None] * np.uint64(rank) + np.arange(rank, dtype=np.uint64)
    return np.where(mixed(grid + np.uint64(SEED << 40)) & np.uint64(1), 1.0, -1.0)


def _matrix(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "sums"]
    )


def _gram(weights, rank: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, rank))
        for batch in batches:
            for _, names, vector in _passages(batch.column("text"), weights.value):
                y = vector @ _random_rows(names, rank)
                total += np.outer(y, y)
        yield _matrix(total)

    return run


def _projected(weights, basis, rank: int):
    """Sum over the partition's passages of (orthonormal coordinates) x (TF-IDF), by feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, names, vector in _passages(batch.column("text"), weights.value):
                q = (vector @ _random_rows(names, rank)) @ basis
                for name, value in zip(names.tolist(), vector.tolist(), strict=True):
                    sums[name] = sums[name] + value * q if name in sums else value * q
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                ["feature", "row"],
            )

    return run


@dataclass
class Latent:
    """Right singular vectors, for the features that the benchmark has."""

    place: np.ndarray
    vectors: np.ndarray


def latent_space(benchmark: DataFrame, weights, rank: int = RANK) -> Latent:
    """The latent space of the benchmark's passages. Its size is that of the benchmark's vocabulary,
    2**BITS at most, times the rank."""
    gram = np.zeros((rank, rank))
    for row in benchmark.mapInArrow(_gram(weights, rank), "i int, sums binary").toLocalIterator():
        gram[row["i"]] += np.frombuffer(row["sums"])
    values, axes = np.linalg.eigh(gram)
    good = values > max(values[-1], 1e-12) * 1e-9
    basis = axes[:, good] / np.sqrt(values[good])
    sums: dict[int, np.ndarray] = {}
    rows = benchmark.mapInArrow(_projected(weights, basis, rank), "feature long, row binary")
    for row in rows.toLocalIterator():
        part = np.frombuffer(row["row"])
        sums[row["feature"]] = sums.get(row["feature"], 0) + part
    place = np.full(1 << BITS, -1, dtype=np.int32)
    names = np.array(sorted(sums), dtype=np.int64)
    place[names] = np.arange(len(names))
    table = np.array([sums[n] for n in names.tolist()]).reshape(len(names), basis.shape[1])
    # rows of `table` are B transposed: B = U S V', so V = B' U / S
    square, left = np.linalg.eigh(table.T @ table) if table.size else (np.zeros(0), np.zeros((0, 0)))
    keep = square > (square[-1] if len(square) else 0) * 1e-9
    vectors = table @ (left[:, keep] / np.sqrt(square[keep])) if table.size else table
    return Latent(place, vectors.astype(np.float32))


@dataclass
class RareWords:
    """Which items hold each word. The most frequent words of an item are left out while they weigh
    up to `_COMMON` of what a candidate needs; the others then weigh `need` in any candidate."""

    marked: np.ndarray
    values: np.ndarray
    begins: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    need: np.ndarray


def _distinct(own: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of an item, sorted, and what all places of each weigh."""
    values, times = np.unique(own, return_counts=True)
    return values, times * weights[_features(values)]


def _rare_words(words: list[np.ndarray], weights: np.ndarray, share: float) -> RareWords:
    values, held, owners, need = [], [], [], np.zeros(len(words))
    for k, own in enumerate(words):
        value, weight = _distinct(own, weights)
        order = np.argsort(weights[_features(value)], kind="stable")
        total = weight.sum()
        left_out = order[np.cumsum(weight[order]) <= _COMMON * share * total]
        rare = np.setdiff1d(np.arange(len(value)), left_out)
        need[k] = (share - 2 * _ROUNDING) * total - weight[left_out].sum()
        values.append(value[rare])
        held.append(weight[rare])
        owners.append(np.full(len(rare), k))
    if not values:
        values, held, owners = [np.zeros(0, np.uint64)], [np.zeros(0)], [np.zeros(0, np.int64)]
    value, item = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((item, value))
    names, begins = np.unique(value[order], return_index=True)
    marked = np.zeros(1 << BITS, dtype=bool)
    marked[_features(names)] = True
    return RareWords(marked, names, np.append(begins, len(value)), item[order], np.concatenate(held)[order], need)


@dataclass
class Items:
    """A block of the benchmark: names, words, answers, and passages in the latent space."""

    names: list
    words: list[np.ndarray]
    #: Distinct words of each item, sorted, and what all places of each weigh.
    distinct: list[tuple[np.ndarray, np.ndarray]]
    answers: list[np.ndarray]
    owners: np.ndarray
    latent: np.ndarray
    #: Length of each normed passage within the space: 1 if all of it is there.
    captured: np.ndarray
    rare: RareWords


def _items(rows: list, weights: np.ndarray, space: Latent, answer_share: float) -> Items:
    def words_of(texts: list[str]) -> list[np.ndarray]:
        out = []
        for words in _words(pa.array(texts, pa.string())):
            begins = words.begins()
            out.extend(words.values[b:e] for b, e in zip(begins[:-1], begins[1:], strict=True))
        return out

    owners, latent, captured = [], [], []
    for row, names, vector in _passages(pa.array([r["text"] for r in rows], pa.string()), weights):
        at = space.vectors[space.place[names]].T @ vector
        length = float(np.linalg.norm(at))
        owners.append(row)
        captured.append(min(length, 1.0))
        latent.append(at / max(length, 1e-12))
    table = np.array(latent, dtype=np.float32).reshape(len(latent), space.vectors.shape[1])
    texts, answers = [r["text"] for r in rows], [r["answer"] for r in rows]
    words = words_of(texts)
    return Items(
        [r["item_id"] for r in rows],
        words,
        [_distinct(own, weights) for own in words],
        words_of(answers),
        np.array(owners, dtype=np.int64),
        table,
        np.array(captured, dtype=np.float32),
        _rare_words(words, weights, answer_share),
    )


def common_share(item: np.ndarray, text: np.ndarray, weight: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of two sequences, as a share of the first's."""
    total = float(weight.sum())
    if not total or not len(text):
        return 0.0
    best = np.zeros(len(text) + 1)
    for word, value in zip(item, weight, strict=True):
        hit = np.flatnonzero(text == word)
        if len(hit):
            step = best.copy()
            step[hit + 1] = np.maximum(step[hit + 1], best[hit] + value)
            best = np.maximum.accumulate(step)
    return float(best[-1]) / total


def _candidates(words: Words, items: Items, weights: np.ndarray, space: Latent, floor: float):
    """(row, start, item) of each passage whose cosine with an item's passage is `floor` or more of
    what a copy of that passage has in the space."""
    if not len(words.values) or not len(items.owners):
        return np.zeros((0, 3), dtype=np.int64)
    counts = words.counts
    # starts of all passages, as in _starts
    last = np.maximum(counts - WINDOW, 0)
    per_row = np.where(counts > 0, -(-last // STRIDE) + 1, 0)
    rows = np.repeat(np.arange(len(counts)), per_row)
    step = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    start = np.minimum(step * STRIDE, last[rows])
    first = words.begins()[rows] + start
    end = np.minimum(first + WINDOW, words.begins()[rows + 1])
    found = _features(words.values)
    weight = weights[found]
    place = space.place[found]
    square = np.concatenate(([0.0], np.cumsum(weight**2)))
    inside = np.concatenate(([0.0], np.cumsum(np.where(place >= 0, weight**2, 0))))
    full = square[end] - square[first]
    # the part of a passage in the space is no longer than the part in its words
    part = inside[end] - inside[first]
    # rounding must not cost a copy its place
    least = floor * np.maximum(items.captured - np.float32(1e-4), 0)
    maybe = np.flatnonzero((part > 0) & (part >= float(least.min()) ** 2 * full))
    # only words of the space add to a passage's place in it
    held = np.flatnonzero(place >= 0)
    before = np.searchsorted(held, first[maybe]), np.searchsorted(held, end[maybe])
    out = []
    for begin in range(0, len(maybe), 1024):
        some = maybe[begin : begin + 1024]
        low, high = (b[begin : begin + 1024] for b in before)
        sizes = high - low
        each = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        at = held[each]
        # a dense table of passages and the words they hold
        names, column = np.unique(place[at], return_inverse=True)
        cell = np.repeat(np.arange(len(some)), sizes) * len(names) + column
        table = np.bincount(cell, weight[at], minlength=len(some) * len(names)).reshape(len(some), len(names))
        x = table.astype(np.float32) @ space.vectors[names]
        near = (x @ items.latent.T) >= least * np.sqrt(full[some])[:, None].astype(np.float32)
        passage, which = np.nonzero(near)
        out.append(np.column_stack((rows[some][passage], start[some][passage], items.owners[which])))
    return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), dtype=np.int64)


def _rows_with(words: Words, rare: RareWords) -> Iterator[tuple[int, int]]:
    """Row and item wherever the distinct rare words of the item in the row weigh what they need."""
    maybe = np.flatnonzero(rare.marked[_features(words.values)])
    place = np.minimum(np.searchsorted(rare.values, words.values[maybe]), len(rare.values) - 1)
    real = rare.values[place] == words.values[maybe]
    rows = np.searchsorted(words.begins(), maybe[real], "right") - 1
    # each word of a row once
    pairs = np.unique(rows * len(rare.values) + place[real])
    rows, place = pairs // len(rare.values), pairs % len(rare.values)
    entries = np.concatenate(([0], np.cumsum(rare.begins[place + 1] - rare.begins[place])))
    n, low, most = len(rare.need), 0, max(1, _CELLS // len(rare.need))
    while low < len(rows):
        # whole rows, as many as the bounds allow, at least one
        high = min(int(np.searchsorted(entries, entries[low] + _CELLS, "right")) - 1, int(np.searchsorted(rows, rows[low] + most)))
        if high < len(rows):
            high = int(np.searchsorted(rows, rows[min(high, len(rows) - 1)]))
        if high <= low:
            high = int(np.searchsorted(rows, rows[low], "right"))
        sizes = np.diff(entries[low : high + 1])
        each = np.arange(sizes.sum()) + np.repeat(rare.begins[place[low:high]] - (entries[low:high] - entries[low]), sizes)
        base = rows[low]
        cell = np.repeat(rows[low:high] - base, sizes) * n + rare.items[each]
        weight = np.bincount(cell, rare.weights[each], minlength=(rows[high - 1] - base + 1) * n).reshape(-1, n)
        # rows without any rare word stand between the others
        row, item = np.nonzero((weight >= rare.need) & (weight > 0))
        yield from zip((row + base).tolist(), item.tolist(), strict=True)
        low = high


def _places(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a text would be among sorted words, and whether it is there."""
    place = np.minimum(np.searchsorted(value, text), len(value) - 1)
    return place, value[place] == text


def _lookups(words: Words, items: Items, share: float) -> np.ndarray:
    """(row, start, item) of each passage around which the item's words weigh `share` of it."""
    out = []
    if not len(words.values) or not len(items.rare.values):
        return np.zeros((0, 3), dtype=np.int64)
    begins = words.begins()
    for row, item in _rows_with(words, items.rare):
        text, own = words.values[begins[row] : begins[row + 1]], items.words[item]
        value, weight = items.distinct[item]
        place, here = _places(value, text)
        sums = np.concatenate(([0.0], np.cumsum(np.where(here, weight[place], 0.0))))
        start = _starts(len(text))
        low, high = _around(start, len(own), len(text))
        good = start[sums[high] - sums[low] >= (share - 2 * _ROUNDING) * weight.sum()]
        out.append(np.column_stack((np.full(len(good), row), good, np.full(len(good), item))))
    return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)


def _around(start, item: int, text: int):
    """The words that an item of so many words near the passage at `start` may cover: it may start
    before the passage and end after it."""
    return np.maximum(start - item // 2, 0), np.minimum(start + WINDOW + item, text)


def _before(one: int | None, other: int | None) -> bool:
    return one is not None and (other is None or one < other)


_FOUND = "contaminated boolean, item_id long, overlap double, answer_found boolean"


def _search(items, weights, space, floor: float, copy_share: float, answer_share: float):
    """Adds what a block of items gives to what earlier blocks gave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _words(batch.column("text")):
                n, begins = len(words.counts), words.begins()
                given = batch.slice(words.first, n)
                leaked = given.column("contaminated").to_numpy(zero_copy_only=False).copy()
                share = given.column("overlap").to_numpy().copy()
                item = given.column("item_id").to_pylist()
                answered = given.column("answer_found").to_numpy(zero_copy_only=False).copy()
                near = _candidates(words, items.value, weights.value, space.value, floor)
                exact = _lookups(words, items.value, answer_share)
                for row, start, which in np.unique(np.concatenate((near, exact)), axis=0):
                    own = items.value.words[which]
                    low, high = _around(start, len(own), words.counts[row])
                    text = words.values[begins[row] + low : begins[row] + high]
                    # no subsequence weighs more than the item's words that occur at all
                    value, held = items.value.distinct[which]
                    place, here = _places(value, text)
                    met = np.zeros(len(value), dtype=bool)
                    met[place[here]] = True
                    if held[met].sum() < (answer_share - _ROUNDING) * held.sum():
                        continue
                    weight = weights.value[_features(own)]
                    found = round(common_share(own, text, weight), 6)
                    if found < answer_share:
                        continue
                    answer = items.value.answers[which]
                    with_answer = common_share(answer, text, weights.value[_features(answer)]) >= 0.9
                    leaked[row] |= found >= copy_share or (found >= answer_share and with_answer)
                    name = items.value.names[which]
                    # of equal shares the least item_id counts, whatever the order of blocks
                    if found > share[row] or found == share[row] and _before(name, item[row]):
                        share[row], item[row], answered[row] = found, name, with_answer
                yield pa.RecordBatch.from_arrays(
                    [given.column("row"), given.column("text"), pa.array(leaked), pa.array(item, pa.int64()), pa.array(share), pa.array(answered)],
                    ["row", "text", "contaminated", "item_id", "overlap", "answer_found"],
                )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    floor: float = 0.45,
    copy_share: float = 0.6,
    answer_share: float = 0.45,
) -> DataFrame:
    """The columns `keep` of each row of `docs` (text), contaminated, item_id, overlap, answer_found.

    `benchmark` has item_id and text, and may have answer; else an item's last sentence is its
    answer. item_id and overlap are those of the item with the largest share; null and 0 where none
    reaches `answer_share`. Every passage where an item reaches `answer_share` is checked, whatever
    its cosine. Items without words are left out. Null and empty texts are clean, and so
    is everything if the benchmark is empty. Repeated rows get the same verdict. A column of `keep`
    with the name of a new one gives way to it.
    """
    spark = docs.sparkSession
    ship(spark)
    names = ("contaminated", "item_id", "overlap", "answer_found")
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    answer = F.element_at(F.split(F.trim(text), _ANSWER), -1)
    if "answer" in benchmark.columns:
        answer = F.coalesce(F.col("answer"), answer)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"), answer.alias("answer"))
    items = items.where(F.regexp_like("text", F.lit(r"[\p{L}\p{N}]")))
    blocks = max(1, -(-items.count() // ITEM_BLOCK))

    raw = inverse_frequencies(docs)
    weights = spark.sparkContext.broadcast(raw)
    latent = latent_space(items.select("text"), weights)
    space = spark.sparkContext.broadcast(latent)
    done = rows.select(
        "row",
        "text",
        F.lit(False).alias("contaminated"),
        F.lit(None).cast("long").alias("item_id"),
        F.lit(0.0).alias("overlap"),
        F.lit(False).alias("answer_found"),
    )
    for block in range(blocks):
        # a bounded number of items, those of one remainder of a hash
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        held = spark.sparkContext.broadcast(_items(part.collect(), raw, latent, answer_share))
        search = _search(held, weights, space, floor, copy_share, answer_share)
        done = done.mapInArrow(search, f"row {kind}, text string, {_FOUND}")
    return done.select(*(F.col("row")[c].alias(c) for c in keep if c not in names), *names)


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no benchmark item."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    done = contamination(rows, benchmark, ["row"], **options).where("NOT contaminated")
    return done.select(*(F.col("row")[c].alias(c) for c in docs.columns))
