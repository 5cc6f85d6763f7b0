"""Quality scores from document statistics: kernel ridge by random features, then calibration.

Statistics of a text (shares of byte classes, word lengths, repetition) are whitened and mapped to
random Fourier features, whose inner products approximate a Gaussian kernel. Each partition sums
its part of the normal equations; the sums are solved for ridge weights. Isotonic regression on a
fixed grid of raw scores turns these into probabilities.

Statistics and features are rounded to integers, so that all sums are exact and a result does not
depend on how rows were dealt out. Everything that reaches the driver has a fixed size: the sums
(FEATURES + 1)**2 and the grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import Workspace, ship
from gridtally.llm.words import Words, slices

FEATURES, RIDGE, WIDTH, SEED = 256, 1e-4, 1.0, 7
#: Steps of a statistic, of a feature and of a raw score.
_UNIT, _STEP, _GRID = 1 << 12, 1 << 12, 512
_GRID_RANGE = (-_GRID, 2 * _GRID)

#: Byte classes: upper, lower, digit, space, line feed, stop, symbol, bar, other ASCII, beyond ASCII.
_CLASS = np.full(256, 8, dtype=np.int64)
_CLASS[128:] = 9
for _k, _bytes in enumerate(
    (range(65, 91), range(97, 123), range(48, 58), b" ", b"\n", b".,;:?!'\"()-", b"#*$%&<>", b"|")
):
    _CLASS[list(_bytes)] = _k
_N_CLASSES = 10
STATISTICS = _N_CLASSES + 12


def _by_row(words: Words, values: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    begins = words.begins()
    return total[begins[1:]] - total[begins[:-1]]


def _distinct_share(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return np.bincount(rows[new], minlength=n) / np.maximum(np.bincount(rows, minlength=n), 1)


def statistics(words: Words, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS numbers, each about 0 to 1, for each text."""
    n, raw = len(words.counts), words.bytes
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(n), sizes)
    classes = np.bincount(rows * _N_CLASSES + _CLASS[raw], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    shares = np.sqrt(classes / np.maximum(sizes, 1)[:, None])
    count = np.maximum(words.counts, 1)
    lengths = (words.ends - words.starts).astype(float)
    mean = _by_row(words, lengths, n) / count
    spread = np.sqrt(np.maximum(_by_row(words, lengths**2, n) / count - mean**2, 0))
    first, last = _CLASS[raw[words.starts]], _CLASS[raw[words.ends - 1]]
    word_rows = np.repeat(np.arange(n), words.counts)
    at, window_rows, _ = words.windows(5)
    alone = (lengths == 1) & (first > 4)
    return np.column_stack(
        [
            shares,
            np.log1p(words.counts) / 10,
            np.log1p(sizes) / 14,
            np.minimum(mean / 16, 2),
            np.minimum(spread / 16, 2),
            _by_row(words, (first == 0).astype(float), n) / count,
            _by_row(words, (first > 4).astype(float), n) / count,
            _by_row(words, (last == 5).astype(float), n) / count,
            _by_row(words, ((last == 6) | (last == 7)).astype(float), n) / count,
            _by_row(words, alone.astype(float), n) / count,
            _by_row(words, (raw[words.ends - 1] == 33).astype(float), n) / count,
            _distinct_share(word_rows, words.values, n),
            _distinct_share(window_rows, words.window_values(at, 5), n),
        ]
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in slices(batch.column("text")):
            n = len(words.counts)
            table = np.rint(statistics(words, words.offsets) * _UNIT).astype(np.int32)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(words.first, n), pa.ListArray.from_arrays(ends, pa.array(table.ravel()))],
                ["row", "stats"],
            )


def _table(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


class Features:
    """The random map of whitened statistics; the same for the same seed."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray) -> None:
        random = np.random.default_rng(SEED)
        self.mean, self.spread = mean, spread
        self.weights = random.standard_normal((STATISTICS, FEATURES)) / (WIDTH * np.sqrt(STATISTICS))
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        """Whole numbers in [-_STEP, _STEP], as floats; the last column is constant."""
        white = np.clip((stats - self.mean) / self.spread, -6, 6)
        waves = np.rint(np.cos(white @ self.weights + self.phases) * _STEP)
        return np.column_stack([waves, np.full(len(waves), float(_STEP))])


def _equations(features: Features):
    """The partition's sums: row i of the matrix, with its entry of the right side at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2), dtype=np.int64)
        for batch in batches:
            x = features(_table(batch.column("stats")))
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            # whole numbers below 2**53: the products are exact
            total[:, :-1] += (x.T @ x).astype(np.int64)
            total[:, -1] += (x.T @ y).astype(np.int64)
        yield _matrix_rows(np.arange(FEATURES + 1), total)

    return run


def _matrix_rows(names: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(table) + 1, dtype=np.int32) * (FEATURES + 2))
    sums = pa.ListArray.from_arrays(ends, pa.array(table.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), sums], ["i", "sums"])


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((FEATURES + 1, FEATURES + 2), dtype=np.int64)
    for batch in batches:
        sums = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES + 2)
        np.add.at(total, batch.column("i").to_numpy(), sums)
    some = np.flatnonzero(total.any(axis=1))
    if len(some):
        yield _matrix_rows(some, total[some])


def raw_scores(features: Features, weights: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Place of each row's raw score on the grid."""
    return np.clip(np.rint(features(stats) @ weights * _GRID), *_GRID_RANGE).astype(np.int64)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to `values`, by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist(), strict=True):
        blocks.append([value * weight, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(n), total / weight) for total, weight, n in blocks])


def _place(features: Features, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = raw_scores(features, weights, _table(batch.column("stats")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(at)], ["label", "place"])

    return run


def _score(features: Features, weights: np.ndarray, curve: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = raw_scores(features, weights, _table(batch.column("stats")))
            score = curve[at - _GRID_RANGE[0]]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score)], ["row", "score"])

    return run


def quality_scores(
    docs: DataFrame, labels: DataFrame, keep: list[str], train: Column, threshold: float = 0.7
) -> DataFrame:
    """The columns `keep` of each row of `docs` (doc_id, text), score (0 to 1) and predicted.

    `labels` (doc_id, quality) marks documents as good (1) or not (0); a document with several marks
    counts as the rounded mean, null marks count as none. Only labelled rows for which `train` (a
    condition on doc_id) holds are learned from, all of them; a score depends on the text alone. Null
    and empty texts are scored too, from statistics that are all zero. Without anything to learn
    from every score is 0.5. Repeated rows have the same score.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "quality-model")
    ship(spark)
    rows = docs.select(F.struct(F.col("doc_id").alias("key"), *keep).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    measured = rows.mapInArrow(_measure, f"row {kind}, stats array<int>")
    measured = space.keep(measured, "statistics")

    marks = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("label"))
    marks = marks.where(F.coalesce(train, F.lit(False)))
    known = measured.select(F.col("row.key").alias("doc_id"), "stats").join(marks, "doc_id").select("stats", "label")
    known = space.keep(known, "labelled")

    entry = [F.get("stats", F.lit(i)).cast("long") for i in range(STATISTICS)]
    moments = [F.sum(e).alias(f"s{i}") for i, e in enumerate(entry)]
    moments += [F.sum(e * e).alias(f"q{i}") for i, e in enumerate(entry)]
    sums = known.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good"), *moments).first()
    n = sums["n"]
    weights, curve = np.zeros(FEATURES + 1), np.full(_GRID_RANGE[1] - _GRID_RANGE[0] + 1, 0.5)
    mean, spread = np.zeros(STATISTICS), np.ones(STATISTICS)
    if n:
        mean = np.array([sums[f"s{i}"] for i in range(STATISTICS)]) / n
        square = np.array([sums[f"q{i}"] for i in range(STATISTICS)]) / n
        spread = np.sqrt(np.maximum(square - mean**2, 0)) + 0.01 * _UNIT
    features = Features(mean, spread)
    if n:
        parts = known.mapInArrow(_equations(features), "i int, sums array<long>")
        added = parts.repartition("i").mapInArrow(_add_rows, "i int, sums array<long>").collect()
        table = np.zeros((FEATURES + 1, FEATURES + 2))
        for row in added:
            table[row["i"]] = row["sums"]
        table[:, :-1] /= _STEP**2 * n
        table[:, -1] /= _STEP * n
        weights = np.linalg.solve(table[:, :-1] + RIDGE * np.eye(FEATURES + 1), table[:, -1]) / _STEP
        places = known.mapInArrow(_place(features, weights), "label int, place long")
        grid = places.groupBy("place").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
        grid = sorted((r["place"], r["good"], r["n"]) for r in grid)
        at, good, each = (np.array(c, dtype=float) for c in zip(*grid, strict=True))
        fitted = isotonic(good / each, each)
        curve = np.interp(np.arange(_GRID_RANGE[0], _GRID_RANGE[1] + 1), at, fitted)
    done = measured.mapInArrow(_score(features, weights, curve), f"row {kind}, score double")
    return done.select(
        *(F.col("row")[c].alias(c) for c in keep if c not in ("score", "predicted")),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
