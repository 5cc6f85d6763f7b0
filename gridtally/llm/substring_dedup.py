"""Removal of passages that repeat an earlier passage, word for word.

A window is `length` consecutive words. Counting all windows exactly would shuffle each of them, so
a count-min sketch is built first: every partition counts into its own, the partitions' sketches
are added up, and a window goes on only if it may occur twice. The sketch counts, for each window,
the place of its smallest run of `length` - 12 words (a window's runs are a function of its words,
so equal windows count one run at different places): an overestimate of the window's count that
needs one entry for about seven windows. All windows that go on are then grouped exactly, by 128
bits of hash. Each batch hands on only the first of its equal windows and marks the others itself,
so that a passage of a third of all documents makes one row per batch, not per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.cluster import gather, ship
from gridtally.llm.words import Words, mixed, slices

#: Cells of a part of the sketch, as a power of two; a part is the unit of adding up.
_PART_BITS = 21
_DEPTH = 2
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _anchors(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word, row and place of each window; word index and value of its smallest run."""
    at, rows, places = words.windows(length)
    run = max(1, length - 12)
    starts = np.arange(max(len(words.values) - run + 1, 0))
    values = words.window_values(starts, run)
    if not len(at):
        return at, places, at, values
    # a window's runs start at its first length - run + 1 words, all inside the row
    inside = sliding_window_view(values, length - run + 1)
    least = np.empty(len(at), dtype=np.int64)
    for begin in range(0, len(at), 1 << 18):
        part = at[begin : begin + (1 << 18)]
        least[begin : begin + len(part)] = np.argmin(inside[part], axis=1)
    return at, places, at + least, values


def _cells(values: np.ndarray, bits: int) -> list[np.ndarray]:
    shift = np.uint64(64 - bits)
    return [mixed(values ^ (_SPREAD * np.uint64(k))) >> shift for k in range(_DEPTH)]


def _partition_sketch(length: int, bits: int):
    """One row per part that the partition touched: its cells, those counted twice repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gather(batches):
            seen: list[list[np.ndarray]] = [[] for _ in range(_DEPTH)]
            for words in slices(batch.column("text")):
                _, _, anchor, values = _anchors(words, length)
                if len(anchor):
                    for k, cells in enumerate(_cells(values[np.unique(anchor)], bits)):
                        seen[k].append(cells)
            for k, cells in enumerate(seen):
                if not cells:
                    continue
                found, counts = np.unique(np.concatenate(cells), return_counts=True)
                found = np.repeat(found, np.minimum(counts, 2))  # two are as good as many
                parts = (found >> np.uint64(_PART_BITS)).astype(np.int64)
                within = (found & np.uint64((1 << _PART_BITS) - 1)).astype(np.uint32)
                names, begins = np.unique(parts, return_index=True)
                ends = [*begins[1:], len(parts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names * _DEPTH + k, pa.int64()),
                        pa.array([within[b:e].tobytes() for b, e in zip(begins, ends, strict=True)], pa.binary()),
                    ],
                    ["part", "cells"],
                )

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the sketches of all partitions, as one bit per cell: counted twice or more."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells"), strict=True):
            total = totals.get(part)
            if total is None:
                total = totals[part] = np.zeros(1 << _PART_BITS, dtype=np.uint8)
            found, counts = np.unique(np.frombuffer(cells.as_buffer(), np.uint32), return_counts=True)
            total[found] = np.minimum(total[found] + counts, 2)
    if totals:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(totals), pa.int64()),
                pa.array([np.packbits(t >= 2, bitorder="little").tobytes() for t in totals.values()], pa.binary()),
            ],
            ["part", "repeated"],
        )


def repeated_cells(texts: DataFrame, length: int, bits: int) -> list[np.ndarray]:
    """Bit maps of the sketch's cells that count two or more; 2**bits / 8 bytes for each row of the
    sketch, whatever the size of the corpus."""
    sketches = texts.select("text").mapInArrow(_partition_sketch(length, bits), "part long, cells binary")
    added = sketches.repartition("part").mapInArrow(_add_up, "part long, repeated binary")
    maps = [np.zeros(1 << (bits - 3), dtype=np.uint8) for _ in range(_DEPTH)]
    size = 1 << (_PART_BITS - 3)
    for row in added.toLocalIterator():
        part, k = divmod(row["part"], _DEPTH)
        maps[k][part * size : (part + 1) * size] = np.frombuffer(row["repeated"], np.uint8)
    return maps


def _maybe_repeated(maps: list[np.ndarray], values: np.ndarray, bits: int) -> np.ndarray:
    hit = np.ones(len(values), dtype=bool)
    for bitmap, cells in zip(maps, _cells(values, bits), strict=True):
        hit &= (bitmap[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit


def _candidates(length: int, bits: int, maps):
    """Windows that may repeat: the first of equal ones with its hash, the others as marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gather(batches):
            parts = []
            for words in slices(batch.column("text")):
                at, places, anchor, values = _anchors(words, length)
                hit = _maybe_repeated(maps.value, values[anchor], bits)
                if not hit.any():
                    continue
                at, places = at[hit], places[hit]
                rows = np.searchsorted(words.begins(), at, "right") - 1 + words.first
                both = (words.window_values(at, length, seed) for seed in (0, 1))
                parts.append([*both, rows, places])
            if not parts:
                continue
            low, high, rows, places = (np.concatenate(x) for x in zip(*parts, strict=True))
            ids = batch.column("doc_id")
            ids = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            ties = batch.column("tie").to_numpy(zero_copy_only=False)
            order = np.lexsort((places, ties[rows], ids[rows], high, low))
            low, high, rows, places = low[order], high[order], rows[order], places[order]
            first = np.ones(len(low), dtype=bool)
            first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            leader = np.maximum.accumulate(np.where(first, np.arange(len(low)), 0))
            # a repeated row holds the same occurrence, not a later one
            later = (ids[rows] != ids[rows[leader]]) | (ties[rows] != ties[rows[leader]]) | (places != places[leader])
            yield _rows(batch, rows[first], low[first], high[first], places[first], None)
            if later.any():
                yield _marks(batch, rows[later], places[later])

    return run


_CANDIDATE = "doc_id long, tie int, low long, high long, place int, marks array<int>"


def _rows(batch, rows, low, high, places, marks) -> pa.RecordBatch:
    take = pa.array(rows)
    empty = pa.nulls(len(rows), pa.list_(pa.int32())) if marks is None else marks
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(take),
            batch.column("tie").take(take),
            pa.array(low.view(np.int64)),
            pa.array(high.view(np.int64)) if high is not None else pa.nulls(len(rows), pa.int64()),
            pa.array(places.astype(np.int32)) if places is not None else pa.nulls(len(rows), pa.int32()),
            empty,
        ],
        ["doc_id", "tie", "low", "high", "place", "marks"],
    )


def _marks(batch, rows, places) -> pa.RecordBatch:
    order = np.lexsort((places, rows))
    rows, places = rows[order], places[order]
    names, begins = np.unique(rows, return_index=True)
    ends = np.append(begins, len(rows)).astype(np.int32)
    marks = pa.ListArray.from_arrays(pa.array(ends), pa.array(places.astype(np.int32)))
    # a key of their own, so that they spread over all tasks
    return _rows(batch, names, mixed(names.astype(np.uint64) + np.uint64(len(rows))), None, None, marks)


def _without(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, places in zip(batch.column("text"), batch.column("places"), strict=True):
                # bytes.split() cuts at the same six bytes
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                total.append(len(words))
                if places.is_valid and len(places):
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    starts = np.unique(places.values.to_numpy(zero_copy_only=False))
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + length, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    words = [words[k] for k in np.flatnonzero(stay).tolist()]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def without_repeats(docs: DataFrame, length: int = 20, sketch_bits: int = 27) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of `docs` (doc_id, text).

    Words covered by a window of `length` words that also starts earlier (smaller doc_id, or same
    document and earlier start) are removed; what is kept is joined by one space. Windows are judged
    on the input. Null and empty texts have no words. A null doc_id counts as the smallest. Rows
    that repeat a doc_id and its text are one document, each with the same result; rows with the
    doc_id of another text are ordered by a hash of the text. Other columns are ignored.

    `sketch_bits` sets the sketch's memory (2**bits / 4 bytes on each worker) and how many windows
    it spares the shuffle; the result does not depend on it.
    """
    spark = docs.sparkSession
    ship(spark)
    bits = max(sketch_bits, _PART_BITS)
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.expr("cast(pmod(xxhash64(text), 2147483647) as int)").alias("tie"))
    maps = spark.sparkContext.broadcast(repeated_cells(texts, length, bits))
    windows = texts.mapInArrow(_candidates(length, bits, maps), _CANDIDATE)
    same = Window.partitionBy("low", "high").orderBy("doc_id", "tie", "place")
    later = windows.withColumn("n", F.rank().over(same)).where("n > 1 OR marks IS NOT NULL")
    places = F.concat(F.collect_list("place"), F.flatten(F.collect_list("marks")))
    marked = later.groupBy("doc_id", "tie").agg(places.alias("places"))
    marked = marked.select(F.col("doc_id").alias("id"), F.col("tie").alias("same"), "places")
    match = texts["doc_id"].eqNullSafe(marked["id"]) & (texts["tie"] == marked["same"])
    held = texts.join(marked, match, "left").select("doc_id", "text", "places")
    return held.mapInArrow(_without(length), "doc_id long, n_words long, n_removed long, kept_text string")
