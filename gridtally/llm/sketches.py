"""How often hashed values occur, in a table of fixed size that is added up on the cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_PART = 1 << 12
#: Least count of each level from 1 on: 1 to 32, then eight levels for each doubling, up to 2**33.
_LEAST = np.concatenate((np.arange(1, 32), np.ceil(32 * 2 ** (np.arange(224) / 8)).astype(np.int64)))


def level(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte each: exact up to 32, above that in steps of a tenth, in the order of the counts."""
    return np.searchsorted(_LEAST, counts, side="right").astype(np.uint8)


def _counted(values_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for cells in values_of(batch):
                found, times = np.unique(cells, return_counts=True)
                total[found] += times
        full = [b for b in range(0, size, _PART) if total[b : b + _PART].any()]
        if full:
            raw = [total[b : b + _PART].tobytes() for b in full]
            parts = pa.array([b // _PART for b in full], pa.int32())
            yield pa.RecordBatch.from_arrays([parts, pa.array(raw, pa.binary())], ["part", "counts"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
            counts = np.frombuffer(raw.as_buffer(), np.int64)
            totals[part] = totals[part] + counts if part in totals else counts
    if totals:
        raw = [level(t).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array(raw, pa.binary())], ["part", "levels"]
        )


def cell_levels(rows: DataFrame, values_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], size: int) -> np.ndarray:
    """How often each number below `size` is among what `values_of` makes of the rows' batches, as `level`.

    Each task sends a table of `size` numbers at most, in parts that are added up on the cluster; the
    driver gets each part once, a byte for each number, in one job.
    """
    parts = rows.mapInArrow(_counted(values_of, size), "part int, counts binary")
    total = np.zeros(size, dtype=np.uint8)
    for row in parts.repartition("part").mapInArrow(_added, "part int, levels binary").collect():
        levels = np.frombuffer(row["levels"], np.uint8)
        total[row["part"] * _PART : row["part"] * _PART + len(levels)] = levels
    return total
