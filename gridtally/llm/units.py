"""Ids of the units of texts (a word with the white space before it), each unit encoded once.

A worker remembers the bytes and ids of units; those of a column are looked up by a hash, compared
byte by byte and replaced by their ids in numpy arrays, without a Python object per word. A full
memory keeps the units that were met again since they came in, or since it was last full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from gridtally.llm.words import SLICE_BYTES, run_values

#: Units, and bytes of them, that a worker remembers before it drops those it did not meet again.
_MOST_UNITS, _MOST_BYTES = 500_000, 32 << 20


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind) -> None:
        self.held, self.size = np.zeros(1024, kind), 0

    def extend(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            self.held = np.concatenate((self.held[: self.size], np.zeros(max(size, 2 * self.size), self.held.dtype)))
        self.held[self.size : size] = values
        self.size = size


class _Places:
    """Place of each 64-bit value among those put in, by open addressing in numpy."""

    def __init__(self) -> None:
        self.keys, self.places, self.count = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32), 0

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 if it is not there."""
        mask = np.uint64(len(self.keys) - 1)
        at = values & mask
        seen = self.keys[at]
        out = np.where(seen == values, self.places[at], np.int32(-1)).astype(np.int64)
        todo = np.flatnonzero((seen != values) & (seen != 0))
        while len(todo):
            at[todo] = (at[todo] + np.uint64(1)) & mask
            seen = self.keys[at[todo]]
            hit = seen == values[todo]
            out[todo[hit]] = self.places[at[todo[hit]]]
            todo = todo[~hit & (seen != 0)]
        return out

    def put(self, values: np.ndarray, places: np.ndarray) -> None:
        """Add distinct values that are not there yet."""
        self.count += len(values)
        if 2 * self.count > len(self.keys):
            full = self.keys != 0
            values, places = np.concatenate((self.keys[full], values)), np.concatenate((self.places[full], places))
            size = 1 << (2 * self.count).bit_length()
            self.keys, self.places = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        mask = np.uint64(len(self.keys) - 1)
        at = values & mask
        todo = np.arange(len(values))
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            self.keys[at[free]] = values[free]  # of several values for one slot the last stays
            done = self.keys[at[todo]] == values[todo]
            self.places[at[todo[done]]] = places[todo[done]]
            todo = todo[~done]
            at[todo] = (at[todo] + np.uint64(1)) & mask


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Index of each element of runs that start and go on as given, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class Units:
    """Encodes texts by their units. `encode` takes the bytes of some new units one after the other,
    with each unit's offset and the end, and gives their ids and how many each unit has."""

    def __init__(self, encode: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> None:
        self.encode = encode
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.bytes, self.ids, self.met = _Grown(np.uint8), _Grown(np.uint32), _Grown(bool)
        # first byte and first id of each unit, and one more
        self.from_byte, self.from_id = _Grown(np.int64), _Grown(np.int64)
        self.from_byte.extend(np.zeros(1, np.int64))
        self.from_id.extend(np.zeros(1, np.int64))

    def _add(self, values: np.ndarray, raw: np.ndarray, n_bytes: np.ndarray, ids: np.ndarray, n_ids: np.ndarray) -> None:
        first = self.met.size
        self.from_byte.extend(self.bytes.size + np.cumsum(n_bytes))
        self.from_id.extend(self.ids.size + np.cumsum(n_ids))
        self.bytes.extend(raw)
        self.ids.extend(ids)
        self.met.extend(np.zeros(len(values), bool))
        self.places.put(values, np.arange(first, first + len(values)))

    def _learn(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> None:
        lengths = ends - starts
        units = raw[_runs(starts, lengths)]
        ids, n_ids = self.encode(units, np.concatenate(([0], np.cumsum(lengths))))
        self._add(values, units, lengths, ids, n_ids)

    def _make_room(self) -> None:
        """Keep the units that were met again, if they are few enough, else none."""
        known = np.flatnonzero(self.places.keys)
        known = known[self.met.held[self.places.places[known]]]
        values, at = self.places.keys[known], self.places.places[known].astype(np.int64)
        from_byte, n_bytes = self.from_byte.held[at], self.from_byte.held[at + 1] - self.from_byte.held[at]
        from_id, n_ids = self.from_id.held[at], self.from_id.held[at + 1] - self.from_id.held[at]
        few = 2 * len(at) <= _MOST_UNITS and 2 * n_bytes.sum() <= _MOST_BYTES
        raw, ids = self.bytes.held, self.ids.held
        self._forget()
        if few and len(at):
            self._add(values, raw[_runs(from_byte, n_bytes)], n_bytes, ids[_runs(from_id, n_ids)], n_ids)

    def _look_up(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """The place of each unit in the memory; None if units have the hash of others."""
        if self.places.count > _MOST_UNITS or self.bytes.size > _MOST_BYTES:
            self._make_room()
        values = run_values(raw, starts, ends)
        values[values == 0] = 1
        at = self.places.find(values)
        new = np.flatnonzero(at < 0)
        if len(new):
            self.met.held[at[at >= 0]] = True
            _, first = np.unique(values[new], return_index=True)
            first = new[first]
            self._learn(raw, starts[first], ends[first], values[first])
            at[new] = self.places.find(values[new])
        else:
            self.met.held[at] = True
        lengths, from_byte = ends - starts, self.from_byte.held
        if (from_byte[at + 1] - from_byte[at] != lengths).any():
            return None
        known = np.repeat(from_byte[at] - starts, lengths) + np.arange(len(raw))
        return at if (self.bytes.held[known] == raw).all() else None

    def ids_of(self, raw: np.ndarray, offsets: np.ndarray, begins: np.ndarray, end_id: int):
        """Ids of all texts one after the other, each followed by `end_id`, and how many each has.
        begins: whether a unit begins at a byte; the first byte of a text does."""
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(raw))[: len(starts)]
        at = self._look_up(raw, starts, ends)
        if at is None:  # the units of each text by themselves
            rows = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = starts[(starts >= a) & (starts < b)]
                ids = self.encode(raw[a:b], np.append(own, b) - a)[0] if len(own) else []
                rows.append(np.append(ids, end_id).astype(np.uint32))
            return np.concatenate(rows), np.array([len(r) for r in rows])
        # ids of the units of each row, with a place for the end id behind them
        rows = np.searchsorted(starts, offsets[1:])
        n_ids = self.from_id.held[at + 1] - self.from_id.held[at]
        before = np.concatenate(([0], np.cumsum(n_ids)))
        stops = before[rows] + np.arange(1, len(rows) + 1)
        ids = np.empty(before[-1] + len(rows), np.uint32)
        taken = np.ones(len(ids), dtype=bool)
        taken[stops - 1] = False
        ids[~taken] = end_id
        ids[taken] = self.ids.held[np.repeat(self.from_id.held[at] - before[:-1], n_ids) + np.arange(before[-1])]
        return ids, np.diff(stops, prepend=0)


def strings(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A column of the texts between the offsets."""
    held = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, held)


def row_slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Rows of about `size` each, one at least, which bounds the memory of the arrays."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = min(max(int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1, row + 1), n)
        yield row, end
        row = end
