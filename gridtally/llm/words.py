"""Words of a batch of texts as numpy arrays, without a Python object per word.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. In UTF-8 no other character holds these bytes, so this is the pattern
`[^\\x20\\x09-\\x0D]+` on characters. A word's value is a 64-bit hash of its bytes; a window's value
is one or two 64-bit hashes of its words' values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about so many bytes, which bounds the memory of the arrays.
SLICE_BYTES = 1 << 19
#: Bytes, or windows, hashed at once within a slice, as one text can be longer than a slice.
_BLOCK = 1 << 16

_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters and digits, for comparisons that ignore punctuation.
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[b for b in range(128) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASES = (0xD6E8FEB86659FD93, 0xA24BAED4963EE407)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit depends on all others."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base, and of its inverse, modulo 2**64."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        have = _tables[base] = (both[0], both[1])
    return have


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    """Sums over prefixes of value * base**position; a difference of two is a run's hash."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


@dataclass
class Words:
    """Words of consecutive rows: rows [first, first + len(counts))."""

    first: int
    bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    values: np.ndarray
    offsets: np.ndarray

    def begins(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the first word, row and place in the row of each window within a row."""
        per_row = np.maximum(self.counts - length + 1, 0)
        rows = np.repeat(np.arange(len(per_row)), per_row)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        return self.begins()[rows] + places, rows, places

    def window_values(self, at: np.ndarray, length: int | np.ndarray, seed: int = 0) -> np.ndarray:
        """Hash of the window of `length` words that starts at each word index."""
        base = _WORD_BASES[seed]
        lengths = np.broadcast_to(np.asarray(length, dtype=np.int64), at.shape)
        out = np.empty(len(at), dtype=np.uint64)
        # a window's hash does not depend on where it starts, so blocks bound the sums and powers
        for b in range(0, len(at), _BLOCK):
            part, size = at[b : b + _BLOCK], lengths[b : b + _BLOCK]
            low = part.min()
            part = part - low
            values = self.values[low : low + (part + size).max()]
            sums = _sums(values, base)
            inverse = _powers(base, len(values) + 1)[1]
            out[b : b + _BLOCK] = mixed((sums[part + size] - sums[part]) * inverse[part] + size.astype(np.uint64))
        return out


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and each text's offset; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array | pa.ChunkedArray, lower: bool = False, marks: bool = False) -> Iterator[Words]:
    """The words of a column, some rows at a time. lower: A-Z count as a-z. marks: ASCII punctuation
    is between words, too."""
    raw, offsets = flat(texts)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), n)
        part = raw[offsets[row] : offsets[end]]
        yield _words(_LOWER[part] if lower else part, offsets[row : end + 1] - offsets[row], row, _MARKS if marks else _GAP)
        row = end


def is_gap(raw: np.ndarray) -> np.ndarray:
    """Whether each byte is ASCII white space."""
    return _GAP[raw]


def run_values(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each run."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        # as many runs as end within a block of bytes, one at least
        low = starts[first]
        last = max(int(np.searchsorted(ends, low + _BLOCK, "right")), first + 1)
        begin, end = starts[first:last] - low, ends[first:last] - low
        sums = _sums(raw[low : low + end[-1]].astype(np.uint64) + np.uint64(1), _BYTE_BASE)
        values = (sums[end] - sums[begin]) * _powers(_BYTE_BASE, int(end[-1]) + 1)[1][begin]
        out[first:last] = mixed(values + (end - begin).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        first = last
    return out


def _words(raw: np.ndarray, offsets: np.ndarray, first: int, gaps: np.ndarray) -> Words:
    inside = ~gaps[raw]
    before = np.zeros(len(raw), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(raw), dtype=bool)
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    values = run_values(raw, starts, ends)
    return Words(first, raw, starts, ends, counts, values, offsets)
