"""Ids of a byte-level vocabulary by the tokenizers library, for columns of texts at once.

The vocabulary's pattern lets a run of white space go with the word behind it only, so a text can be
cut in front of each such run, and its units are encoded apart from each other: each distinct unit is
given to the library once. A text with white space beyond ASCII is one unit. New units go to the library
some in a row, as a text that can be cut between them; the bytes that each id stands for tell which
ids are whose.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridtally.llm.units import Units, row_slices, strings
from gridtally.llm.words import flat, is_gap

#: Bytes of new units that go to the library as one text.
_ROW_BYTES = 512

#: White space beyond ASCII, whose runs with ASCII white space must not be cut.
_OTHER_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


class ByteTokens:
    """The tokenizers library on columns of texts, with a memory of units.

    With `added` the content of an added token, such as <|endoftext|>, has that token's id, as in the
    library as loaded, and a text that holds one is one unit; without, it is text like any other.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not added
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()] if added else []
        self.size = self.library.get_vocab_size()
        self.widths = self._widths(ByteLevel.alphabet())
        self.units = Units(self._unit_ids)

    def _widths(self, alphabet: list[str]) -> np.ndarray | None:
        """Bytes that each id stands for; None if the vocabulary lacks the id of a byte."""
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        if not vocabulary.keys() >= set(alphabet):
            return None
        widths = np.zeros(1 + max(self.library.get_vocab().values()), np.int64)
        for piece, i in vocabulary.items():
            widths[i] = len(piece)
        for i, token in self.library.get_added_tokens_decoder().items():
            widths[i] = len(token.content.encode("utf-8"))
        return widths

    def _uncut(self, texts: pa.Array) -> np.ndarray:
        """Whether each text is not to be cut: white space beyond ASCII, or an added token."""
        uncut = pc.match_substring_regex(texts, _OTHER_SPACE)
        for content in self.added:
            uncut = pc.or_(uncut, pc.match_substring(texts, content))
        return uncut.fill_null(False).to_numpy(zero_copy_only=False)

    def _unit_ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, and how many each has."""
        units = strings(raw, offsets)
        if self.widths is None:
            found = [c.ids for c in self.library.encode_batch_fast(units.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        # a unit that begins with white space and does not end with it can follow another such unit
        lone = self._uncut(units) | ~is_gap(raw[offsets[:-1]]) | is_gap(raw[offsets[1:] - 1])
        begins = lone.copy()
        begins[1:] |= lone[:-1] | (np.diff(offsets[:-1] // _ROW_BYTES) > 0)
        begins[:1] = True
        rows = strings(raw, np.append(offsets[:-1][begins], offsets[-1])).to_pylist()
        found = [c.ids for c in self.library.encode_batch_fast(rows, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32)
        stops = np.cumsum(self.widths[ids])
        last = np.searchsorted(stops, offsets[1:])
        if len(stops) != (last[-1] + 1 if len(last) else 0) or (stops[last] != offsets[1:]).any():
            raise RuntimeError("ids of units do not stand for the bytes of the units")
        return ids, np.diff(last, prepend=-1)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each followed by `end_id`, and the number of each
        text's ids with it. Null is empty."""
        uncut = self._uncut(texts)
        raw, offsets = flat(texts)
        parts = []
        for row, end in row_slices(offsets):
            part, own = raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            gap = is_gap(part)
            begins = gap.copy()
            begins[1:] &= ~gap[:-1]
            for k in np.flatnonzero(uncut[row:end]):
                begins[own[k] : own[k + 1]] = False
            begins[own[:-1][np.diff(own) > 0]] = True
            parts.append(self.units.ids_of(part, own, begins, end_id))
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        own = self.whole(texts[0].as_py() or "")
        if counts[0] != 1 + len(own) or (ids[: counts[0] - 1] != own).any():
            raise RuntimeError("ids of a whole text differ from those of its units")
        return ids, counts


@lru_cache(maxsize=2)
def byte_tokens(path: str, added: bool = False) -> ByteTokens:
    return ByteTokens(path, added)
