"""SentencePiece encoding by merges, and decoding.

A text is normalised (spaces become U+2581, one goes in front) and cut before each run of U+2581
that follows another character. No piece of the vocabulary holds such a cut (this is verified), so
no merge can cross one, and the parts of a text are encoded one by one. A part's adjacent symbol
pairs wait in an agenda ordered by score, then place; the best pair is merged until none is left.
Each distinct part is encoded once per worker and compared with what the library makes of it, and so
is a whole text of each batch; a difference fails the job. Vocabulary files must lie at the same path
on every machine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import ship
from gridtally.llm.units import Units, row_slices, strings
from gridtally.llm.words import flat

SPACE = "▁"
#: Ids that are decoded at once, as Python objects; a longer text's all at once.
_DECODED = 1 << 16
_PART = re.compile(f"{SPACE}+[^{SPACE}]*")


class Pieces:
    """A merge vocabulary with byte fallback, as in models of the kind `BPE`."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        plain = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        types = proto.ModelProto.SentencePiece
        if (
            model.trainer_spec.model_type != proto.TrainerSpec.BPE
            or not model.trainer_spec.byte_fallback
            or model.trainer_spec.treat_whitespace_as_suffix
            or plain.precompiled_charsmap
            or not plain.add_dummy_prefix
            or plain.remove_extra_whitespaces
            or not plain.escape_whitespaces
            or kinds & {types.USER_DEFINED, types.UNUSED}
        ):
            raise ValueError("only merge vocabularies with byte fallback and no normalisation rules")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = self.library.eos_id()
        self.merges: dict[str, tuple[float, int]] = {}
        self.bytes: dict[int, int] = {}
        for i, p in enumerate(model.pieces):
            if p.type == types.NORMAL:
                self.merges[p.piece] = (p.score, i)
            elif p.type == types.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        if any(SPACE in p.lstrip(SPACE) for p in self.merges):
            raise ValueError("a piece holds a space after another character")
        self.units = Units(self._unit_ids)

    def parts(self, text: str) -> list[str]:
        return _PART.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def merged(self, part: str) -> list[int]:
        """Ids of one part, by the agenda."""
        merges, symbols = self.merges, list(part)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in merges:
                agenda.append((-merges[pair][0], i, len(pair)))
        heapify(agenda)
        while agenda:
            _, i, length = heappop(agenda)
            left, j = symbols[i], after[i]
            # symbols only grow, so the length tells if the pair is still the one that was noted
            if not left or j >= n or len(left) + len(symbols[j]) != length:
                continue
            left = symbols[i] = left + symbols[j]
            symbols[j] = ""
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                pair = left + symbols[j]
                if pair in merges:
                    heappush(agenda, (-merges[pair][0], i, len(pair)))
            h = before[i]
            if h >= 0:
                pair = symbols[h] + left
                if pair in merges:
                    heappush(agenda, (-merges[pair][0], h, len(pair)))
        ids = []
        for symbol in symbols:
            if symbol in merges:
                ids.append(merges[symbol][1])
            elif symbol:
                ids.extend(self.bytes[b] for b in symbol.encode("utf-8"))
        return ids

    def _checked(self, units: list[str]) -> list[list[int]]:
        """Ids of units (parts with their spaces as in the text), compared with the library's."""
        out = []
        for unit, expected in zip(units, self.library.encode([u[1:] for u in units], num_threads=1), strict=True):
            part = unit.replace(" ", SPACE)
            ids = self.merged(part)
            # the library gives nothing for the lone space of an empty text, which no text holds
            if ids != expected and part != SPACE:
                raise RuntimeError(f"ids of {part!r} are {ids}, by the library {expected}")
            out.append(ids)
        return out

    def _unit_ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, and how many each has."""
        found = self._checked(strings(raw, offsets).to_pylist())
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, counts.sum()), counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and the number of each text's
        ids with it. Null is empty."""
        # a space goes in front of a text; U+2581 in a text is the same symbol as a space
        spaced = pc.replace_substring(texts.fill_null(""), SPACE, " ")
        spaced = pc.if_else(pc.equal(spaced, ""), "", pc.binary_join_element_wise(" ", spaced, ""))
        raw, offsets = flat(spaced)
        parts = []
        for row, end in row_slices(offsets):
            part, own = raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            space = part == 0x20
            begins = space.copy()
            begins[1:] &= ~space[:-1]
            begins[own[:-1][np.diff(own) > 0]] = True
            parts.append(self.units.ids_of(part, own, begins, self.end))
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        if ids[: counts[0]].tolist() != self.library.encode(texts[0].as_py() or "", add_eos=True):
            raise RuntimeError("ids of a whole text differ from the library's")
        return ids, counts

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of ids that lie between the `ends`, by the library, some rows at a time."""
        parts = []
        for row, end in row_slices(ends, _DECODED):
            listed = [ids[a:b].tolist() for a, b in zip(ends[row:end], ends[row + 1 : end + 1], strict=True)]
            parts.append(pa.array(self.library.decode(listed), pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def as_texts(column: pa.Array) -> list[str]:
    """Strings of a column; null is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            ids, counts = vocabulary.encode(batch.column("text"))
            ends = np.concatenate(([0], np.cumsum(counts)))
            decoded = vocabulary.decode(ids, ends)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), lists, decoded], ["row", "ids", "decoded"]
            )

    return run


def encode_decode(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of each row of `docs` (text), `ids` with the end id, and `decoded`.

    Null and empty texts have the end id only and decode to an empty text. Rows are independent:
    repeated rows give repeated results. Other columns, whatever their names, are left out; a column
    of `keep` called ids or decoded gives way to the new one.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(_encode(path), f"row {kind}, ids array<int>, decoded string")
    return done.select(*(f"row.{c}" for c in keep if c not in ("ids", "decoded")), "ids", "decoded")


def digests(ids: Column, decoded: Column) -> list[Column]:
    """n_tokens, ids_sha256 and decoded_sha256."""
    listed = F.array_join(ids.cast("array<string>"), " ")
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    ]
