"""Best-fit packing of documents into sequences of at most `capacity` tokens, planned on lengths.

The plan needs the number of pieces of each length only: at most `capacity` numbers, whatever the
corpus. Lengths are placed from the longest down, each into the sequences with the least room that
holds it, all pieces of a length and all sequences of one room at once. The plan says for runs of
ranks within a length which sequences they go to; pieces then take their slot by a join on their
rank within the length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.byte_tokens import byte_tokens
from gridtally.llm.cluster import Workspace, ship

#: Runs of slots: ranks [first, first + n) of a length; the piece of rank r goes to the sequence
#: first_sequence + (r - first) // each, at offset + (r - first) % each * length.
_PLAN = "length int, first long, n long, first_sequence long, each int, offset int"


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over the number of pieces of each length, as rows of `_PLAN`."""
    # runs of sequences (first, how many) by the room that is left in them
    rooms: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    out, opened = [], 0

    def fill(first: int, n: int, room: int, rank: int, length: int) -> None:
        """Put the pieces from `rank` into a run of sequences, as many into each as it holds."""
        each = room // length
        full, rest = divmod(min(counts[length] - rank, n * each), each)
        if full:
            out.append((length, rank, full * each, first, each, capacity - room))
            rooms[room - each * length].append((first, full))
        if rest:
            out.append((length, rank + full * each, rest, first + full, each, capacity - room))
            rooms[room - rest * length].append((first + full, 1))
        left = n - full - bool(rest)
        if left:
            rooms[room].append((first + n - left, left))

    for length in sorted(counts, reverse=True):
        rank = 0
        for room in range(length, capacity + 1):
            runs, rooms[room] = rooms[room], []
            for first, n in runs:
                if rank < counts[length]:
                    fill(first, n, room, rank, length)
                    rank = min(counts[length], rank + n * (room // length))
                else:
                    rooms[room].append((first, n))
        if rank < counts[length]:
            new = -(-(counts[length] - rank) // (capacity // length))
            fill(opened, new, capacity, rank, length)
            opened += new
    return out


def _pieces(path: str, capacity: int, end_id: int, added: bool, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(path, added)
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids, counts = tokens.encode(batch.column("text"), end_id)
            if not len(counts):
                continue
            n = -(-counts // capacity)
            rows = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            # the first piece of a document is the short one
            short = counts - (n - 1) * capacity
            length = np.where(piece == 0, short[rows], capacity)
            start = np.where(piece == 0, 0, short[rows] + (piece - 1) * capacity)
            # numbers within the length in this partition
            order = np.argsort(length, kind="stable")
            place = np.empty(len(length), np.int64)
            begins = np.searchsorted(length[order], length[order])
            place[order] = np.arange(len(order)) - begins
            place += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            cuts = np.concatenate(([0], np.cumsum(length))) * 4
            raw = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows)).cast(id_type),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    raw.cast(pa.binary()),
                    pa.array(np.full(len(length), part, np.int32)),
                    pa.array(place),
                ],
                ["doc_id", "piece", "start", "length", "ids", "part", "place"],
            )

    return run


@dataclass
class Packed:
    """`pieces` (doc_id, piece, start, length, ids, part, place) and `slots` (part, length, place,
    sequence_id, offset): one slot for each piece."""

    pieces: DataFrame
    slots: DataFrame
    n_sequences: int
    capacity: int

    def placed(self, pieces: DataFrame | None = None) -> DataFrame:
        """Pieces, or what the caller made of each of them, with sequence_id and offset."""
        rows = self.pieces if pieces is None else pieces
        return rows.join(self.slots, ["part", "length", "place"]).drop("part", "place")

    def sequences(self) -> DataFrame:
        """(sequence_id, n_tokens, ids): the ids of each sequence, as 32-bit little-endian integers."""
        held = self.placed().groupBy("sequence_id").agg(
            F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held")
        )
        joined = F.aggregate("held", F.lit(b""), lambda whole, x: F.concat(whole, x["ids"]))
        return held.select("sequence_id", "n_tokens", joined.alias("ids"))


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 1024, added: bool = False) -> Packed:
    """Pack all rows of `docs` (doc_id, text) into sequences of at most `capacity` tokens.

    A document is the ids of its text and `end_id`; null and empty texts have the end id alone. Only
    documents longer than `capacity` are cut, into pieces of `capacity` tokens; the first piece is
    the shorter one. Rows are documents: repeated rows are packed each, a null doc_id stays null.
    Other columns are ignored. An empty table has no sequence. `added`: the content of an added token
    in a text has that token's id. Pieces and slots are tables in the shared folder.
    """
    if capacity < 1:
        raise ValueError("a sequence holds at least one token")
    spark = docs.sparkSession
    ship(spark)
    from pyspark.sql.pandas.types import to_arrow_type

    space = Workspace(spark, "packing")
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType
    columns = f"doc_id {kind.simpleString()}, piece int, start long, length long, ids binary, part int, place long"
    cut = texts.mapInArrow(_pieces(path, capacity, end_id, added, to_arrow_type(kind)), columns)
    pieces = space.keep(cut, "pieces")

    counts = space.keep(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(lengths, capacity)
    n_sequences = max((first + -(-n // each) for _, _, n, first, each, _ in runs), default=0)

    # ranks [low, high) of a length that a partition's pieces hold: one row for each partition
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.sum("n").over(before), F.lit(0))
    held = counts.withColumn("low", low).withColumn("high", F.col("low") + F.col("n")).drop("n")
    wide = spark.createDataFrame(runs, _PLAN).withColumn("length", F.col("length").cast("long"))
    begin, stop = F.greatest("low", "first"), F.least("high", F.col("first") + F.col("n"))
    both = held.join(wide, "length").where(begin < stop)
    ranks = both.withColumn("rank", F.explode(F.sequence(begin, stop - 1)))
    slots = ranks.select(
        "part",
        "length",
        (F.col("rank") - F.col("low")).alias("place"),
        F.expr("first_sequence + (rank - first) div each").alias("sequence_id"),
        F.expr("offset + (rank - first) % each * length").alias("offset"),
    )
    return Packed(pieces, slots, n_sequences, capacity)
