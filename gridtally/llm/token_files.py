"""Token ids in packed files.

A file holds the ids of consecutive documents, each id in the least number of bits that the
vocabulary needs, low bit first. Ids are cut into blocks of `BLOCK` that start at whole bytes.

    magic "GTID", version, bits         6 bytes
    blocks                              each ceil(ids * bits / 8) bytes
    block offsets                       unsigned 64-bit, one more than blocks
    document ids                        signed 64-bit; a null is marked in the next array
    document has an id                  one byte each
    document starts                     unsigned 64-bit, in ids; one more than documents
    blocks, documents, ids, footer at   unsigned 64-bit each

All numbers are little-endian. An id at place p lies in block p // BLOCK at bit (p % BLOCK) * bits,
so any range of ids is read by reading its blocks only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.llm.byte_tokens import byte_tokens
from gridtally.llm.cluster import ship

MAGIC, VERSION, BLOCK = b"GTID", 1, 4096
#: Ids unpacked at once while a file is read.
_READ = 256 * BLOCK


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):  # the same bytes, without a step per bit
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids[:, None].astype(np.uint32) >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype("<u4")
    each = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    return (each.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    """Writes one file; ids of documents come in order."""

    def __init__(self, sink, bits: int) -> None:
        self.sink, self.bits = sink, bits
        self.at = 0
        self._put(MAGIC + bytes([VERSION, bits]))
        self.offsets, self.starts = [self.at], [0]
        self.names: list[int | None] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def add(self, names: list[int | None], ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents in a row: their names, all their ids, and how many each has."""
        self.names.extend(names)
        self.starts.extend((self.starts[-1] + np.cumsum(counts)).tolist())
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            self._blocks(self.n_waiting // BLOCK * BLOCK)

    def _blocks(self, n: int) -> None:
        ids = np.concatenate(self.waiting)
        for begin in range(0, n, BLOCK):
            self._put(pack(ids[begin : min(begin + BLOCK, n)], self.bits))
            self.offsets.append(self.at)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        if self.n_waiting:
            self._blocks(self.n_waiting)
        footer = self.at
        self._put(np.array(self.offsets, "<u8").tobytes())
        self._put(np.array([0 if n is None else n for n in self.names], "<i8").tobytes())
        self._put(np.array([n is not None for n in self.names], "u1").tobytes())
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array([len(self.offsets) - 1, len(self.names), self.starts[-1], footer], "<u8").tobytes())


class Reader:
    """Random access to the ids of one file."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        head = source.read_at(6, 0)
        if head[:4] != MAGIC or head[4] != VERSION:
            raise ValueError("not a file of token ids")
        self.bits = head[5]
        blocks, docs, self.n_ids, at = (int(x) for x in np.frombuffer(source.read_at(32, size - 32), "<u8"))
        foot = source.read_at(size - 32 - at, at)
        self.offsets = np.frombuffer(foot, "<u8", blocks + 1)
        at = 8 * (blocks + 1)
        names = np.frombuffer(foot, "<i8", docs, at)
        known = np.frombuffer(foot, "u1", docs, at + 8 * docs)
        self.starts = np.frombuffer(foot, "<u8", docs + 1, at + 9 * docs).astype(np.int64)
        self.names = [int(n) if k else None for n, k in zip(names, known, strict=True)]

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids at places [begin, end)."""
        if end <= begin:
            return np.zeros(0, "<u4")
        first, last = begin // BLOCK, (end - 1) // BLOCK
        raw = self.source.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        held = []
        for block in range(first, last + 1):
            n = min(BLOCK, self.n_ids - block * BLOCK)
            low, high = (int(self.offsets[b] - self.offsets[first]) for b in (block, block + 1))
            held.append(unpack(raw[low:high], n, self.bits))
        return np.concatenate(held)[begin - first * BLOCK : end - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Document id, start and ids, read some documents at a time."""
        row, n = 0, len(self.names)
        while row < n:
            end = int(np.searchsorted(self.starts, self.starts[row] + _READ, "right")) - 1
            end = min(max(end, row + 1), n)
            base = int(self.starts[row])
            ids = self.ids(base, int(self.starts[end]))
            for k in range(row, end):
                yield self.names[k], int(self.starts[k]), ids[self.starts[k] - base : self.starts[k + 1] - base]
            row = end


def _write(path: str, end_id: int, folder: str, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(path, added)
        store, root = fs.FileSystem.from_uri(folder)
        # a name of its own for each attempt: what a lost one leaves is in no list
        name = f"{root}/{uuid.uuid4().hex}.ids"
        writer = sink = None
        for batch in batches:
            if writer is None:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(name)
                writer = Writer(sink, bits_for(max(tokens.size, end_id + 1)))
            writer.add(batch.column("doc_id").to_pylist(), *tokens.encode(batch.column("text"), end_id))
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                    "file": pa.array([name.rsplit("/", 1)[1]]),
                    "n_documents": pa.array([len(writer.names)], pa.int64()),
                    "n_ids": pa.array([writer.starts[-1]], pa.int64()),
                }
            )

    return run


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int, added: bool = False) -> DataFrame:
    """Write the ids of `docs` (doc_id, text) to `folder` in ascending doc_id order; the list of files.

    Each document ends with `end_id`; null and empty texts hold it alone. A null doc_id comes first;
    rows with the same doc_id are ordered by a hash of their texts. `added`: the content of an added
    token in a text has that token's id. The list (part, file, n_documents,
    n_ids) is a table in `folder`, of which only complete files are part.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    listed = ordered.mapInArrow(_write(path, end_id, folder, added), "part int, file string, n_documents long, n_ids long")
    listed.write.mode("overwrite").parquet(f"{folder}/list")
    return spark.read.schema(listed.schema).parquet(f"{folder}/list")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)

        def rows(held: list) -> pa.RecordBatch:
            names, starts, ids = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "start", "ids"],
            )

        for batch in batches:
            for file, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{file}") as source:
                    held, size = [], 0
                    for name, start, ids in Reader(source).documents():
                        held.append((name, before + start, ids.tobytes()))
                        size += held[-1][2].__len__()
                        if size > 4 << 20:
                            yield rows(held)
                            held, size = [], 0
                    if held:
                        yield rows(held)

    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document in `folder`: the ids before it in all files, and its own
    as little-endian unsigned 32-bit integers."""
    ship(spark)
    listed = spark.read.parquet(f"{folder}/list")
    # one row per file
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = listed.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    files = placed.select("file", "before").repartition(max(1, listed.count()))
    return files.mapInArrow(_read(folder), "doc_id long, start long, ids binary")
