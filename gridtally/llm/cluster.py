"""What a job of this package needs from the cluster: its code on the workers, a shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that tasks import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(), "gridtally_tasks.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)
    # batches of few rows, as single texts can be long; gather() joins them up to a number of bytes
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    _shipped[context.applicationId] = path


def gather(batches: Iterator[pa.RecordBatch], n_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive batches joined to about `n_bytes` each."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= n_bytes:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size or held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()[:1]


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all machines reach; on a local master without
    that setting (as in tests) a temporary one, elsewhere an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="gridtally-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Workspace:
    """Tables written to the shared folder: they cut lineage, survive the loss of executors, and
    are computed once however often they are read."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def keep_with(self, frame: DataFrame, name: str, total: Column) -> tuple[DataFrame, int]:
        """`keep`, and an aggregate of the rows that is found while they are written (of no rows: 0).

        It takes no job of its own. Rows of a task that runs again may count twice, so it is for
        emptiness, sizes and the like, not for results.
        """
        seen = Observation()
        kept = self.keep(frame.observe(seen, total.alias("total")), name)
        return kept, seen.get["total"] or 0

    def drop(self, *names: str) -> None:
        """Remove tables that no frame in use reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Groups with more than one row in so many are joined by broadcast; there are fewer than that.
HOT_SHARE = 10_000


#: Rows in a part of a small table; a table of fewer rows than parts times this gets fewer parts.
PART_ROWS = 4096


def in_parts(frame: DataFrame, rows: int) -> DataFrame:
    """`frame`, which holds `rows` rows at most, in no more parts than they need: each part is a task
    and a file, and the driver has to keep account of all of them."""
    return frame.coalesce(max(1, -(-rows // PART_ROWS)))


def with_group(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int | None = None) -> DataFrame:
    """`rows` with the columns of their group, without the rows of a large group in one task.

    `groups` has one row for each `key` in `rows` and the number of its rows in `size`, in all
    `total` if that is known. The groups that hold more than 1 / HOT_SHARE of all rows are fewer than
    HOT_SHARE, so they are broadcast; the others are joined by a shuffle.
    """
    if total is None:
        total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * HOT_SHARE > total
    hot = F.broadcast(groups.where(large))
    in_hot = rows.join(hot, key)
    others = rows.join(hot.select(*key), key, "left_anti").join(groups.where(~large), key)
    return in_hot.unionByName(others)
