"""The driver's tables as files that other programs would leave: CSV files whose names tell what they hold."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridtally.sources.staging import staging_folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def export(
    frame: DataFrame,
    folder: str,
    name: str,
    by: Sequence[str] = (),
    order: str | None = None,
    header: bool = True,
) -> str:
    """Write CSV files into ``folder`` and return it.

    With ``by`` there is one file for each value of these columns, which are in its name and not among its
    columns. With ``order`` all rows are one file, sorted by that column, which is left out: for tables of
    one year of hours. Otherwise each partition is a file. ``name`` may hold the columns of ``by`` and ``n``,
    the file's number, in braces.
    """
    spark = frame.sparkSession
    parts = f"{folder}/.{uuid.uuid4().hex}"
    if by:
        writer = frame.repartition(*by).write.partitionBy(*by)
    elif order:
        writer = frame.repartition(1).sortWithinPartitions(order).drop(order).write
    else:
        writer = frame.write
    writer.option("header", header).csv(parts)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    written = Path(f"{parts}{'/*' * len(by)}/part-*")
    system = written.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for n, status in enumerate(system.globStatus(written)):
        path = status.getPath()
        values = dict(re.findall(r"(\w+)=([^/]+)", path.toString().rpartition(parts.rpartition("/")[2])[2]))
        if not system.rename(path, Path(f"{folder}/{name.format(n=n, **values)}")):
            raise OSError(f"{path} could not be named {name}")
    return folder
