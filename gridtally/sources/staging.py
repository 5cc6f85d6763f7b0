"""Write an intermediate table once and read it back.

The copy lives in the shared folder named by ``spark.checkpoint.dir``, so it survives the
loss of executors and cuts the lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """The shared folder; a temporary one only where Spark runs in a single process."""
    context = spark.sparkContext
    folder = (
        spark.conf.get(SETTING, None)
        or context.getConf().get(SETTING)
        or context.getCheckpointDir()
    )
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="gridtally-")
    spark.conf.set(SETTING, folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the staging folder and return the table written."""
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
