"""Tables that a job writes on its way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the checkpoint folder that is set; only a local session without either gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='utterlake-')}"
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back: what reads it several times doesn't compute it again, and no lineage is behind it.

    The table lies in the shared folder and stays there as long as that does: its reader decides when it is evaluated.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
