"""Tables that are written once and read by several plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors see; in local mode without it a folder of our own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="checkpoints-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: it is worked out once, and a lost executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
