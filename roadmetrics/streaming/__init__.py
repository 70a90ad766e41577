"""Incremental ingestion of recordings, and sessions of autonomous driving on batch tables or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, schema: str, table: str, rejected: str, mark: str, files_per_batch: int = 1000) -> None:
    """Append the files that are new in source to table, and rows without a drive or a time to rejected.

    Runs until nothing is new and ends. A batch is written under its number, so a batch that is run again after a
    failure replaces what it wrote before.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        usable = F.col("drive_id").isNotNull() & F.col("t").isNotNull()
        batch.filter(usable).write.mode("overwrite").parquet(f"{table}/batch={number}")
        batch.filter(~usable).write.mode("overwrite").parquet(f"{rejected}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()


def auto_sessions(modes: DataFrame, gap_s: float = 1.0, late_s: int = 60, auto_operator: int = 2) -> DataFrame:
    """drive_id, start_ts, end_ts, frames of sessions of autonomous messages at most gap_s apart; on a stream, messages
    that are more than late_s behind are dropped."""
    at = F.timestamp_micros(F.round(F.col("t") * 1_000_000).cast("bigint"))
    rows = modes.filter(F.col("operator_type") == auto_operator).withColumn("at", at)
    if modes.isStreaming:
        rows = rows.withWatermark("at", f"{late_s} seconds")
    gap = f"{round(gap_s * 1_000_000)} microseconds"
    return rows.groupBy("drive_id", F.session_window("at", gap).alias("session")).agg(F.min("t").alias("start_ts"), F.max("t").alias("end_ts"), F.count(F.lit(1)).alias("frames")).drop("session")
