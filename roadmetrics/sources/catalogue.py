"""What recordings hold: topics, time ranges, bags, and whether they changed since a result was cached."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_catalogue(rows: DataFrame, topic: str = "topic", on: str = "t") -> DataFrame:
    """Per topic: messages, first_t, last_t, duration."""
    return rows.groupBy(topic).agg(F.count(F.lit(1)).alias("messages"), F.min(on).alias("first_t"), F.max(on).alias("last_t"), (F.max(on) - F.min(on)).alias("duration"))


def missing_topics(rows: DataFrame, required: list[str], topic: str = "topic") -> DataFrame:
    wanted = rows.sparkSession.createDataFrame([(t,) for t in required], f"{topic} string")
    return wanted.join(rows.select(topic).distinct(), topic, "left_anti")


def bag_spans(rows: DataFrame, on: str = "t") -> DataFrame:
    """The interval of each bag, ordered by its start when read."""
    return rows.groupBy("drive_id", F.col("bag").alias("name")).agg(F.min(on).alias("start_ts"), F.max(on).alias("end_ts"))


def fingerprint(files: DataFrame, config: dict, version: str = "1") -> str:
    """A text that changes with the files (path, length, modificationTime of a binaryFile listing) or the configuration."""
    line = F.concat_ws("|", "path", "length", F.col("modificationTime").cast("string"))
    listed = files.select(F.md5(line.cast("binary")).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")).alias("s")).first()
    return hashlib.sha256(json.dumps([version, listed.n, str(listed.s), config], sort_keys=True, default=str).encode()).hexdigest()[:16]


def load_or_build(spark, path: str, mark: str, build) -> DataFrame:
    """The table at path if it was built under the same mark, else the result of build, written there."""
    try:
        if spark.read.text(f"{path}/_mark").first()[0] == mark:
            return spark.read.parquet(f"{path}/data")
    except Exception as missing:  # noqa: BLE001  a path that is not there yet is the usual case
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    build().write.mode("overwrite").parquet(f"{path}/data")
    spark.createDataFrame([(mark,)], "mark string").coalesce(1).write.mode("overwrite").text(f"{path}/_mark")
    return spark.read.parquet(f"{path}/data")


def recordings(spark: SparkSession, folder: str, pattern: str = "*.db3", depth: int = 3) -> DataFrame:
    """The recording files below folder, at most depth folders deep and not in hidden ones: path, bag (their folder),
    bytes, modified. Contents are not read; Spark lists no empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    below = re.sub("^/+", "/", folder.rstrip("/").split(":", 1)[-1])  # Spark writes file:/// as file:/
    inside = F.split(F.regexp_replace("path", "^.*?" + re.escape(below) + "/", ""), "/")
    folders = F.slice(inside, 1, F.size(inside) - 1)
    found = files.select("path", F.regexp_extract("path", "([^/]+)/[^/]*$", 1).alias("bag"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), folders.alias("_in"))
    fits = (F.size("_in") <= depth) & ~F.exists("_in", lambda x: x.startswith("."))
    return found.filter(fits).drop("_in")
