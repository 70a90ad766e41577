"""Tables that are built from recordings and rebuilt only for those that changed.

A table's folder holds ``data/data_build=<n>/bag=<name>/`` and ``files/build=<n>/``, the manifest of the files that build n
rests on and of the build that each bag's rows are in. A refresh compares the files as they are with the last manifest by
joins: bags with new, changed or missing files are read and written under the new build's number, all others keep theirs.
Nothing that a reader may be at is touched, the manifest is written last, and a build that fails leaves the table as it was;
what it has left behind is written over by the next one.

Edge cases: a bag whose files are all gone, or that no longer gives rows, is no longer in the table; another mark (version or
configuration) rebuilds all; no files at all give an empty table, if there was one before; one refresh at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = ["path", "bag", "bytes", "modified", "mark"]


@dataclass
class Refresh:
    build: int
    rebuilt: int
    kept: int
    removed: int


def _manifests(spark: SparkSession, table: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{table}/files")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _last(spark: SparkSession, table: str) -> tuple[int, DataFrame | None]:
    every = _manifests(spark, table)
    if every is None:
        return 0, None
    build = every.agg(F.max("build")).first()[0]
    return build, every.filter(F.col("build") == build)


def refresh(spark: SparkSession, files: DataFrame, read: Callable[[DataFrame], DataFrame], table: str, mark: str = "1") -> Refresh:
    """Bring the table up to date. files: path, bag, bytes, modified (``catalogue.recordings``, say). read: the rows, with a
    column bag, of those files that it is given."""
    build, before = _last(spark, table)
    now = files.select("path", "bag", "bytes", "modified").withColumn("mark", F.lit(mark)).cache()
    try:
        if before is None:
            old, changed = None, now.select("bag").distinct()
        else:
            old = before.select(*FILE)
            fresh, gone = now.join(old, FILE, "left_anti"), old.join(now, FILE, "left_anti")
            changed = fresh.select("bag").union(gone.select("bag")).distinct()
        changed = changed.cache()
        rebuilt = now.join(changed, "bag", "left_semi")
        names = rebuilt.select("bag").distinct().count()
        lost = 0 if old is None else old.select("bag").distinct().join(now, "bag", "left_anti").count()
        if before is not None and not names and not lost:
            return Refresh(build, 0, now.select("bag").distinct().count(), 0)
        new = build + 1
        read(rebuilt).write.mode("overwrite").partitionBy("bag").parquet(f"{table}/data/data_build={new}")
        places = rebuilt.withColumn("data_build", F.lit(new))
        if before is not None:
            places = places.unionByName(before.select(*FILE, "data_build").join(changed, "bag", "left_anti"))
        kept = places.filter(F.col("data_build") != new).select("bag").distinct().count()
        places.write.mode("overwrite").parquet(f"{table}/files/build={new}")
        return Refresh(new, names, kept, lost)
    finally:
        now.unpersist()
        if "changed" in locals():
            changed.unpersist()


def current(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, with the build that each bag's rows were written by; other builds' folders aren't read."""
    _, files = _last(spark, table)
    if files is None:
        raise ValueError(f"{table} has not been built")
    places = files.select(F.col("bag").cast("string").alias("bag"), "data_build").distinct()
    rows = spark.read.option("basePath", f"{table}/data").parquet(f"{table}/data")
    rows = rows.withColumn("bag", F.col("bag").cast("string"))
    return rows.join(F.broadcast(places) if places.count() <= 100_000 else places, ["bag", "data_build"], "left_semi")
