"""Metrics over batches of frames that arrive in any order: each batch leaves a small state, and states are merged when read.

A state is written under its batch's number, so a batch that is run again replaces what it left. What is kept:

* mileage: per stretch of a drive (frames at most a step's longest time apart) the sums of its valid steps, and its first
  and last position. Merging adds the step from the end of each stretch to the start of the next one, wherever it came
  from; a longer gap holds no valid step, so batches may hold alternating recordings of one drive.
* localization: counts by class, the sum and count of the deviations.
* lane keeping: sums, and for exact percentiles the count of each value.

Frames of one drive in different batches must not alternate within a step's longest time; stretches that overlap are an
error and not a wrong sum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.geo import haversine
from ..operators.islands import number_islands
from . import lane_keeping, localization, mileage

State = Callable[[DataFrame, Config], DataFrame]
#: What of a frame each state is made from.
FIELDS = {"mileage": ("localization.lat", "localization.lon"), "localization": localization.FIELDS, "lane_keeping": lane_keeping.FIELDS}


def mileage_state(frames: DataFrame, c: Config) -> DataFrame:
    rows = mileage.steps(mileage.positions(frames), c.max_step_s, c.max_speed_kmh, chunk=c.chunk_s)
    apart = F.coalesce(F.col("dt") > c.max_step_s, F.lit(True))
    stretches = number_islands(rows.withColumn("_b", apart), ["drive_id"], ["t"], F.col("_b"), "stretch", c.chunk_s)
    place = F.struct("t", "lat", "lon", "is_auto")
    return stretches.groupBy("drive_id", "stretch").agg(F.min_by(place, "t").alias("first"), F.max_by(place, "t").alias("last"), *mileage.totals())


def merged_mileage(states: DataFrame, c: Config) -> DataFrame:
    """auto_km, manual_km, auto_s, manual_s per drive."""
    before = F.lag("last").over(Window.partitionBy("drive_id").orderBy("first.t"))
    pairs = states.withColumn("before", before)
    overlap = F.raise_error(F.concat(F.lit("stretches of two batches overlap in drive "), "drive_id"))
    dt = F.when(F.col("first.t") < F.col("before.t"), overlap.cast("double")).otherwise(F.col("first.t") - F.col("before.t"))
    d = haversine(F.col("before.lat"), F.col("before.lon"), F.col("first.lat"), F.col("first.lon"))
    steps = pairs.select("drive_id", F.col("first.is_auto").alias("is_auto"), dt.alias("dt"), d.alias("d"))
    steps = steps.withColumn("valid", F.coalesce((F.col("dt") > 0) & (F.col("dt") <= c.max_step_s) & (F.try_divide("d", "dt") * 3.6 <= c.max_speed_kmh), F.lit(False)))
    names = ("auto_km", "manual_km", "auto_s", "manual_s")
    both = states.select("drive_id", *names).unionByName(steps.groupBy("drive_id").agg(*mileage.totals()))
    return both.groupBy("drive_id").agg(*[F.sum(n).alias(n) for n in names])


def localization_state(frames: DataFrame, c: Config) -> DataFrame:
    rows = localization.classified(frames, c)
    return rows.groupBy("drive_id").agg(*[F.count_if(F.col("class") == n).alias(n) for n in localization.CLASSES], F.sum("sd").alias("sd_sum"), F.count("sd").alias("sd_n"))


def merged_localization(states: DataFrame, c: Config) -> DataFrame:
    names = localization.CLASSES
    sums = states.groupBy("drive_id").agg(*[F.sum(n).alias(n) for n in names], F.try_divide(F.sum("sd_sum"), F.sum("sd_n")).alias("sd"))
    n = sum((F.col(x) for x in names[1:]), F.col(names[0]))
    return sums.select("drive_id", *[(F.col(x) * 100.0 / n).alias(x) for x in names], "sd", F.col("drift").alias("high"), F.col("possible").alias("mid"))


def lane_keeping_state(frames: DataFrame, c: Config) -> DataFrame:
    rows = lane_keeping.errors(frames, c)
    straight = F.coalesce(F.col("kappa") < c.bend, F.lit(None))
    return rows.groupBy("drive_id", straight.alias("straight"), "err").agg(F.count(F.lit(1)).alias("n"))


def merged_lane_keeping(states: DataFrame, c: Config) -> DataFrame:
    counts = states.groupBy("drive_id", "straight", "err").agg(F.sum("n").alias("n"))
    size, n = F.abs("err"), F.col("n")
    mean = lambda cond: F.try_divide(F.sum(F.when(cond, size * n)), F.sum(F.when(cond, n)))
    over = [(F.sum(F.when(size > x / 100, n).otherwise(0)) * 100.0 / F.sum(n)).alias(f"over_{x}") for x in lane_keeping.LIMITS_CM]
    return counts.groupBy("drive_id").agg(
        F.sum(n).alias("n"), mean(F.lit(True)).alias("mean"), F.percentile(size, F.lit(0.95), n).alias("p95"), F.max(F.col("err") if c.compat else size).alias("most"),
        mean(F.col("straight")).alias("straight"), mean(~F.col("straight")).alias("curve"), *over,
    )


STATES: dict[str, tuple[State, State, Callable[[DataFrame], DataFrame]]] = {
    "mileage": (mileage_state, merged_mileage, mileage.report),
    "localization": (localization_state, merged_localization, localization.report),
    "lane_keeping": (lane_keeping_state, merged_lane_keeping, lane_keeping.report),
}


def add_batch(frames: DataFrame, folder: str, number: int, config: Config = Config(), names: tuple[str, ...] = tuple(STATES)) -> None:
    """Write the states that a batch of frames leaves. As a stream's foreachBatch: lambda df, n: add_batch(df, folder, n)."""
    for name in names:
        STATES[name][0](frames, config).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")


def read_metrics(spark: SparkSession, folder: str, name: str, config: Config = Config()) -> DataFrame:
    """The metrics of all batches so far."""
    _, merge, report = STATES[name]
    return report(merge(spark.read.parquet(f"{folder}/{name}"), config))
