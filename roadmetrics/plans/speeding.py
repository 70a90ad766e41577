"""Driving autonomously above the speed limit."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.geo import haversine
from ..operators.islands import runs
from ..operators.stats import km_per_event, per_100
from . import mileage
from .base import Result, Telemetry, event_rows, metric_rows, program


@program("speeding", needs=("mileage",))
def speeding(telemetry: Telemetry) -> Result:
    c, loc = telemetry.config, F.col("localization")
    f = telemetry.frames_with("localization.lat", "localization.lon", "localization.velocity_x", "chassis.speed", "trajectory.speed_limit").select("drive_id", "t", "is_auto", F.coalesce(F.col("chassis.speed"), loc["velocity_x"] * 3.6).alias("speed"), F.col("trajectory.speed_limit").alias("limit"), loc["lat"].alias("lat"), loc["lon"].alias("lon"))
    w = Window.partitionBy("drive_id").orderBy("t")
    step = haversine(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
    f = f.withColumn("step", F.when(F.lag("is_auto").over(w) & (step < 100), step))
    fast = F.col("is_auto") & (F.col("limit") > 0) & (F.col("speed") > c.speeding_factor * F.col("limit")) & (F.col("speed") > c.speeding_min_kmh)
    rows = runs(f, ["drive_id"], ["t"], fast, chunk=c.chunk_s)
    first = Window.partitionBy("drive_id", "island").orderBy("t")
    rows = rows.withColumn("inside", F.when(F.row_number().over(first) > 1, F.col("step")))
    events = rows.groupBy("drive_id", "island").agg(F.min("t").alias("start_ts"), F.max("t").alias("end_ts"), F.count(F.lit(1)).alias("frame_count"), F.max(F.col("speed") / F.col("limit")).alias("peak"), F.coalesce(F.sum("inside"), F.lit(0.0)).alias("m"))
    events = events.filter(F.col("end_ts") - F.col("start_ts") >= c.speeding_min_s)
    per = events.groupBy("drive_id").agg(F.count(F.lit(1)).alias("n"), (F.sum("m") / 1000).alias("over_km"), F.max("peak").alias("ratio"))
    joined = mileage.per_drive(telemetry).join(per, "drive_id", "left").fillna(0, ["n", "over_km"])
    value, text = km_per_event(F.col("n"), F.col("auto_km"))
    metrics = {"speeding_events": (F.col("n"), ""), "speeding_km": (F.col("over_km"), "km"), "speeding_per_100km": (per_100(F.col("n"), F.col("auto_km")), "1/100 km"), "km_per_speeding": (value, "km"), "speeding_ratio": (F.col("ratio"), "")}
    return Result(metric_rows(joined, metrics, {"km_per_speeding": text}), event_rows(events, "speeding"))
