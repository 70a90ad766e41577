"""Emergency events: hard braking, jerk, hard lateral steering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as limits
from ..functions.bands import by_band, by_floor
from ..operators import windows as ops
from ..operators.islands import merge_events, runs, summarise
from ..operators.stats import km_per_event, per_100
from . import comfort, mileage, steering
from .base import Result, Telemetry, event_rows, metric_rows, program


def hard_braking(rows: DataFrame, gap: float, least: float, chunk: float | None = None) -> DataFrame:
    over = F.col("acc") < by_band(F.col("speed"), limits.DEC_FAIL, -3.0)
    found = summarise(runs(rows, ["drive_id"], ["t"], over, max_gap=gap, chunk=chunk), ["drive_id"], F.col("acc"), "t", "min", F.avg("speed").alias("speed"))
    return found.filter(F.col("duration") >= least)


def jerk_events(rows: DataFrame, gap: float, least: float, merge: float, chunk: float | None = None) -> DataFrame:
    over = F.abs("jerk") > by_band(F.col("speed"), limits.JERK_PEAK, 2.5)
    flagged = runs(rows.filter("jerk IS NOT NULL"), ["drive_id"], ["t"], over, max_gap=gap, chunk=chunk)
    series = F.sort_array(F.collect_list(F.struct("t", "jerk"))).alias("series")
    found = summarise(flagged, ["drive_id"], F.col("jerk"), "t", "abs_max", series).filter(F.col("duration") >= least)
    merged = merge_events(found, ["drive_id"], merge)
    return merged.groupBy("drive_id", "merged").agg(
        F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.sum("frame_count").alias("frame_count"), F.max(F.abs("peak")).alias("peak"), F.sort_array(F.flatten(F.collect_list("series"))).alias("series")
    )


def lateral_events(rows: DataFrame, gap: float, least: float, merge: float, chunk: float | None = None) -> DataFrame:
    """Runs of high steering rate and of high steering acceleration, merged; speed is the running pairwise mean."""
    w = Window.partitionBy("segment").orderBy("t")
    acc, middle = ops.derivative(w, "rate")
    accs = rows.withColumns({"acc": acc, "middle": middle}).filter("acc IS NOT NULL").select("drive_id", F.col("middle").alias("t"), "speed", "acc")
    kinds = []
    for kind, df, value, limit in (("rate", rows, "rate", by_floor(F.col("speed"), limits.LATERAL_RATE, 200)), ("acc", accs, "acc", by_floor(F.col("speed"), limits.LATERAL_ACC, 600, strict=True))):
        found = summarise(runs(df, ["drive_id"], ["t"], F.abs(value) > limit, max_gap=gap, chunk=chunk), ["drive_id"], F.col(value), "t", "abs_max", F.avg("speed").alias("speed"))
        kinds.append(found.filter(F.col("duration") >= least).select("drive_id", "start_ts", "end_ts", "frame_count", F.abs("peak").alias("peak"), "speed", F.lit(kind).alias("kind")))
    merged = merge_events(kinds[0].unionByName(kinds[1]), ["drive_id"], merge)
    ordered = F.array_sort(F.collect_list(F.struct("start_ts", "end_ts", "speed")))
    speed = F.aggregate(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), F.get("parts", 0)["speed"], lambda a, p: (a + p["speed"]) / 2)
    out = merged.groupBy("drive_id", "merged").agg(
        F.min("start_ts").alias("start_ts"), F.max_by("end_ts", F.struct("start_ts", "end_ts")).alias("end_ts"), F.sum("frame_count").alias("frame_count"), F.max("peak").alias("peak"),
        F.when(F.countDistinct("kind") > 1, "both").otherwise(F.min("kind")).alias("kind"), ordered.alias("parts"),
    )
    return out.withColumn("speed", speed).drop("parts", "merged")


@program("emergency", needs=("mileage",))
def emergency(telemetry: Telemetry) -> Result:
    c = telemetry.config
    rows = comfort.accelerations(telemetry)
    brakes = hard_braking(rows, c.run_gap_s, c.brake_min_s, c.chunk_s)
    jerk = jerk_events(telemetry.once("jerks", lambda: comfort.jerks(rows, telemetry)), c.run_gap_s, c.jerk_min_s, c.jerk_merge_s, c.chunk_s)
    lateral = telemetry.once("laterals", lambda: lateral_events(steering.rates(telemetry), c.run_gap_s, c.lateral_min_s, c.lateral_merge_s, c.chunk_s))
    joined = mileage.per_drive(telemetry)
    for name, events in (("brakes", brakes), ("jerks", jerk), ("laterals", lateral)):
        joined = joined.join(events.groupBy("drive_id").agg(F.count(F.lit(1)).alias(name)), "drive_id", "left")
    by_kind = lateral.groupBy("drive_id").agg(F.count_if(F.col("kind") != "acc").alias("lateral_rate"), F.count_if(F.col("kind") != "rate").alias("lateral_acc"))
    joined = joined.join(by_kind, "drive_id", "left").fillna(0, ["brakes", "jerks", "laterals", "lateral_rate", "lateral_acc"])
    metrics, texts = {n: (F.col(n), "") for n in ("brakes", "jerks", "laterals", "lateral_rate", "lateral_acc")}, {}
    for name in ("brakes", "jerks"):
        value, text = km_per_event(F.col(name), F.col("auto_km"))
        metrics |= {f"{name}_per_100km": (per_100(F.col(name), F.col("auto_km")), "1/100 km"), f"km_per_{name}": (value, "km")}
        texts[f"km_per_{name}"] = text
    events = event_rows(brakes, "hard_braking").unionByName(event_rows(jerk, "jerk_event")).unionByName(event_rows(lateral, "lateral"))
    return Result(metric_rows(joined, metrics, texts), events)
