"""Steering smoothness from high-frequency chassis data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as limits
from ..functions.bands import by_band, by_ceiling
from ..functions.filters import lowpass
from ..operators import stats
from ..operators import windows as ops
from ..operators.islands import merge_events, runs, summarise
from ..operators.kernels import by_series, segments
from .base import Result, Telemetry, event_rows, metric_rows, program

SPEED_BINS = [(10, 0), (20, 1), (30, 2), (40, 3), (50, 4), (60, 5), (80, 6)]


def rates(telemetry: Telemetry) -> DataFrame:
    """Autonomous rows with a filtered steering rate (rate, at the middle time of each step) and the speed.

    Filters run per continuous segment; in compat mode over the whole autonomous series of the drive.
    """
    return telemetry.once("steering-rates", lambda: _rates(telemetry))


def _rates(telemetry: Telemetry) -> DataFrame:
    import numpy as np

    c = telemetry.config
    rows = telemetry.chassis_hf().filter(F.col("is_auto") & (F.col("speed") >= c.steer_min_kmh)).select("drive_id", "t", "speed", "steering_angle").filter("steering_angle IS NOT NULL")
    rows = rows.withColumn("segment", F.col("drive_id")) if c.compat else segments(rows, "drive_id", "t", c.max_step_s)

    def smooth(cutoff):
        def kernel(t, x):
            step = np.median(np.diff(t)) if len(t) > 1 else 0.02
            rate = min(100.0, max(1.0, 1 / step if step > 0 else 50.0))
            return lowpass(x, min(cutoff, rate / 2 - 0.1), rate)

        return kernel

    angle = by_series(rows, "segment", "t", "steering_angle", "angle", smooth(c.angle_cutoff_hz))
    w = Window.partitionBy("segment").orderBy("t")
    rate, middle = ops.derivative(w, "angle")
    raw = angle.withColumns({"raw_rate": rate, "middle": middle}).filter("raw_rate IS NOT NULL")
    out = by_series(raw.withColumn("t", F.col("middle")).drop("middle"), "segment", "t", "raw_rate", "rate", smooth(c.rate_cutoff_hz))
    return out.select("drive_id", "segment", "t", "speed", "angle", "rate")


def rms_windows(telemetry: Telemetry, rows: DataFrame) -> DataFrame:
    """One row per full window of a segment: its centre, the RMS of the rate, the speed at the centre.

    Window and step are row counts that depend on the drive's rate; the RMS comes from running sums, so no frame width
    has to be a constant.
    """
    c, w = telemetry.config, Window.partitionBy("segment").orderBy("t")
    rate = ops.median_step(rows, ["drive_id"]).select("drive_id", F.floor(F.col("rate") * c.steer_window_s).alias("size"), F.greatest(F.floor(F.col("rate") * c.steer_step_s), F.lit(1)).alias("step"))
    running = rows.withColumns({"row": F.row_number().over(w), "upto": F.sum(F.col("rate") * F.col("rate")).over(w)}).join(rate, "drive_id")
    ends = running.select("segment", (F.col("row") - F.col("size")).alias("row"), F.col("upto").alias("end_sum"))
    starts = running.select("drive_id", "segment", "size", "step", (F.col("row")).alias("row"), "upto").unionByName(running.filter("row = 1").select("drive_id", "segment", "size", "step", F.lit(0).alias("row"), F.lit(0.0).alias("upto")))
    centre = running.select("segment", (F.col("row") - 1 - F.floor(F.col("size") / 2)).alias("row"), F.col("t"), F.col("speed"))
    full = starts.filter("row % step = 0").join(ends, ["segment", "row"]).join(centre, ["segment", "row"])
    return full.select("drive_id", "segment", "t", "speed", F.sqrt(F.greatest(F.col("end_sum") - F.col("upto"), F.lit(0.0)) / F.col("size")).alias("rms"))


def flip_windows(telemetry: Telemetry, rows: DataFrame) -> DataFrame:
    """One row per full window of a segment: its centre t, the sign changes a second of the rates that reach
    flip_min_rate (flips, 0 if fewer than two rates do), the mean speed.

    Windows are counted in rows as in rms_windows. A window's sign changes are a difference of running counts, from its
    first rate that reaches the least one to its last, so no frame width has to be a constant.
    """
    c, w = telemetry.config, Window.partitionBy("segment").orderBy("t")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    rate = ops.median_step(rows, ["drive_id"]).select("drive_id", F.floor(F.col("rate") * c.steer_window_s).alias("size"), F.greatest(F.floor(F.col("rate") * c.steer_step_s), F.lit(1)).alias("step"))
    high = F.abs("rate") >= c.flip_min_rate
    signed = rows.withColumns({"row": F.row_number().over(w), "sign": F.when(high, F.signum("rate")), "v": F.sum("speed").over(so_far)})
    before = F.last("sign", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    counted = signed.withColumn("flip", F.coalesce((F.col("sign") != before).cast("int"), F.lit(0))).withColumn("upto", F.sum("flip").over(so_far))
    own = counted.withColumn("own", F.when(F.col("sign").isNotNull(), F.struct("t", "upto")))
    later = Window.partitionBy("segment").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    ends = own.withColumns({"last": F.last("own", ignorenulls=True).over(so_far), "first": F.last("own", ignorenulls=True).over(later)}).join(rate, "drive_id")
    starts = ends.filter("(row - 1) % step = 0").select("drive_id", "segment", "row", "size", "first", (F.col("v") - F.col("speed")).alias("v0"))
    upto = ends.select("segment", (F.col("row") - F.col("size") + 1).alias("row"), "last", F.col("v").alias("v1"))
    centre = ends.select("segment", (F.col("row") - F.floor(F.col("size") / 2)).alias("row"), "t")
    full = starts.join(upto, ["segment", "row"]).join(centre, ["segment", "row"])
    span = F.col("last.t") - F.col("first.t")
    flips = F.when(span > 0, (F.col("last.upto") - F.col("first.upto")) / span).otherwise(0.0)
    return full.select("drive_id", "segment", "t", F.coalesce(flips, F.lit(0.0)).alias("flips"), ((F.col("v1") - F.col("v0")) / F.col("size")).alias("speed"))


def flip_events(telemetry: Telemetry, rows: DataFrame, per_drive: DataFrame, most: int = 20) -> DataFrame:
    """The peak windows of neighbouring windows that flip too often, the first ``most`` of each drive whose own flip rate
    (flips, speed of per_drive) is beyond its limit."""
    c = telemetry.config
    limit = lambda: by_band(F.col("speed"), limits.STEER_FLIP_FAIL, 0)
    bad = per_drive.filter((limit() > 0) & (F.col("flips") > limit())).select("drive_id")
    over = flip_windows(telemetry, rows).filter((limit() > 0) & (F.col("flips") > limit())).join(bad, "drive_id", "left_semi")
    merged = merge_events(over.withColumns({"start_ts": F.col("t"), "end_ts": F.col("t")}), ["drive_id"], 2 * c.steer_step_s)
    peaks = merged.groupBy("drive_id", "merged").agg(F.max_by(F.struct("t", "flips"), F.struct("flips", -F.col("t"))).alias("p"), F.count(F.lit(1)).alias("frame_count"))
    peaks = peaks.select("drive_id", F.col("p.t").alias("start_ts"), F.col("p.t").alias("end_ts"), "frame_count", F.col("p.flips").alias("peak"))
    return peaks.withColumn("_k", F.row_number().over(Window.partitionBy("drive_id").orderBy("start_ts"))).filter(F.col("_k") <= most).drop("_k")


@program("steering")
def steering(telemetry: Telemetry) -> Result:
    c, rows = telemetry.config, rates(telemetry)
    windows = telemetry.once("steering-windows", lambda: rms_windows(telemetry, rows))
    size, w = F.abs("rate"), Window.partitionBy("drive_id").orderBy("t")
    flips = rows.filter(size >= c.flip_min_rate).select("drive_id", "t", F.when(F.signum("rate") != F.lag(F.signum("rate")).over(w), 1).otherwise(0).alias("flip"))
    flip_rate = flips.groupBy("drive_id").agg(F.coalesce(F.try_divide(F.sum("flip"), F.max("t") - F.min("t")), F.lit(0.0)).alias("flips"))
    per = windows.groupBy("drive_id").agg(F.avg("rms").alias("mean"), F.max("rms").alias("most"), F.percentile("rms", F.lit(0.95)).alias("p95"))
    tail = rows.groupBy("drive_id").agg(F.percentile(size, F.lit(0.95)).alias("rate_p95"))
    speed_bin = by_ceiling(F.col("speed"), SPEED_BINS, 7).cast("int")
    bins = rows.groupBy("drive_id", speed_bin.alias("bin")).agg(F.sqrt(F.avg(F.col("rate") * F.col("rate"))).alias("rms"), F.percentile(size, F.lit(0.95)).alias("p95"))
    by_bin = bins.select("drive_id", F.explode(F.array(*[F.struct(F.concat(F.lit(f"steering_{k}_bin"), F.col("bin")).alias("metric"), F.col(k).alias("value"), F.lit(None).cast("string").alias("value_text"), F.lit("deg/s").alias("unit")) for k in ("rms", "p95")])).alias("m")).select("drive_id", "m.*")
    joined = per.join(tail, "drive_id", "left").join(flip_rate, "drive_id", "left")
    metrics = {"steering_rms_mean": ("mean", "deg/s"), "steering_rms_max": ("most", "deg/s"), "steering_rms_p95": ("p95", "deg/s"), "steering_rate_p95": ("rate_p95", "deg/s"), "steering_flip_rate": ("flips", "1/s")}
    over = windows.withColumn("limit", by_band(F.col("speed"), limits.STEER_RMS_FAIL, 0)).filter((F.col("speed") >= c.steer_event_kmh) & (F.col("limit") > 0) & (F.col("rms") > F.col("limit")))
    merged = merge_events(over.select("drive_id", F.col("t").alias("start_ts"), F.col("t").alias("end_ts"), "rms"), ["drive_id"], 1.0)
    rms_events = merged.groupBy("drive_id", "merged").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.count(F.lit(1)).alias("frame_count"), F.max("rms").alias("peak"))
    fast = size > by_band(F.col("speed"), limits.STEER_P95_FAIL, 1e9)
    rate_runs = summarise(runs(rows, ["drive_id"], ["t"], fast, chunk=c.chunk_s), ["drive_id"], F.col("rate"), "t", "abs_max", F.avg("speed").alias("v")).filter(f"v >= {c.steer_event_kmh}")
    speeds = rows.groupBy("drive_id").agg(F.avg("speed").alias("speed"))
    flipping = flip_events(telemetry, rows, flip_rate.join(speeds, "drive_id"))
    events = event_rows(rms_events, "steering_rms").unionByName(event_rows(rate_runs, "steering_rate")).unionByName(event_rows(flipping, "steering_flip"))
    return Result(metric_rows(joined, {k: (F.col(v), u) for k, (v, u) in metrics.items()}).unionByName(by_bin), events)
