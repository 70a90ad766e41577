"""Longitudinal comfort: jerk and acceleration of autonomous driving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as limits
from ..functions.bands import by_band
from ..functions.filters import robust_jerk
from ..operators import stats
from ..operators import windows as ops
from ..operators.asof import interpolate
from ..operators.islands import sparse_runs, summarise
from ..operators.kernels import by_series, segments
from .base import Result, Telemetry, event_rows, metric_rows, program


def accelerations(telemetry: Telemetry) -> DataFrame:
    """Autonomous control rows (drive_id, t, acc) with the chassis speed interpolated to their times."""

    def build():
        control = telemetry.control_hf().filter("is_auto AND target_lon_acc IS NOT NULL").select("drive_id", "t", F.col("target_lon_acc").alias("acc")).withColumn("key", F.lit(0).cast("bigint"))
        chassis = telemetry.topic("chassis").select("drive_id", "t", "speed").withColumn("key", F.lit(0).cast("bigint"))
        return interpolate(control, chassis, "speed", "speed", key="key", chunk=telemetry.config.chunk_s).drop("key").fillna(0.0, ["speed"])

    return telemetry.once("accelerations", build)


def jerks(rows: DataFrame, telemetry: Telemetry) -> DataFrame:
    c = telemetry.config
    rows = rows.withColumn("segment", F.col("drive_id")) if c.compat else segments(rows, "drive_id", "t", c.max_step_s)
    return by_series(rows, "segment", "t", "acc", "jerk", lambda t, x: robust_jerk(t, x, c.angle_cutoff_hz))


def moving(rows: DataFrame, least_kmh: float, least_rows: int = 10) -> DataFrame:
    """Rows at speed, or all rows of drives with fewer than least_rows of them."""
    n = F.count_if(F.col("speed") >= least_kmh).over(Window.partitionBy("drive_id"))
    return rows.withColumn("_n", n).filter((F.col("_n") < least_rows) | (F.col("speed") >= least_kmh)).drop("_n")


def rms_1s(rows: DataFrame) -> DataFrame:
    """RMS of the jerk (drive_id, segment, window, rms) over windows of as many rows as make a second at the drive's median
    step, which start every half window; windows that aren't full or lack a jerk are left out, and a drive of which no window
    is left has its overall RMS (window -1)."""
    width = F.greatest(F.lit(1), F.round(F.col("rate")).cast("int"))
    sized = rows.join(ops.median_step(rows, ["drive_id"]).select("drive_id", width.alias("width")), "drive_id", "left").fillna(1, ["width"])
    numbered = sized.withColumn("row", F.row_number().over(Window.partitionBy("segment").orderBy("t")) - 1).withColumn("step", F.greatest(F.lit(1), F.floor(F.col("width") / 2)))
    first = F.greatest(F.lit(0), F.ceil((F.col("row") - F.col("width") + 1) / F.col("step")))
    placed = numbered.withColumn("window", F.explode(F.sequence(first, F.floor(F.col("row") / F.col("step")))))
    rms = F.sqrt(F.avg(F.col("jerk") * F.col("jerk"))).alias("rms")
    full = placed.groupBy("drive_id", "segment", "window").agg(rms, F.count("jerk").alias("seen"), F.first("width").alias("width")).filter("seen = width").drop("seen", "width")
    whole = rows.filter("jerk IS NOT NULL").groupBy("drive_id").agg(rms).join(full.select("drive_id").distinct(), "drive_id", "left_anti")
    return full.unionByName(whole.select("drive_id", F.col("drive_id").alias("segment"), F.lit(-1).cast("bigint").alias("window"), "rms"))


@program("comfort")
def comfort(telemetry: Telemetry) -> Result:
    c = telemetry.config
    rows = telemetry.once("jerks-moving", lambda: jerks(moving(accelerations(telemetry), c.comfort_min_kmh), telemetry))
    jerk, acc, v = F.abs("jerk"), F.col("acc"), F.col("speed")
    peak = by_band(v, limits.JERK_PEAK, 3.0)
    up, down = F.when(acc > 0, acc), F.when(acc < 0, -acc)
    per = rows.groupBy("drive_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(jerk).alias("mean"), F.percentile(jerk, F.lit(0.95)).alias("p95"), F.percentile(jerk, F.lit(0.99)).alias("p99"), F.avg(v).alias("v"), F.avg(F.when(jerk.isNotNull(), F.when(jerk > peak, 100.0).otherwise(0.0))).alias("over"),
        F.max(up).alias("acc"), F.avg(F.when(up.isNotNull(), F.when(up > by_band(v, limits.ACC_WARN, 3.0), 100.0).otherwise(0.0))).alias("acc_over"),
        F.max(down).alias("dec"), F.avg(F.when(down.isNotNull(), F.when(down > by_band(v, limits.DEC_WARN, 3.0), 100.0).otherwise(0.0))).alias("dec_over"),
    ).filter("n >= 10")
    windows = rms_1s(rows).groupBy("drive_id").agg(F.max("rms").alias("rms_max"), F.percentile("rms", F.lit(0.95)).alias("rms_p95"))
    events = summarise(sparse_runs(rows, ["drive_id"], ["t"], jerk > peak, max_gap=c.comfort_gap_s, chunk=c.chunk_s), ["drive_id"], F.col("jerk"))
    metrics = {
        "jerk_mean": ("mean", "m/s3"), "jerk_p95": ("p95", "m/s3"), "jerk_rms_max": ("rms_max", "m/s3"), "jerk_rms_p95": ("rms_p95", "m/s3"), "jerk_over_pct": ("over", "%"),
        "acc_peak": ("acc", "m/s2"), "acc_over_pct": ("acc_over", "%"), "dec_peak": ("dec", "m/s2"), "dec_over_pct": ("dec_over", "%"),
    }
    counts = events.groupBy("drive_id").agg(F.count(F.lit(1)).alias("jerk_events"))
    joined = per.join(windows, "drive_id", "left").join(counts, "drive_id", "left").fillna(0, ["jerk_events"])
    points, grade = score(F.col("rms_max"), F.col("p99"), F.col("mean"), F.col("v"))
    more = {"jerk_events": (F.col("jerk_events"), ""), "comfort_score": (points, "")}
    rows_out = metric_rows(joined, {k: (F.col(x), u) for k, (x, u) in metrics.items()} | more, {"comfort_score": grade})
    return Result(rows_out, event_rows(events, "jerk"))


def score(rms: F.Column, p99: F.Column, mean: F.Column, speed: F.Column) -> tuple[F.Column, F.Column]:
    """Comfort from 0 to 100 and its grade: deductions of at most 40, 30 and 20 points for what the largest RMS, the 99th
    percentile and the mean of the jerk exceed the limits at the mean speed by. A missing value deducts nothing."""
    limit, peak = by_band(speed, limits.JERK_RMS, 1.5), by_band(speed, limits.JERK_PEAK, 3.0)
    off = lambda value, most, points: F.coalesce(F.least(F.lit(points), F.greatest(F.lit(0.0), value - most)), F.lit(0.0))
    left = 100 - off(rms * 10, limit * 10, 40.0) - off(p99 * 5, peak * 5, 30.0) - off(mean * 10, limit * 5, 20.0)
    points = F.greatest(F.lit(0.0), F.least(F.lit(100.0), left))
    return points, F.when(points >= 90, "A").when(points >= 75, "B").when(points >= 60, "C").otherwise("D")
