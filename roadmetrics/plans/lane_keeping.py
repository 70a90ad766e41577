"""Lateral error while driving autonomously."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.bands import trusted
from ..operators import stats
from ..operators.islands import sparse_runs, summarise
from .base import Result, Telemetry, event_rows, metric_rows, program

LEAST_ROWS = 10


#: What of a frame the rows are made from.
FIELDS = (*[f"localization.{c}" for c in ("status", "sd_east", "sd_north", "lat", "lon")], "control_debug.lateral_error", "control_debug.ref_kappa")
LIMITS_CM = (10, 20, 30)


def errors(frames: DataFrame, c: Config) -> DataFrame:
    """drive_id, t, err, kappa of the autonomous frames that are localized well enough."""
    loc, dbg = F.col("localization"), F.col("control_debug")
    f = frames.filter(F.col("is_auto") & trusted(loc["status"], loc["sd_east"], loc["sd_north"], c.sd_trusted) & (loc["lat"] != 0) & (loc["lon"] != 0))
    return f.select("drive_id", "t", dbg["lateral_error"].alias("err"), F.abs(dbg["ref_kappa"]).alias("kappa")).filter("err IS NOT NULL")


def report(per: DataFrame) -> DataFrame:
    """The metrics of rows with n, mean, p95, most, straight, curve and the shares beyond the limits."""
    cm = lambda name: (F.col(name) * 100, "cm")
    metrics = {"lane_error_mean": cm("mean"), "lane_error_p95": cm("p95"), "lane_error_max": cm("most"), "lane_error_straight": cm("straight"), "lane_error_curve": cm("curve")}
    return metric_rows(per.filter(f"n >= {LEAST_ROWS}"), metrics | {f"lane_over_{x}cm": (F.col(f"over_{x}"), "%") for x in LIMITS_CM})


@program("lane_keeping")
def lane_keeping(telemetry: Telemetry) -> Result:
    c, rows = telemetry.config, errors(telemetry.frames_with(*FIELDS), telemetry.config)
    err, size = F.col("err"), F.abs("err")
    straight = F.col("kappa") < c.bend
    per = rows.groupBy("drive_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(size).alias("mean"), F.percentile(size, F.lit(0.95)).alias("p95"), F.max(err if c.compat else size).alias("most"),
        F.avg(F.when(straight, size)).alias("straight"), F.avg(F.when(~straight, size)).alias("curve"), *[stats.rate(size > x / 100).alias(f"over_{x}") for x in LIMITS_CM],
    )
    events = summarise(sparse_runs(rows, ["drive_id"], ["t"], size > c.lane_event_m, max_rows=3, max_gap=c.run_gap_s, chunk=c.chunk_s), ["drive_id"], err)
    return Result(report(per), event_rows(events, "lane_error"))
