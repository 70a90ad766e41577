"""Confidence of localization, in all modes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.bands import localization_class
from ..operators import stats
from ..operators.islands import sparse_runs, summarise
from .base import Result, Telemetry, event_rows, metric_rows, program


#: What of a frame the rows are made from.
FIELDS = ("localization.status", "localization.sd_east", "localization.sd_north")
CLASSES = ("normal", "drift", "possible", "waiting", "unknown")


def classified(frames: DataFrame, c: Config) -> DataFrame:
    """drive_id, t, class, sd of the frames with a localization."""
    loc = F.col("localization")
    return frames.filter(loc.isNotNull()).select("drive_id", "t", localization_class(loc["status"], loc["sd_east"], loc["sd_north"], c.sd_trusted, c.sd_drift).alias("class"), F.greatest(loc["sd_east"], loc["sd_north"]).alias("sd"))


def report(per: DataFrame) -> DataFrame:
    """The metrics of rows with the classes' shares, sd, high and mid."""
    metrics = {f"loc_{n}": (F.col(n), "%") for n in ("normal", "drift", "possible")} | {"loc_sd": (F.col("sd"), "m"), "loc_high_frames": (F.col("high"), ""), "loc_mid_frames": (F.col("mid"), "")}
    return metric_rows(per, metrics)


@program("localization")
def localization(telemetry: Telemetry) -> Result:
    c, rows = telemetry.config, classified(telemetry.frames_with(*FIELDS), telemetry.config)
    is_class = lambda name: F.col("class") == name
    per = rows.groupBy("drive_id").agg(*[stats.rate(is_class(n)).alias(n) for n in CLASSES], F.avg("sd").alias("sd"), F.count_if(is_class("drift")).alias("high"), F.count_if(is_class("possible")).alias("mid"))
    flagged = sparse_runs(rows, ["drive_id"], ["t"], is_class("drift") | is_class("possible"), max_rows=3, max_gap=c.run_gap_s, same=["class"], chunk=c.chunk_s)
    return Result(report(per), event_rows(summarise(flagged, ["drive_id"], F.col("sd"), "t", "max"), "localization"))
