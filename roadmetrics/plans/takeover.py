"""Takeovers: the driver ends autonomous driving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.chunked import Series, over_chunks
from ..operators.islands import number_islands
from ..operators.stats import km_per_event, per_100
from . import mileage
from .base import Result, Telemetry, event_rows, metric_rows, program


def edges(rows: DataFrame, max_gap: float = 1.0, min_prior: float = 1.0, order: tuple[str, ...] = ("t",), chunk: float | None = None) -> DataFrame:
    """Edges from autonomous to manual that do not cross a gap: drive_id, at, prior (seconds of autonomous driving before
    it), valid (prior is long enough), prior_start, frames. With chunk, drives are cut into pieces of that many seconds."""

    def neighbours(df, w):
        changed = (F.col("is_auto") != F.lag("is_auto").over(w)) | (F.col("t") - F.lag("t").over(w) > max_gap)
        return df.withColumns({"_b": F.coalesce(changed, F.lit(True)), "_next_auto": F.lead("is_auto").over(w), "_next_t": F.lead("t").over(w)})

    staged = over_chunks(rows, Series(("drive_id",), order, chunk), neighbours, 1, 1)
    rows = number_islands(staged, ["drive_id"], list(order), F.col("_b"), chunk=chunk)
    last = F.struct(*order)
    islands = rows.filter("is_auto").groupBy("drive_id", "island").agg(
        F.min("t").alias("prior_start"), F.max("t").alias("_end"), F.max_by("_next_auto", last).alias("_next_auto"), F.max_by("_next_t", last).alias("at"), F.count(F.lit(1)).alias("frames")
    )
    found = islands.filter((~F.col("_next_auto")) & (F.col("at") - F.col("_end") <= max_gap)).withColumn("prior", F.col("_end") - F.col("prior_start"))
    return found.withColumn("valid", F.col("prior") >= min_prior).drop("island", "_end", "_next_auto")


@program("takeover", needs=("mileage",))
def takeover(telemetry: Telemetry) -> Result:
    c = telemetry.config
    found = edges(telemetry.frames_with().select("drive_id", "t", "is_auto"), c.max_step_s, c.takeover_prior_s, chunk=c.chunk_s)
    between = F.col("at") - F.lag("at").over(Window.partitionBy("drive_id").orderBy("at"))
    valid = found.filter("valid").withColumn("apart", between)
    counts = found.groupBy("drive_id").agg(F.count(F.lit(1)).alias("all"), F.count_if("valid").alias("n"))
    spaced = valid.filter("apart <= 60").groupBy("drive_id").agg(F.avg("apart").alias("apart"))
    joined = mileage.per_drive(telemetry).join(counts, "drive_id", "left").join(spaced, "drive_id", "left").fillna(0, ["all", "n"])
    n, km = F.col("n"), F.col("auto_km")
    per, text = km_per_event(n, km)
    interval = F.coalesce(F.col("apart"), F.try_divide("auto_s", n), F.col("auto_s")) / 60
    metrics = {"takeovers": (n, ""), "takeovers_invalid": (F.col("all") - n, ""), "takeovers_per_100km": (per_100(n, km), "1/100 km"), "km_per_takeover": (per, "km"), "takeover_interval": (interval, "min")}
    events = event_rows(valid.select("drive_id", F.col("at").alias("start_ts"), F.col("at").alias("end_ts"), F.lit(1).alias("frame_count"), F.col("prior").alias("peak")), "takeover")
    return Result(metric_rows(joined, metrics, {"km_per_takeover": text}), events)
