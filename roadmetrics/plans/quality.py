"""Quality of the recordings: missing topics, coverage of frames, gaps between bags, message rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import median_step
from ..schemas import RATES, TOPICS
from ..sources.catalogue import bag_spans
from .base import ALIGNED, Result, Telemetry, metric_rows, program


def bag_gaps(bags: DataFrame, flagged: float = 1.0) -> DataFrame:
    """Gaps between a drive's consecutive bags (only positive ones), and whether they exceed a second."""
    w = Window.partitionBy("drive_id").orderBy("start_ts", "name")
    out = bags.withColumns({"next": F.lead("name").over(w), "gap": F.lead("start_ts").over(w) - F.col("end_ts")})
    return out.filter("gap > 0").select("drive_id", "name", "next", "gap", (F.col("gap") > flagged).alias("flagged"))


def coverage(telemetry: Telemetry) -> DataFrame:
    """Percent of frames that have each topic."""
    frames = telemetry.frames_with(*[f"{t}.t" for t in ALIGNED])
    topics = [t for t in ("localization", "chassis", "trajectory", "obstacles", "control_debug") if t in frames.columns]
    return frames.groupBy("drive_id").agg(*[F.avg(F.when(F.col(t).isNotNull(), 100.0).otherwise(0.0)).alias(t) for t in topics])


def rates(telemetry: Telemetry) -> DataFrame:
    """Measured message rate by topic and whether it is below half the nominal one (20 Hz for the 50 Hz topics)."""
    parts = []
    for topic, nominal in RATES.items():
        if topic in telemetry.tables:
            least = 20.0 if nominal >= 50 else nominal / 2
            step = median_step(telemetry.topic(topic), ["drive_id"], upto=1.0)
            parts.append(step.select("drive_id", F.lit(topic).alias("topic"), (1 / F.col("dt")).alias("rate"), (1 / F.col("dt") < least).alias("low")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@program("quality")
def quality(telemetry: Telemetry) -> Result:
    covered = coverage(telemetry)
    topics = [c for c in covered.columns if c != "drive_id"]
    return Result(metric_rows(covered, {f"coverage_{t}": (F.col(t), "%") for t in topics} | {"coverage_low_topics": (sum((F.when(F.col(t) < 80, 1).otherwise(0) for t in topics), F.lit(0)), "")}))


@program("recordings")
def recordings(telemetry: Telemetry) -> Result:
    """Gaps between a drive's bags, the measured rate of each topic, topics below their rate, and topics that are missing."""
    gaps = bag_gaps(bag_spans(telemetry.topic("function_manager")))
    found = gaps.groupBy("drive_id").agg(F.count(F.lit(1)).alias("gaps"), F.count_if("flagged").alias("long"), F.sum("gap").alias("seconds"))
    measured = rates(telemetry)
    low = measured.groupBy("drive_id").agg(F.count_if("low").alias("low"))
    drives = telemetry.topic("function_manager").select("drive_id").distinct()
    lacking = sorted(set(TOPICS) - set(telemetry.tables))
    joined = drives.join(found, "drive_id", "left").join(low, "drive_id", "left").fillna(0, ["gaps", "long", "seconds", "low"])
    metrics = {"bag_gaps": (F.col("gaps"), ""), "bag_gaps_long": (F.col("long"), ""), "bag_gap_s": (F.col("seconds"), "s"), "rate_low_topics": (F.col("low"), ""), "topics_missing": (F.lit(len(lacking)), "")}
    per_topic = measured.select("drive_id", F.concat(F.lit("rate_"), "topic").alias("metric"), F.col("rate").alias("value"), F.lit(None).cast("string").alias("value_text"), F.lit("Hz").alias("unit"))
    return Result(metric_rows(joined, metrics, {"topics_missing": F.lit(", ".join(lacking))}).unionByName(per_topic))
