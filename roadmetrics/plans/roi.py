"""Obstacles around the vehicle: counts by region, nearest distances, time to collision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes
from ..operators import stats
from ..operators.islands import number_islands
from .base import Result, Telemetry, event_rows, metric_rows, program

EGO = boxes.Ego()
MID, FAR = EGO.roi(10, 5, 3, 3), EGO.roi(50, 10, 5, 5)


def measured(telemetry: Telemetry, only: tuple[str, ...] = ()) -> DataFrame:
    """Frames with an array of measured obstacles (all that is measured, or only some of it) and the ego speed (m/s); frames
    without obstacles keep an empty array."""
    c = telemetry.config

    def measure(o):
        box = boxes.Box(o["x_min"], o["x_max"], o["y_min"], o["y_max"])
        parts = {
            "track_id": o["track_id"], "type": o["type"], "still": o["motion"] == 3, "distance": boxes.box_distance(box, EGO), "near": boxes.in_circle(box, o["x"], o["y"], c.near_m),
            "mid": boxes.in_rect(box, MID), "far": boxes.in_rect(box, FAR), "ttc": boxes.time_to_collision(box, F.col("ego"), o["vx"], EGO), "direction": boxes.direction(box, o["y"], EGO),
        }
        return F.struct(*[x.alias(n) for n, x in parts.items() if not only or n in only])

    def bounded(o):
        length, width = F.greatest(F.coalesce(o["length"], F.lit(0.5)), F.lit(0.5)), F.greatest(F.coalesce(o["width"], F.lit(0.5)), F.lit(0.5))
        c, s = F.abs(F.cos(o["heading"])), F.abs(F.sin(o["heading"]))
        return F.struct(*[o[n].alias(n) for n in ("track_id", "x", "y", "vx", "motion", "type")], ((length * c + width * s) / 2).alias("half_x"), ((length * s + width * c) / 2).alias("half_y"))

    def edges(o):
        x, y = o["half_x"], o["half_y"]
        return F.struct(*[o[n].alias(n) for n in ("track_id", "x", "y", "vx", "motion", "type")], (o["x"] - x).alias("x_min"), (o["x"] + x).alias("x_max"), (o["y"] - y).alias("y_min"), (o["y"] + y).alias("y_max"))

    f = telemetry.frames_with("chassis.speed", "obstacles.items").select("drive_id", "t", (F.coalesce(F.col("chassis.speed"), F.lit(0.0)) / 3.6).alias("ego"), F.coalesce("obstacles.items", F.array().cast("array<struct<track_id: bigint, x: double, y: double, vx: double, vy: double, length: double, width: double, heading: double, motion: int, type: int>>")).alias("items"))
    # In steps, as an expression within a lambda is worked out anew wherever it stands.
    return f.select("drive_id", "t", "ego", F.transform(F.transform(F.transform("items", bounded), edges), measure).alias("seen"))


def sessions(rows: DataFrame, value: str, gap: float) -> DataFrame:
    """Events of a track: rows at most gap apart; least value, commonest type, the thirty lowest per drive."""
    w = Window.partitionBy("drive_id", "track_id").orderBy("t")
    staged = rows.withColumn("_b", F.coalesce(F.col("t") - F.lag("t").over(w) > gap, F.lit(True)))
    found = number_islands(staged, ["drive_id", "track_id"], ["t"], F.col("_b")).groupBy("drive_id", "track_id", "island").agg(
        F.min("t").alias("start_ts"), F.max("t").alias("end_ts"), F.count(F.lit(1)).alias("frame_count"), F.min(value).alias("peak"), F.mode("type", deterministic=True).alias("type")
    )
    lowest = Window.partitionBy("drive_id").orderBy("peak", "start_ts", "track_id")
    return found.withColumn("_k", F.row_number().over(lowest)).filter("_k <= 30").drop("_k", "island")


def area_counts(area: str) -> dict[str, Column]:
    """How many obstacles of a frame are in the area, standing and moving."""
    count = lambda keep: F.size(F.filter("seen", keep))
    return {f"{area}_total": count(lambda o: o[area]), f"{area}_static": count(lambda o: o[area] & o["still"]), f"{area}_moving": count(lambda o: o[area] & ~o["still"])}


def near_scenes(telemetry: Telemetry, most: int = 20, below_m: float = 3.0) -> DataFrame:
    """The ``most`` frames with the nearest obstacles, if nearer than below_m: rank, drive_id, t, distance, track_id, type,
    direction, obstacles (how many the frame has) and level (1 below a metre, 2 below danger_m, 3 below two, 4 beyond)."""
    c = telemetry.config
    nearest = F.array_min(F.transform("seen", lambda o, i: F.struct(o["distance"].alias("distance"), i.alias("i"), o["track_id"].alias("track_id"), o["type"].alias("type"), o["direction"].alias("direction"))))
    found = measured(telemetry, ("distance", "track_id", "type", "direction")).select("drive_id", "t", nearest.alias("n"), F.size("seen").alias("obstacles")).filter(F.col("n.distance") < below_m)
    top = found.orderBy("n.distance", "t", "drive_id").limit(most)
    level = F.when(F.col("distance") < 1.0, 1).when(F.col("distance") < c.danger_m, 2).when(F.col("distance") < 2.0, 3).otherwise(4)
    flat = top.select("drive_id", "t", "n.distance", "n.track_id", "n.type", "n.direction", "obstacles").withColumn("level", level)
    return flat.withColumn("rank", F.row_number().over(Window.orderBy("distance", "t", "drive_id")))


@program("roi")
def roi(telemetry: Telemetry) -> Result:
    c, frames = telemetry.config, measured(telemetry)
    columns = {}
    for area in ("near", "mid", "far"):
        columns |= area_counts(area)
    nearest = F.array_min(F.transform("seen", lambda o, i: F.struct(o["distance"].alias("distance"), i.alias("i"), o["track_id"].alias("track_id"), o["type"].alias("type"))))
    first = F.array_min(F.transform(F.filter("seen", lambda o: o["ttc"].isNotNull()), lambda o, i: F.struct(o["ttc"].alias("ttc"), i.alias("i"), o["track_id"].alias("track_id"), o["type"].alias("type"))))
    # The nearest with the columns that are counted: narrow rows, which several aggregates read.
    per_frame = telemetry.once("obstacles-per-frame", lambda: frames.withColumns(columns | {"nearest": nearest, "first": first}).drop("seen", "ego"))
    per = per_frame.groupBy("drive_id").agg(
        *[F.avg(n).alias(n) for n in columns], F.max("near_total").alias("near_max"), F.percentile("near_total", F.lit(0.95)).alias("near_p95"), F.percentile("nearest.distance", F.lit(0.05)).alias("nearest_p5"),
        stats.rate(F.coalesce(F.col("nearest.distance") < c.danger_m, F.lit(False))).alias("danger"), F.percentile("first.ttc", F.lit(0.05)).alias("ttc_p5"),
    )
    typed = lambda what, name: per_frame.filter(F.col(what).isNotNull()).groupBy("drive_id", F.col(f"{what}.type").alias("type")).agg(stats.low_percentile(F.col(f"{what}.{name}")).alias("value")).select("drive_id", F.concat(F.lit(f"{name}_p5_type_"), F.col("type")).alias("metric"), "value", F.lit(None).cast("string").alias("value_text"), F.lit("m" if name == "distance" else "s").alias("unit"))
    close = per_frame.filter(F.col("nearest.distance") < c.danger_m).select("drive_id", "t", "nearest.*")
    soon = per_frame.filter(F.col("first.ttc") < c.ttc_danger_s).select("drive_id", "t", "first.*")
    events = event_rows(sessions(close, "distance", c.session_gap_s), "near_obstacle").unionByName(event_rows(sessions(soon, "ttc", c.session_gap_s), "ttc"))
    metrics = {n: (F.col(n), "") for n in columns} | {"near_max": (F.col("near_max"), ""), "near_p95": (F.col("near_p95"), ""), "nearest_p5": (F.col("nearest_p5"), "m"), "danger_pct": (F.col("danger"), "%"), "ttc_p5": (F.col("ttc_p5"), "s")}
    return Result(metric_rows(per, metrics).unionByName(typed("nearest", "distance")).unionByName(typed("first", "ttc")), events)
