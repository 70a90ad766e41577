"""Scenes: the lane a vehicle is in, junction intervals, scene tags on events, junction pass rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.asof import Right, align
from ..operators.chunked import Series, over_chunks
from ..operators.intervals import meet
from ..operators.islands import number_islands
from ..schemas import TURNS
from .base import Result, Telemetry, by_content, metric_rows, program

#: Families of events that make a junction passage a failure.
FAILURES = ("takeover", "hard_braking", "jerk_event")
SLACK = 0.5


def current_lane(lanes: Column) -> Column:
    """The second non-empty lane of a trajectory, else the first."""
    named = F.filter(lanes, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.get(named, 1), F.get(named, 0))


def tagged(rows: DataFrame, telemetry: Telemetry) -> DataFrame:
    """rows (drive_id, t, key) with lane, turn and junction of the nearest trajectory and map snapshot."""
    trajectory = by_content(telemetry.topic("trajectory").select("drive_id", "t", current_lane(F.col("lane_id")).alias("lane")))
    snapshots = telemetry.topic("map").select("drive_id", "t", "lanes").withColumn("key", F.xxhash64(F.map_keys("lanes"), F.map_values("lanes")))
    out = align(rows, [Right(trajectory, "traj", None, "later", ("t", "lane")), Right(snapshots, "map", None, "earlier", ("t", "lanes"))], key="key", chunk=telemetry.config.chunk_s)
    lane = F.try_element_at("map.lanes", F.col("traj.lane"))
    turn = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TURNS.items() for x in kv]), lane["turn"]), F.lit("unknown"))
    junction = F.when(lane["junction_id"] != "", lane["junction_id"])
    return out.withColumns({"lane": F.col("traj.lane"), "turn": turn, "junction": junction}).drop("traj", "map")


def occupancy(rows: DataFrame, junction: str, order: tuple[str, ...] = ("t",), *more: Column, chunk: float | None = None) -> DataFrame:
    """Intervals in which a drive is in one junction: enter_ts, exit_ts (the first row after it, null at the end). With
    chunk, drives are cut into pieces of that many seconds."""

    def neighbours(df, w):
        return df.withColumns({"_b": ~F.lag(junction).over(w).eqNullSafe(F.col(junction)) | F.lag("t").over(w).isNull(), "_next_t": F.lead("t").over(w)})

    staged = over_chunks(rows, Series(("drive_id",), order, chunk), neighbours, 1, 1)
    inside = number_islands(staged, ["drive_id"], list(order), F.col("_b"), chunk=chunk).filter(F.col(junction).isNotNull())
    return inside.groupBy("drive_id", F.col(junction).alias("junction"), "island").agg(F.min("t").alias("enter_ts"), F.max("_next_t").alias("exit_ts"), *more).drop("island")


def annotate(events: DataFrame, telemetry: Telemetry) -> DataFrame:
    """Events with the scene (lane, turn, junction) of their start."""
    keyed = events.withColumn("t", F.col("start_ts")).withColumn("key", F.lit(0).cast("bigint"))
    return tagged(keyed, telemetry).drop("t", "key")


def passages(telemetry: Telemetry, events: DataFrame) -> DataFrame:
    """Junction intervals of autonomous frames with their turn and whether an event of a failing family came within them."""
    rows = telemetry.frames_with().filter("is_auto").select("drive_id", "t").withColumn("key", F.lit(0).cast("bigint"))
    seen = tagged(rows, telemetry)
    turn = F.coalesce(F.max_by("turn", F.when((F.col("turn") != "straight") & (F.col("turn") != "unknown"), F.col("t"))), F.lit("straight")).alias("turn")
    intervals = occupancy(seen, "junction", ("t", "key"), turn, F.max("t").alias("last_ts"), chunk=telemetry.config.chunk_s).withColumn("until", F.coalesce("exit_ts", "last_ts"))
    bad = events.filter(F.col("family").isin(*FAILURES)).select("drive_id", F.col("start_ts").alias("bad_t"))
    reach = intervals.withColumns({"_from": F.col("enter_ts") - SLACK, "_to": F.col("until") + SLACK})
    hit = meet(bad, reach, 60.0, "bad_t", start="_from", end="_to")
    failed = hit.select("drive_id", "enter_ts").distinct().withColumn("failed", F.lit(True))
    return intervals.join(failed, ["drive_id", "enter_ts"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))


def pass_rate(passed: DataFrame) -> DataFrame:
    """Totals and one row per turn: total, passed, failed, rate."""
    out = passed.rollup("drive_id", "turn").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("failed")).alias("passed"), F.count_if("failed").alias("failed"))
    out = out.filter("drive_id IS NOT NULL").withColumn("turn", F.coalesce("turn", F.lit("all")))
    return out.withColumn("rate", F.col("passed") * 100.0 / F.col("total"))


@program("junctions", needs=("takeover", "emergency"))
def junctions(telemetry: Telemetry) -> Result:
    events = telemetry.result("takeover").events.unionByName(telemetry.result("emergency").events)
    rates = pass_rate(passages(telemetry, events)).groupBy("drive_id").agg(
        F.max(F.when(F.col("turn") == "all", F.col("total"))).alias("total"), F.max(F.when(F.col("turn") == "all", F.col("passed"))).alias("passed"), F.max(F.when(F.col("turn") == "all", F.col("rate"))).alias("rate"),
        *[F.max(F.when(F.col("turn") == x, F.col("rate"))).alias(x) for x in TURNS.values()],
    )
    metrics = {"junctions": (F.col("total"), ""), "junctions_passed": (F.col("passed"), ""), "junction_pass_rate": (F.col("rate"), "%")}
    return Result(metric_rows(rates, metrics | {f"junction_pass_rate_{x}": (F.col(x), "%") for x in TURNS.values()}))
