"""Frames that hold what a program asks for, and what is written when programs share results."""

import os

import pytest
from pyspark.sql import functions as F

from roadmetrics.plans import PROGRAMS
from roadmetrics.queries.programs import telemetry
from roadmetrics.sources.shared import shared_folder
from tests.oracle import SF


def twice(tel):
    """Telemetry in which every localization has another one at the same time."""
    loc = tel.tables["localization"]
    tel.tables["localization"] = loc.unionByName(loc.withColumns({"lat": F.col("lat") + 1, "sd_east": F.col("sd_east") + 2}))
    return tel


def test_frames_with_few_fields_equal_whole_ones(spark):
    columns = ["drive_id", "t", "is_auto", F.col("localization.lat"), F.col("chassis.speed")]
    few = twice(telemetry(spark, SF)).narrow().frames_with("localization.lat", "chassis.speed")
    assert few.columns == ["drive_id", "t", "operator_type", "localization", "chassis", "is_auto"]
    assert sorted(few.select(columns).collect()) == sorted(twice(telemetry(spark, SF)).frames().select(columns).collect())


@pytest.mark.parametrize("name, absent", [("speeding", ("path", "items", "sd_east")), ("quality", ("path", "items", "lat")), ("lane_keeping", ("path", "items")), ("mileage", ("path", "items", "speed"))])
def test_programs_align_only_their_fields(spark, name, absent):
    plan = PROGRAMS[name][0](telemetry(spark, SF).narrow()).metrics._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [last(_" in x]
    assert not any(f"{c}: " in w or f"{c}#" in w or f", {c}," in w for w in windows for c in absent)
    schemas = [f.dataType.simpleString() for f in telemetry(spark, SF).narrow().frames_with("chassis.speed").schema if f.name == "chassis"]
    assert schemas == ["struct<drive_id:string,t:double,speed:double,key:bigint>"]


def test_right_rows_carry_nothing_into_the_second_sort(spark):
    from roadmetrics.operators.asof import Right, align

    base = spark.range(3).select(F.lit("a").alias("drive_id"), F.col("id").cast("double").alias("t"), F.col("id").alias("event_id"))
    plan = align(base, [Right(base.withColumn("x", F.lit(1)), "r")])._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (_tag" in plan


def test_shared_results_write_what_is_asked_for(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    tel = telemetry(spark, SF).shared()
    assert tel.result("localization").events.count() > 0 and tel.result("mileage").events is None
    made = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert "localization-events" in made and not any(x.endswith("-metrics") for x in made)
    assert tel.result("localization").metrics.count() > 0


def test_obstacles_are_measured_once_per_frame(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    PROGRAMS["roi"][0](telemetry(spark, SF).shared(whole=False)).metrics.count()
    made = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before)
    assert made == ["frames", "obstacles-per-frame"]
