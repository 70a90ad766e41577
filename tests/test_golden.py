import numpy as np
import pytest
from pyspark.sql import functions as F

from roadmetrics import config
from roadmetrics.functions.filters import butter2, lowpass, savgol
from roadmetrics.operators.asof import Right, align, interpolate
from roadmetrics.operators.islands import merge_events, runs, summarise
from roadmetrics.plans.takeover import edges


def series(spark, rows, names="t double, v double"):
    return spark.createDataFrame([("d", *r) for r in rows], f"drive_id string, {names}").withColumn("event_id", F.monotonically_increasing_id())


def nearest(spark, base, right, **how):
    left = series(spark, [(t, 0.0) for t in base])
    out = align(left, [Right(series(spark, [(t, t) for t in right]), "r", **how)])
    return [r["v"] for r in out.select("t", "r.v").orderBy("t").collect()]


def test_asof_ties_and_tolerance(spark):
    assert nearest(spark, [1.0], [0.5, 1.5], tie="earlier") == [0.5]
    assert nearest(spark, [1.0], [0.5, 1.5], tie="later") == [1.5]
    assert nearest(spark, [1.0, 2.0, 9.0], [1.0, 2.25], tolerance=0.3) == [1.0, 2.25, None]
    assert nearest(spark, [1.0], []) == [None]


def test_asof_against_numpy(spark):
    rng = np.random.default_rng(3)
    base, right = rng.uniform(0, 100, 200), rng.uniform(0, 100, 150)
    want = [right[np.argmin(np.abs(right - t))] for t in sorted(base)]
    assert nearest(spark, base.tolist(), right.tolist()) == pytest.approx(want)


def test_asof_plan_has_one_exchange(spark):
    out = align(series(spark, [(1.0, 0.0)]), [Right(series(spark, [(1.0, 1.0)]), "r")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "NestedLoop" not in plan


def test_interpolation_clamps(spark):
    out = interpolate(series(spark, [(0.0, 0.0), (1.5, 0.0), (9.0, 0.0)]), series(spark, [(1.0, 10.0), (2.0, 20.0)]), "v", "x")
    assert [r["x"] for r in out.orderBy("t").collect()] == [10.0, 15.0, 20.0]


def test_runs_break_at_gaps_and_end_of_series(spark):
    rows = series(spark, [(0.0, 1.0), (0.1, 1.0), (1.0, 1.0), (1.1, 0.0), (1.2, 1.0)])
    found = summarise(runs(rows, ["drive_id"], ["t"], F.col("v") > 0, max_gap=0.5), ["drive_id"], F.col("v"))
    assert [(r.start_ts, r.end_ts, r.frame_count) for r in found.orderBy("start_ts").collect()] == [(0.0, 0.1, 2), (1.0, 1.0, 1), (1.2, 1.2, 1)]


def test_merge_gap_is_inclusive(spark):
    events = spark.createDataFrame([("d", 0.0, 1.0), ("d", 1.5, 2.0), ("d", 2.75, 3.0)], "drive_id string, start_ts double, end_ts double")
    assert merge_events(events, ["drive_id"], 0.5).select("merged").distinct().count() == 2


def test_takeover_edges(spark):
    rows = [(0.0, True), (0.5, True), (1.0, True), (1.5, False), (2.0, True), (2.5, False), (9.0, True), (19.0, False)]
    found = edges(spark.createDataFrame([("d", *r) for r in rows], "drive_id string, t double, is_auto boolean")).orderBy("at").collect()
    assert [(r.at, r.valid) for r in found] == [(1.5, True), (2.5, False)]


def test_filters():
    b, a = butter2(0.3)
    assert b.sum() / a.sum() == pytest.approx(1)
    t = np.arange(0, 20, 0.02)
    slow = np.sin(2 * np.pi * 0.5 * t)
    assert np.abs(lowpass(slow, 10, 50) - slow)[50:-50].max() < 0.01
    assert lowpass(np.ones(5), 10, 50).tolist() == [1.0] * 5
    cubic = np.arange(30.0) ** 3
    assert savgol(cubic, 7, 3) == pytest.approx(cubic)


def test_config_warns():
    assert config.warnings(config.Config()) == []
    assert config.load(None, bend=0.05, other=1).extra == {"other": 1}
    assert config.warnings(config.load(None, bend=0.05)) == ["bend is not below sharp"]


def test_streaming_ingest_and_sessions(spark, tmp_path):
    from roadmetrics.streaming import auto_sessions, ingest

    schema = "drive_id string, bag string, t double, operator_type int"
    rows = [("d", "b", t, 2) for t in (0.0, 0.5, 1.0, 9.0)] + [("d", "b", 9.5, 0), (None, "b", 1.0, 2)]
    source, table, rejected = (str(tmp_path / n) for n in ("in", "out", "rejected"))
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, source, schema, table, rejected, str(tmp_path / "mark"))
    assert spark.read.parquet(table).count() == 5 and spark.read.parquet(rejected).count() == 1
    got = auto_sessions(spark.read.parquet(table), gap_s=1.0).orderBy("start_ts").collect()
    assert [(r.start_ts, r.frames) for r in got] == [(0.0, 3), (9.0, 1)]


def test_reports(spark, tmp_path):
    from roadmetrics.sources.reports import write_report

    metrics = spark.createDataFrame([("d", "m", 1.5, None, "km")], "drive_id string, metric string, value double, value_text string, unit string")
    for kind in ("csv", "json", "parquet"):
        write_report(metrics, str(tmp_path / kind), kind)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1
    assert spark.read.json(str(tmp_path / "json")).first()["value"] == 1.5


def test_alignment_sorts_once(spark):
    """Rows before and after are read off one order, for rows of equal time and for long stretches without a right row too."""
    left = series(spark, [(float(t), 0.0) for t in (0, 1, 1, 5, 9)])
    right = series(spark, [(1.0, 1.0), (4.0, 4.0), (4.0, 4.0), (8.0, 8.0)])
    out = align(left, [Right(right, "near", 9.0), Right(right.filter("t = 8"), "far", 9.0, fields=("t",))])
    assert out._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    out = align(left, [Right(right, "near"), Right(right.filter("t = 8"), "far", fields=("t",))], chunk=3.0)
    got = [(r.t, r.near.asDict().keys() >= {"drive_id", "t", "v", "event_id"}, r.near.t, r.far.asDict()) for r in out.orderBy("t").collect()]
    assert got == [(t, True, n, {"t": 8.0}) for t, n in ((0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (5.0, 4.0), (9.0, 8.0))]
