import json

from pyspark.sql import functions as F

from roadmetrics.operators.stats import concat_results
from roadmetrics.plans import PROGRAMS
from roadmetrics.plans.base import run
from roadmetrics.plans.comfort import score
from roadmetrics.queries import QUERIES
from roadmetrics.queries.programs import telemetry
from roadmetrics.sources.catalogue import recordings
from tests.oracle import SF


def test_comfort_score(spark):
    rows = [(1.0, 1.0, 0.1, 40.0), (3.5, 2.6, 0.6, 40.0), (9.0, 12.0, 5.0, 40.0), (None, None, None, None)]
    points, grade = score(*map(F.col, ("rms", "p99", "mean", "v")))
    got = spark.createDataFrame(rows, "rms double, p99 double, mean double, v double").select(F.round(points, 6), grade).collect()
    # At 40 km/h the limits are 1.0 (RMS) and 2.0 (peak).
    assert [tuple(r) for r in got] == [(100.0, "A"), (71.0, "C"), (10.0, "D"), (100.0, "A")]


def test_lists_are_joined_in_order(spark):
    rows = [("m", [3], 2), ("m", [1, 2], 1), ("m", None, 0), ("n", [], 1)]
    got = concat_results(spark.createDataFrame(rows, "metric string, items array<int>, ord int")).orderBy("metric").collect()
    assert [(r.metric, r["items"]) for r in got] == [("m", [1, 2, 3]), ("n", [])]


def test_recordings_of_a_folder(spark, tmp_path):
    for name, data in (("a/x.db3", b"abc"), ("a/b/y.db3", b"y"), (".hidden/z.db3", b"q"), ("a/note.txt", b"n"), ("1/2/3/4/far.db3", b"q")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = recordings(spark, str(tmp_path)).orderBy("bag").collect()
    assert [(r.bag, r.bytes) for r in got] == [("a", 3), ("b", 1)]


def test_map_features(spark):
    rows = QUERIES["curvature_geojson"](spark, SF).collect()
    kinds = {k: [json.loads(r.geojson) for r in rows if r.kind == k] for k in ("vehicle", "path", "offset")}
    assert len(kinds["vehicle"]) == len(kinds["path"]) > 0
    assert all(len(x["geometry"]["coordinates"]) == 2 and x["properties"]["distance"] > 0.1 and x["geometry"]["type"] == "LineString" for x in kinds["offset"])
    assert all(abs(x["geometry"]["coordinates"][0] - 121) < 0.1 and abs(x["geometry"]["coordinates"][1] - 31) < 0.1 for k in ("vehicle", "path") for x in kinds[k])


def test_run_names_missing_topics_and_reads_one_alignment(spark):
    full = telemetry(spark, SF)
    without = type(full)({k: v for k, v in full.tables.items() if k != "control"}, full.config)
    metrics, _, failed = run(without, ["comfort", "mileage"])
    assert list(failed) == ["comfort"] and "control" in failed["comfort"]
    assert {r.program for r in metrics.select("program").distinct().collect()} >= {"mileage"}
    assert set(failed) < set(PROGRAMS)
