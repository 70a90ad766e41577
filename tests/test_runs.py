"""Refreshing tables, running programs one by one, and metric states, with failures planted."""

import os

import pytest
from pyspark.sql import functions as F

from roadmetrics.plans import PROGRAMS, Telemetry, partial
from roadmetrics.plans.base import run_each
from roadmetrics.queries.programs import telemetry
from roadmetrics.sources.catalogue import recordings
from roadmetrics.sources.incremental import current, refresh
from tests.oracle import SF


@pytest.fixture
def table(spark, tmp_path):
    def put(bag, n):
        spark.range(n).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/in/{bag}")

    def read(files):
        if not files.head(1):
            return spark.createDataFrame([], "id bigint, bag string")
        return spark.read.parquet(*[r.path for r in files.collect()]).withColumn("bag", F.regexp_extract(F.input_file_name(), "/([^/]+)/[^/]*$", 1))

    def again(mark="1", only=None, reader=read):
        files = recordings(spark, f"file://{tmp_path}/in", "*.parquet")
        return refresh(spark, files if only is None else files.filter(F.col("bag").isin(*only)), reader, f"{tmp_path}/table", mark)

    def rows():
        return {(r.bag, r.data_build): r.n for r in current(spark, f"{tmp_path}/table").groupBy("bag", "data_build").agg(F.count(F.lit(1)).alias("n")).collect()}

    return put, again, rows


def test_only_changed_bags_are_rebuilt(table):
    put, again, rows = table
    for bag, n in (("a", 3), ("b", 4), ("c", 5)):
        put(bag, n)
    assert vars(again()) == {"build": 1, "rebuilt": 3, "kept": 0, "removed": 0}
    assert vars(again()) == {"build": 1, "rebuilt": 0, "kept": 3, "removed": 0}
    put("b", 7)
    assert vars(again()) == {"build": 2, "rebuilt": 1, "kept": 2, "removed": 0}
    assert rows() == {("a", 1): 3, ("b", 2): 7, ("c", 1): 5}
    put("c", 0)
    assert again(only=["b", "c"]).removed == 1 and rows() == {("b", 2): 7}
    assert again("2", only=["b", "c"]).rebuilt == 2 and rows() == {("b", 4): 7}


def test_a_failed_refresh_leaves_the_table_as_it_was(table):
    put, again, rows = table
    put("a", 3)
    again()
    put("a", 9)
    with pytest.raises(Exception, match="broken"):
        again(reader=lambda files: files.select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"), "bag"))
    assert rows() == {("a", 1): 3}
    assert again().build == 2 and rows() == {("a", 2): 9}


def test_a_failing_program_leaves_the_others_results(spark, tmp_path):
    tel, to = telemetry(spark, SF), f"{tmp_path}/out"
    bad = tel.tables["trajectory"].withColumn("speed_limit", F.when(F.col("t") > 1_700_000_010, F.raise_error(F.lit("torn message"))).otherwise(1.0).cast("double"))
    less = {k: v for k, v in tel.tables.items() if k not in ("control", "map")}
    broken = Telemetry(less | {"trajectory": bad.filter("drive_id IS NOT NULL")}, tel.config)
    names = ["quality", "mileage", "speeding", "takeover", "comfort", "emergency"]
    whole = tel.frames()

    class Half(Telemetry):
        """Whole frames for all programs but one, whose frames fail in a task."""

        def shared(self):
            return self

        def frames(self):
            return whole

        def result(self, name):
            if name == "speeding":
                return PROGRAMS[name][0](broken)
            return super().result(name)

    ledger = {r.program: r for r in run_each(Half(less, tel.config), to, names).collect()}
    assert {n: r.status for n, r in ledger.items() if r.status != "done"} == {"speeding": "failed", "comfort": "failed", "emergency": "failed"}
    assert "torn message" in ledger["speeding"].reason and "no topic" in ledger["comfort"].reason
    assert sorted(os.listdir(f"{to}/metrics")) == sorted(f"program={n}" for n in ("mileage", "quality", "takeover")) or not os.path.exists(f"{to}/metrics/program=speeding/_SUCCESS")
    assert spark.read.parquet(f"{to}/metrics/program=mileage").count() == ledger["mileage"].rows > 0
    fixed = {r.program: r.status for r in run_each(tel, to, names).collect()}
    assert set(fixed.values()) == {"done"}


def test_needs_of_a_failed_program_are_skipped(spark, tmp_path):
    ledger = {r.program: r for r in run_each(Telemetry({k: v for k, v in telemetry(spark, SF).tables.items() if k != "function_manager"}), f"{tmp_path}/out", ["takeover"]).collect()}
    assert ledger["mileage"].status == "failed" and ledger["takeover"].status == "skipped" and ledger["takeover"].reason == "needs mileage"


def test_states_of_batches_that_overlap_are_an_error(spark, tmp_path):
    frames = telemetry(spark, SF).frames()
    partial.add_batch(frames, str(tmp_path), 0, names=("mileage",))
    partial.add_batch(frames.filter("t < 1700000005"), str(tmp_path), 1, names=("mileage",))
    with pytest.raises(Exception, match="overlap"):
        partial.read_metrics(spark, str(tmp_path), "mileage").collect()
    partial.add_batch(frames.filter("t < 0"), str(tmp_path), 1, names=("mileage",))  # run again: what it left is replaced
    assert partial.read_metrics(spark, str(tmp_path), "mileage").count() > 0
