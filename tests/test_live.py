"""Live takeovers by buckets of drives against a loop over rows and against the table's edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadmetrics.plans.takeover import edges
from roadmetrics.streaming.live import ROWS, RUNS, live_takeovers, run_to_end, settle

FAR = (1 << 53) + 1


def looped(rows, max_gap, min_prior):
    found, runs = [], {}
    for drive, t, _, mode in sorted(rows):
        began, last, was, frames = runs.get(drive, (t, t, None, 0))
        if was == mode != -1 and t - last <= max_gap:
            runs[drive] = (began, t, mode, frames + 1)
            continue
        if was == 1 and mode == 0 and t - last <= max_gap:
            found.append((drive, t, last - began, last - began >= min_prior, frames))
        runs[drive] = (t, t, mode, 1)
    return found, runs


def made(seed, n=600, drives=7):
    r = np.random.default_rng(seed)
    t = np.round(np.cumsum(r.choice([0, 0.1, 0.5, 1.0, 1.5], n, p=[0.1, 0.3, 0.3, 0.28, 0.02])) / 3, 1)
    return [(int(d) + FAR, float(x), k, int(m)) for k, (d, x, m) in enumerate(zip(r.integers(0, drives, n), t, np.repeat(r.choice([1, 1, 0, 0, -1], n // 3), 3)))]


@pytest.mark.parametrize("pieces", [1, 5])
def test_settled_rows_equal_a_loop(pieces):
    rows = made(1)
    runs, got = np.zeros(0, RUNS), []
    ends = np.linspace(0, rows[-1][1], pieces + 1)[1:]
    piece = np.searchsorted(ends, [r[1] for r in rows])
    for i in range(pieces):
        part = np.array([r for r, p in zip(rows, piece) if p == i], ROWS)
        runs, found = settle(runs, part[np.random.default_rng(i).permutation(len(part))], 2.0, 1.5)
        got += found.itertuples(index=False, name=None)
    want, open_ = looped(rows, 2.0, 1.5)
    assert sorted(got) == sorted(want) and len(want) > 20
    assert {int(r["drive"]): (r["began"], r["last"], r["mode"], r["frames"]) for r in runs} == open_
    assert not len(settle(runs[:0], np.zeros(0, ROWS), 2.0, 1.5)[0])


def test_stream_in_pieces_equals_the_table(spark, tmp_path):
    """Unknown modes are no manual driving, ids beyond 2^53 share batches with heartbeats, and state is held by bucket."""
    source, end, most = made(2, 900, 60), 0, 0
    row = lambda d, t, k, m: (d, t, k, None if m < 0 else bool(m))
    kind, last = "drive_id bigint, t double, key bigint, is_auto boolean", source[-1][1]
    table = [row(*r) for r in source]
    for i, upto in enumerate((0.4 * last, last, None, None)):
        part = [r for r in table if end <= r[1] < upto or r[1] == upto == last] if upto else [row(None, last + 500.0 * i, 0, 0)]
        part += [row(None, part[0][1], 0, 0), row(5, None, 1, 1)]
        end = upto
        spark.createDataFrame(part[::-1], kind).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(kind).parquet(f"{tmp_path}/in")
        run = run_to_end(spark, live_takeovers(stream, 9.0, 3.0, 5.0, buckets=4), f"{tmp_path}/out", f"{tmp_path}/mark")
        most = max([most, *(s.numRowsTotal for p in run.recentProgress for s in p.stateOperators)])
    columns = ("drive_id", "at", "prior", "valid", "frames")
    got = sorted(spark.read.parquet(f"{tmp_path}/out").select(*columns).collect())
    want = edges(spark.createDataFrame(table, kind), 9.0, 3.0, ("t", "key")).select(*columns).collect()
    assert got == sorted(want) and len(want) > 10
    assert 0 < most < 60


def test_an_unknown_mode_ends_no_autonomous_run_by_takeover(spark, tmp_path):
    kind = "drive_id bigint, t double, key bigint, is_auto boolean"
    rows = [(1, 10.0, 1, True), (1, 11.0, 2, True), (1, 12.0, 3, None), (1, 13.0, 4, False), (2, 10.0, 5, True), (2, 11.0, 6, False)]
    for part in (rows, [(None, 900.0, 0, False)], [(None, 1900.0, 0, False)]):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run_to_end(spark, live_takeovers(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), 5.0, 1.0, 5.0), f"{tmp_path}/out", f"{tmp_path}/mark")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("drive_id", "at", "prior").collect()] == [(2, 11.0, 0.0)]
    assert edges(spark.createDataFrame(rows, kind), 5.0, 1.0, ("t", "key")).select(F.col("drive_id")).collect() == [(2,)]
