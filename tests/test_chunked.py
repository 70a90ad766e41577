"""Operators over chunks against plain loops over whole series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadmetrics.functions import boxes
from roadmetrics.functions.filters import block_pass, butter2, lowpass, steady_state
from roadmetrics.operators.chunked import Series, carried_value, over_chunks, running_sum
from roadmetrics.operators.intervals import in_cells, meet
from roadmetrics.operators.recurrence import lowpass_series
from roadmetrics.operators.sampling import decimate_greedy


def by_value(b, a, x, z):
    out = []
    for v in x:
        y = b[0] * v + z[0]
        z = (b[1] * v - a[1] * y + z[1], b[2] * v - a[2] * y)
        out.append(y)
    return np.array(out), np.array(z)


def test_a_block_is_an_affine_map_of_its_states():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 9, 10, 50, 101, 1000):
        b, a = butter2(rng.uniform(0.01, 0.98))
        x, z = rng.normal(size=n), rng.normal(size=2)
        got, want = block_pass(b, a, x, z), by_value(b, a, x, z)
        assert got[0] == pytest.approx(want[0], rel=1e-9, abs=1e-9) and got[1] == pytest.approx(want[1], rel=1e-9, abs=1e-9)
    b, a = butter2(0.3)
    assert block_pass(b, a, np.full(40, 2.5), steady_state(b, a) * 2.5)[0] == pytest.approx(np.full(40, 2.5))


def test_states_before_chunks_take_plain_arrays():
    """Thousands of chunks of many series stand in one batch of a task: arrays hold them, not an object for each."""
    from roadmetrics.operators.recurrence import _compose

    (b, a), x = butter2(0.3), np.random.default_rng(3).normal(size=100)
    parts = np.split(x, [7, 30, 31])
    ends = np.array([block_pass(b, a, p, np.zeros(2))[1] for p in parts])
    got, state = _compose(np.array([len(p) for p in parts]), x[0], ends, b, a), steady_state(b, a) * x[0]
    for i, p in enumerate(parts):
        assert got[i] == pytest.approx(state, rel=1e-9, abs=1e-12)
        state = block_pass(b, a, p, state)[1]


@pytest.fixture(scope="module")
def series(spark):
    """Drives of very different lengths with bursts and pauses, some rows at the same time, and one without a name."""
    rng, rows = np.random.default_rng(2), []
    for drive, n in (("a", 400), ("b", 9), ("c", 10), ("d", 1), (None, 37), ("e", 120)):
        t = np.cumsum(rng.choice([0.0, 0.1, 0.1, 0.1, 7.0, 90.0], n)) - 50
        rows += [(drive, float(x), i, float(v), None if rng.random() < 0.3 else float(v)) for i, (x, v) in enumerate(zip(t, rng.normal(size=n)))]
    return spark.createDataFrame(rows, "drive_id string, t double, k bigint, v double, w double").repartition(3).cache(), rows


@pytest.mark.parametrize("chunk", [0.35, 20.0, 1e6])
def test_low_pass_in_chunks(series, chunk):
    df, rows = series
    got = {(r.drive_id, r.k): r.y for r in lowpass_series(df, "drive_id", "t", "v", "y", 3.0, 10.0, chunk, ("k",)).collect()}
    assert len(got) == len(rows)
    for drive in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == drive]
        assert [got[drive, r[2]] for r in own] == pytest.approx(lowpass(np.array([r[3] for r in own]), 3.0, 10.0), rel=1e-9, abs=1e-9)
    assert lowpass_series(df, "drive_id", "t", "v", "y", 5.0, 10.0, chunk).filter("y != v").count() == 0


@pytest.mark.parametrize("interval, chunk", [(0.1, None), (0.25, 3.0), (5.0, 80.0), (100.0, 150.0), (1.0, 1.0)])
def test_greedy_decimation(series, interval, chunk):
    df, rows = series
    want = set()
    for drive in {r[0] for r in rows}:
        last = -np.inf
        for r in (r for r in rows if r[0] == drive):
            if r[1] - last >= interval:
                want.add((drive, r[2]))
                last = r[1]
    got = decimate_greedy(df, "drive_id", "t", interval, ("k",), chunk)
    assert got.columns == df.columns and {(r.drive_id, r.k) for r in got.collect()} == want


@pytest.mark.parametrize("chunk", [None, 0.35, 20.0])
def test_windows_and_running_values_over_chunks(series, chunk):
    df, rows = series
    s = Series(("drive_id",), ("t", "k"), chunk)
    seen = over_chunks(df, s, lambda d, w: d.withColumns({"around": F.sum("v").over(w.rowsBetween(-3, 2)), "n": F.count(F.lit(1)).over(w.rowsBetween(-3, 2)), "before": F.lag("k").over(w)}), 3, 2)
    got = {(r.drive_id, r.k): r for r in seen.collect()}
    total = {(r.drive_id, r.k): r.total for r in running_sum(s.cut(df), s, F.col("k") % 5, "total").collect()}
    last = {(r.drive_id, r.k): r["last"] for r in carried_value(s.cut(df), s, F.col("w"), "last").collect()}
    assert len(got) == len(total) == len(last) == len(rows)
    for drive in {r[0] for r in rows}:
        own, carried = [r for r in rows if r[0] == drive], None
        for i, r in enumerate(own):
            near = [x[3] for x in own[max(0, i - 3) : i + 3]]
            assert got[drive, i].around == pytest.approx(sum(near)) and got[drive, i].n == len(near) and got[drive, i].before == (i - 1 if i else None)
            carried = r[4] if r[4] is not None else carried
            assert last[drive, i] == carried and total[drive, i] == sum(j % 5 for j in range(i + 1))


def test_intervals_of_very_uneven_length(spark):
    rng = np.random.default_rng(3)
    points = [(d, float(t), i) for i, (d, t) in enumerate(zip(rng.choice(list("ab"), 200), np.round(rng.uniform(-1e6, 1e6, 200), 1)))]
    start = np.round(rng.uniform(-1e6, 1e6, 300), 1)
    intervals = [(str(d), float(s), float(s + n), f"i{i}") for i, (d, s, n) in enumerate(zip(rng.choice(list("abc"), 300), start, np.round(10 ** rng.uniform(-1, 6.3, 300), 1)))]
    intervals += [(p[0], p[1], p[1], f"p{p[2]}") for p in points[:20]] + [("a", 5.0, 4.0, "backwards"), ("a", None, 4.0, "open")]
    held = spark.createDataFrame(intervals, "drive_id string, start_ts double, end_ts double, name string")
    got = {(r.k, r.name) for r in meet(spark.createDataFrame(points, "drive_id string, t double, k bigint"), held, 10.0).collect()}
    assert got == {(k, n) for d, t, k in points for e, a, b, n in intervals if d == e and a is not None and a <= t <= b}
    assert in_cells(held.filter("start_ts <= end_ts"), 10.0).groupBy("name").count().agg(F.max("count")).first()[0] <= 2


def test_turned_boxes_against_polygons(spark):
    rng = np.random.default_rng(4)
    rows = [tuple(map(float, (*rng.uniform(-6, 6, 2), *rng.uniform(0.2, 9, 2), rng.uniform(-4, 4), *rng.uniform(-6, 6, 2), *rng.uniform(0.2, 9, 2), rng.uniform(-4, 4)))) for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(10)))
    one, two = (boxes.Turned(*[F.col(f"c{i}") for i in range(a, a + 5)]) for a in (0, 5))
    polygon = lambda b: boxes.corners(b.x, b.y, b.length, b.width, b.heading)
    got = df.select(boxes.turned_distance(one, two).alias("a"), boxes.polygon_distance(polygon(one), polygon(two)).alias("b")).collect()
    assert [r.a for r in got] == pytest.approx([r.b for r in got], abs=1e-9)
    assert 30 < sum(r.a == 0 for r in got) < 270
