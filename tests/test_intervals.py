"""Intervals and smoothing against loops."""

import random

import numpy as np
import pytest
from pyspark.sql import Window

from roadmetrics.functions.filters import savgol
from roadmetrics.operators.intervals import locate
from roadmetrics.operators.windows import polynomial_smoothing


def test_locate_against_all_pairs(spark):
    """Overlapping, nested and single-point intervals, times on their edges, and a series without intervals."""
    r = random.Random(3)
    spans = [(f"d{i % 3}", f"n{i:02d}", float(a), float(a + r.choice((0, 1, 4, 40)))) for i, a in enumerate(r.randrange(0, 200) for _ in range(40))]
    points = [(i, f"d{i % 4}", float(r.randrange(-20, 260))) for i in range(200)]
    got = locate(spark.createDataFrame(points, "event_id bigint, drive_id string, t double"), spark.createDataFrame(spans, "drive_id string, name string, start_ts double, end_ts double"), 7.0)
    got = {x.event_id: (x.inside, x.nearest) for x in got.collect()}
    for i, drive, t in points:
        own = [(start, name, end) for d, name, start, end in spans if d == drive]
        held = min(((start, name) for start, name, end in own if start <= t <= end), default=(None, None))[1]
        near = min(((min(abs(t - start), abs(t - end)), start, name) for start, name, end in own), default=(None, None, None))
        assert got[i][0] == held
        if held is None:
            assert got[i][1] == near[2]


@pytest.mark.parametrize("window,order", [(7, 3), (8, 2), (5, 4), (3, 3)])
def test_smoothing_against_numpy(spark, window, order):
    r = np.random.default_rng(1)
    series = {n: r.normal(size=n) for n in (1, 2, 4, 5, 6, 7, 8, 9, 10, 30)}
    rows = [(n, i, float(x)) for n, xs in series.items() for i, x in enumerate(xs)]
    got = spark.createDataFrame(rows, "n int, t int, x double").select("n", "t", polynomial_smoothing(Window.partitionBy("n").orderBy("t"), "x", window, order).alias("y")).orderBy("n", "t").collect()
    assert [x.y for x in got] == pytest.approx([y for xs in series.values() for y in savgol(xs, window, order)])
