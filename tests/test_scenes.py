import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadmetrics.config import Config
from roadmetrics.plans import Telemetry
from roadmetrics.plans.steering import flip_events, flip_windows
from roadmetrics.plans.weaving import event_features
from roadmetrics.queries.programs import telemetry
from roadmetrics.sources.control_debug import FIELDS, decode, values
from tests.oracle import SF


def flips_of(t, rate, least):
    """Sign changes a second among the rates that reach the least one."""
    high = np.abs(rate) >= least
    t, sign = t[high], np.sign(rate[high])
    return (np.diff(sign) != 0).sum() / (t[-1] - t[0]) if len(t) > 1 and t[-1] > t[0] else 0.0


def test_flip_windows_against_a_loop(spark):
    rng, c = np.random.default_rng(5), Config()
    t = np.arange(300) * 0.02
    rate = np.where(rng.random(300) < 0.3, 0.0, rng.normal(0, 12, 300))
    speed = rng.uniform(20, 60, 300)
    rows = spark.createDataFrame([("d", "d-0", float(a), float(b), float(v)) for a, b, v in zip(t, rate, speed)], "drive_id string, segment string, t double, rate double, speed double")
    got = flip_windows(Telemetry({}, c), rows).orderBy("t").collect()
    step = float(np.median(np.diff(t)))
    size, move = int(1 / step * c.steer_window_s), max(int(1 / step * c.steer_step_s), 1)
    want = [(t[s + size // 2], flips_of(t[s : s + size], rate[s : s + size], c.flip_min_rate), speed[s : s + size].mean()) for s in range(0, 300 - size + 1, move)]
    assert len(got) == len(want) > 40
    for row, (at, flips, v) in zip(got, want):
        assert (row.t, row.flips, row.speed) == pytest.approx((at, flips, v))


def test_flip_events_keep_the_peak_of_neighbours(spark):
    c = Config()
    t = np.arange(400) * 0.02
    rate = np.where((t >= 2) & (t < 4), 20 * np.sign(np.sin(2 * np.pi * 4 * t + 0.1)), 6.0)
    rows = spark.createDataFrame([("d", "d-0", float(a), float(b), 40.0) for a, b in zip(t, rate)], "drive_id string, segment string, t double, rate double, speed double")
    per = lambda flips: spark.createDataFrame([("d", flips, 40.0)], "drive_id string, flips double, speed double")
    found = flip_events(Telemetry({}, c), rows, per(3.0)).collect()
    assert len(found) == 1 and 2 <= found[0].start_ts <= 4 and found[0].peak == pytest.approx(8, abs=1)
    assert flip_events(Telemetry({}, c), rows, per(1.0)).count() == 0


def test_event_features(spark):
    tel = telemetry(spark, SF)
    began = 1_700_000_000.0
    events = spark.createDataFrame([("d0", began + 9.0, began + 12.0), ("d0", began + 20.02, began + 20.03)], "drive_id string, start_ts double, end_ts double")
    rows = event_features(events, tel).collect()
    points = sorted((json.loads(r.geojson) for r in rows if r.kind == "point"), key=lambda x: x["properties"]["index"])
    lines = [json.loads(r.geojson) for r in rows if r.kind == "line"]
    assert len(lines) == 1 and len(points) >= 30 and [p["properties"]["index"] for p in points] == list(range(len(points)))
    assert lines[0]["geometry"]["coordinates"] == [p["geometry"]["coordinates"] for p in points]
    assert max(p["properties"]["share"] for p in points) == 1.0


def message(*parts):
    return b"".join(parts)


def double(number, value):
    return bytes(varint(number << 3 | 1)) + struct.pack("<d", value)


def varint(n):
    out = []
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return [*out, n]


def nested(number, body):
    return bytes([*varint(number << 3 | 2), *varint(len(body))]) + body


def test_control_debug_payload(spark):
    lateral = message(double(2, 9.5), double(3, 0.25), bytes([*varint(60 << 3), *varint(300)]), double(5, -1.5), double(7, 0.01), nested(20, b"skipped" * 40))
    longitudinal = message(bytes([8, 20]), double(6, 8.0), double(17, 0.5), double(19, -0.75), bytes([*varint(50 << 3 | 5), 1, 2, 3, 4]))
    whole = message(nested(1, longitudinal), nested(2, lateral), double(3, 1.0))
    named = dict(zip(FIELDS, values(whole)))
    assert named == {"lateral_error": 0.25, "heading_error": 0.0, "lateral_error_raw": -1.5, "heading_error_raw": 0.0, "ref_kappa": 0.01, "vehicle_speed": 9.5, "current_speed": 8.0, "current_acceleration": 0.0, "acceleration_command": 0.5, "jerk_command": -0.75}
    later = nested(2, double(3, 0.75))
    assert dict(zip(FIELDS, values(whole + later)))["lateral_error"] == 0.75
    assert values(whole[:-3]) is None and values(b"") is None and values(None) is None and values(b"\xff" * 4) is None
    rows = spark.createDataFrame([("d", 1.0, whole, 7.0), ("d", 2.0, b"\x0b", 7.0), ("d", 3.0, None, 7.0), ("d", 4.0, b"", 7.0)], "drive_id string, t double, reserved0 binary, ref_kappa double")
    got = decode(rows).collect()
    assert [(r.t, r.lateral_error, r.ref_kappa) for r in got] == [(1.0, 0.25, 0.01)]
    assert decode(rows.filter(F.lit(False))).count() == 0
