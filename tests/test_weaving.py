import numpy as np
import pytest

from roadmetrics.config import Config
from roadmetrics.plans.weaving import crossings, detect, flags, repaired, spans


def flags_by_rows(t, angle, rate, speed, crossed, step, c):
    """The rule of a flagged row, looked at window by window."""
    width, out = max(int(c.weaving_window_s / step), 10), np.zeros(len(t), bool)
    for i in range(width, len(t)):
        s = slice(i - width, i)
        v, a, mean = speed[s], angle[s], speed[s].mean()
        least = 20.0 if mean < 30 else 15.0 if mean < 60 else 10.0
        rules = [
            crossed[s].sum() >= 4, np.diff(t[s]).max() <= 0.5, mean >= 8, (v >= 5).mean() >= 0.8, np.ptp(a) >= 40, np.sqrt((rate[s] ** 2).mean()) >= 0.8 * least,
            0.3 <= (np.diff(a) > 0).mean() <= 0.7, abs(a[-1] - a[0]) <= 15,
        ]
        out[i] = all(rules)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_flags_against_a_loop(seed):
    rng, c = np.random.default_rng(seed), Config()
    t = np.cumsum(np.where(rng.random(1500) < 0.001, 0.7, 0.02))
    angle = (22 + 8 * np.sin(t / 9)) * np.sin(2 * np.pi * t / (1.3 + 0.3 * np.sin(t / 5))) + rng.normal(0, 0.2, len(t))
    rate, speed = np.gradient(angle, 0.02), 30 + 28 * np.sin(t / 7)
    crossed = crossings(rate, speed, 0.02)
    got = flags(t, angle, rate, speed, crossed, 0.02, c)
    assert got.tolist() == flags_by_rows(t, angle, rate, speed, crossed, 0.02, c).tolist()
    assert 0 < got.sum() < len(t)
    assert not flags(t[:250], angle[:250], rate[:250], speed[:250], crossed[:250], 0.02, c).any()


def test_jumps_are_carried_over():
    assert repaired(np.array([0.0, 1.0, 50.0, 51.0, 2.0, 3.0])).tolist() == [0.0, 1.0, 1.0, 51.0, 51.0, 3.0]


def test_spans_bridge_pauses_and_end_at_the_longest_time():
    c, t = Config(), np.arange(0, 30, 0.1)
    flagged = ((t > 1) & (t < 2)) | ((t > 2.3) & (t < 4)) | ((t > 8) & (t < 25))
    found = [(round(t[a], 1), round(t[b], 1)) for a, b in spans(t, flagged, c)]
    assert found[0] == (1.1, 3.9) and found[1][0] == 8.1 and all(b - a <= 10.001 for a, b in found) and found[-1][1] == 24.9
    assert spans(t, np.zeros(len(t), bool), c) == []


def test_detect_finds_the_oscillation(spark):
    t = np.arange(0, 40, 0.02)
    angle = np.where(t < 20, 30 * np.sin(2 * np.pi * t / 1.25), 0.0)
    rows = [("d", "d-0", float(a), float(x), 35.0, 0.5) for a, x in zip(t, angle)]
    schema = "drive_id string, segment string, t double, steering_angle double, speed double, lat_acc double"
    found = detect(spark.createDataFrame(rows, schema), Config()).filter("start_ts IS NOT NULL").orderBy("start_ts").collect()
    # Windows of five seconds rise in 0.3 of their rows as long as 0.6 of them oscillate, until 22 s (the filter's ripple adds little).
    assert [round(e.start_ts) for e in found] == [5, 15] and 22 <= found[-1].end_ts < 23
    assert all(e.rms == pytest.approx(30 * 2 * np.pi / 1.25 / np.sqrt(2), rel=0.05) and e.crossings >= 4 for e in found)
    calm = spark.createDataFrame([(*r[:5], 0.1) for r in rows], schema)
    assert detect(calm, Config()).filter("start_ts IS NOT NULL").count() == 0
