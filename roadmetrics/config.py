"""Thresholds of the metric programs. Values can be overridden from a YAML file with the same names."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

# Thresholds by speed band (km/h), as (from, below, value).
ACC_WARN = [(0, 10, 3.5), (10, 30, 3.0), (30, 60, 2.5), (60, 999, 2.0)]
DEC_WARN = [(0, 10, 4.0), (10, 30, 3.5), (30, 60, 3.0), (60, 999, 2.5)]
DEC_FAIL = [(0, 10, -4.0), (10, 30, -3.5), (30, 60, -3.0), (60, 999, -2.5)]
JERK_PEAK = [(0, 10, 3.0), (10, 30, 2.5), (30, 60, 2.0), (60, 999, 1.5)]
JERK_RMS = [(0, 10, 1.5), (10, 30, 1.2), (30, 60, 1.0), (60, 999, 0.8)]
STEER_RMS_FAIL = [(0, 10, 150), (10, 20, 100), (20, 30, 80), (30, 40, 60), (40, 50, 50), (50, 60, 45), (60, 80, 40), (80, 120, 35)]
STEER_P95_FAIL = [(0, 10, 180), (10, 20, 150), (20, 30, 100), (30, 40, 90), (40, 50, 80), (50, 60, 75), (60, 80, 70), (80, 120, 65)]
STEER_FLIP_FAIL = [(0, 10, 4.0), (10, 20, 3.5), (20, 30, 3.0), (30, 40, 2.5), (40, 50, 2.2), (50, 60, 2.0), (60, 80, 1.8), (80, 120, 1.5)]
LATERAL_RATE = {0: 200, 10: 180, 20: 160, 30: 140, 40: 120, 50: 100, 60: 80, 70: 60}
LATERAL_ACC = {0: 600, 10: 400, 30: 250, 60: 200, 80: 150, 100: 120}
WEAVING_RATE = [(30, 20.0), (60, 15.0)]
WEAVING_RATE_FAST = 10.0


@dataclass(frozen=True)
class Config:
    auto_operator: int = 2
    max_step_s: float = 1.0
    max_speed_kmh: float = 200.0
    takeover_prior_s: float = 1.0
    bend: float = 0.003
    sharp: float = 0.02
    sd_trusted: float = 0.2
    sd_drift: float = 1.0
    lane_event_m: float = 0.3
    steer_window_s: float = 1.0
    steer_step_s: float = 0.1
    steer_min_kmh: float = 1.0
    steer_event_kmh: float = 10.0
    flip_min_rate: float = 5.0
    angle_cutoff_hz: float = 10.0
    rate_cutoff_hz: float = 15.0
    comfort_min_kmh: float = 5.0
    comfort_gap_s: float = 2.0
    run_gap_s: float = 0.5
    brake_min_s: float = 0.1
    jerk_min_s: float = 0.2
    jerk_merge_s: float = 0.4
    lateral_min_s: float = 0.1
    lateral_merge_s: float = 0.3
    weaving_window_s: float = 5.0
    weaving_crossings: int = 4
    weaving_amplitude: float = 40.0
    weaving_min_s: float = 2.0
    weaving_max_s: float = 10.0
    weaving_merge_s: float = 0.5
    near_m: float = 5.0
    danger_m: float = 1.5
    ttc_danger_s: float = 3.0
    session_gap_s: float = 1.0
    speeding_factor: float = 1.15
    speeding_min_kmh: float = 50.0
    speeding_min_s: float = 1.0
    compat: bool = False
    #: Seconds of a drive that one task works on; None leaves drives whole.
    chunk_s: float | None = 1800.0
    extra: dict = field(default_factory=dict)


def load(path: str | None = None, **over) -> Config:
    """The defaults, overridden by a YAML file's top-level names (a missing file changes nothing) and by keywords."""
    known, found = {f.name for f in fields(Config)}, {}
    if path:
        import yaml

        try:
            with open(path, encoding="utf-8") as f:
                found = yaml.safe_load(f) or {}
        except FileNotFoundError:
            found = {}
    found |= over
    return replace(Config(), **{k: v for k, v in found.items() if k in known}, extra={k: v for k, v in found.items() if k not in known})


#: Sensible ranges, for warnings.
RANGES = {
    "max_speed_kmh": (50, 400), "takeover_prior_s": (0, 60), "bend": (0.0001, 0.1), "sharp": (0.001, 1.0), "sd_trusted": (0.01, 5), "sd_drift": (0.1, 50), "steer_window_s": (0.1, 10),
    "angle_cutoff_hz": (0.1, 50), "rate_cutoff_hz": (0.1, 50), "weaving_window_s": (1, 60), "near_m": (0.5, 50), "danger_m": (0.1, 10), "ttc_danger_s": (0.5, 30), "speeding_factor": (1, 2),
}


def warnings(config: Config) -> list[str]:
    """A line for each value outside its sensible range, and for limits that contradict each other."""
    out = [f"{name} = {getattr(config, name)} is outside {lo}..{hi}" for name, (lo, hi) in RANGES.items() if not lo <= getattr(config, name) <= hi]
    if config.bend >= config.sharp:
        out.append("bend is not below sharp")
    if config.sd_trusted >= config.sd_drift:
        out.append("sd_trusted is not below sd_drift")
    return out
