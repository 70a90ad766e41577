"""Weaving: sustained oscillation of the steering wheel.

Detection looks back over a window whose width in rows depends on the segment's rate, and an event is a state machine
over flagged rows, so both run as one numpy kernel per continuous segment; everything around it is plain DataFrame work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as limits
from ..config import Config
from ..functions.bands import valid_position
from ..functions.filters import lowpass
from ..operators.kernels import segments
from ..operators.stats import km_per_event, per_100
from ..sources.reports import features
from . import mileage
from .base import Result, Telemetry, event_rows, metric_rows, program


def _limit(speed: float) -> float:
    return next((v for top, v in limits.WEAVING_RATE if speed < top), limits.WEAVING_RATE_FAST)


def repaired(angle: np.ndarray, most: float = 10.0) -> np.ndarray:
    """The angle with jumps of more than most per row carried over from before."""
    jump = np.concatenate([[False], np.abs(np.diff(angle)) > most])
    return angle[np.maximum.accumulate(np.where(jump, 0, np.arange(len(angle))))]


def signals(t: np.ndarray, angle: np.ndarray, c: Config) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Filtered angle, filtered rate within 300 deg/s, the step, and the number of rates beyond that."""
    step = float(np.median(np.diff(t)))
    rate_hz = min(100.0, max(1.0, 1 / step if step > 0 else 50.0))
    angle = lowpass(repaired(angle), min(c.angle_cutoff_hz, rate_hz / 2 - 0.1), rate_hz)
    dt = np.diff(t)
    raw = np.where((dt > 0) & (dt <= 1.0), np.diff(angle) / np.where(dt > 0, dt, 1), 0.0)
    rate = np.interp(t, (t[1:] + t[:-1]) / 2, lowpass(raw, min(c.rate_cutoff_hz, rate_hz / 2 - 0.1), rate_hz))
    return angle, np.clip(rate, -300, 300), step or 0.02, int((np.abs(rate) > 300).sum())


def crossings(rate: np.ndarray, speed: np.ndarray, step: float) -> np.ndarray:
    """Rows where the rate changes sign between peaks on both sides that are high enough for the speed."""
    sign = np.sign(rate)
    last = np.maximum.accumulate(np.where(sign != 0, np.arange(len(sign)), 0))
    sign = sign[last]
    half = max(int(0.5 / step), 5)
    flips = np.flatnonzero(sign[1:] != sign[:-1]) + 1
    found = np.zeros(len(rate), bool)
    for i in flips:
        before, after = rate[max(0, i - half) : i], rate[i : i + half]
        least = max(5.0, _limit(float(speed[max(0, i - half) : i + half].mean())))
        found[i] = len(before) and len(after) and np.abs(before).max() >= least and np.abs(after).max() >= least
    return found


def flags(t: np.ndarray, angle: np.ndarray, rate: np.ndarray, speed: np.ndarray, crossed: np.ndarray, step: float, c: Config) -> np.ndarray:
    """Rows whose trailing window (without the row itself) oscillates. Sums over windows are differences of running sums."""
    width, n = max(int(c.weaving_window_s / step), 10), len(t)
    out = np.zeros(n, bool)
    if n <= width:
        return out
    hi = np.arange(width, n)
    lo = hi - width

    def total(x: np.ndarray, skip: int = 0) -> np.ndarray:
        """Sums over each window; of values between rows (skip 1) those within it."""
        upto = np.concatenate([[0], np.cumsum(x)])
        return upto[hi - skip] - upto[lo]

    mean = total(speed) / width
    least = 0.8 * np.select([mean < top for top, _ in limits.WEAVING_RATE], [v for _, v in limits.WEAVING_RATE], limits.WEAVING_RATE_FAST)
    rising = total(np.diff(angle) > 0, 1) / (width - 1)
    wide = np.lib.stride_tricks.sliding_window_view(angle[:-1], width)
    out[width:] = (
        (total(crossed) >= c.weaving_crossings) & (total(np.diff(t) > c.run_gap_s, 1) == 0) & (mean >= 8.0) & (total(speed >= 5.0) >= 0.8 * width)
        & (wide.max(axis=1) - wide.min(axis=1) >= c.weaving_amplitude) & (np.sqrt(np.maximum(total(rate**2), 0) / width) >= least)
        & (rising >= 0.3) & (rising <= 0.7) & (np.abs(angle[hi - 1] - angle[lo]) <= 15.0)
    )
    return out


def spans(t: np.ndarray, flagged: np.ndarray, c: Config) -> list[tuple[int, int]]:
    """Runs of flagged rows that pauses of up to weaving_merge_s do not end, cut at weaving_max_s.

    In compat mode a pause never ends a run (only the end of the segment does).
    """
    at = np.flatnonzero(flagged)
    if not len(at):
        return []
    found, start, last = [], at[0], at[0]
    for i in at[1:]:
        if (not c.compat and t[i] - t[last] > c.weaving_merge_s) or t[i] - t[start] > c.weaving_max_s:
            found.append((start, last))
            start = i
        last = i
    return [*found, (start, last)]


def measured(a: int, b: int, t, rate, speed, lat_acc, crossed, step: float, c: Config) -> dict | None:
    """The event of rows a..b, or None if it is too short, slow, sparse or gentle."""
    duration = t[b] - t[a]
    if b <= a or duration < c.weaving_min_s:
        return None
    own = rate[a : b + 1]
    width = max(int(c.weaving_window_s / step), 2)
    power = np.convolve(own**2, np.ones(width) / width, "valid") if len(own) >= width else np.array([(own**2).mean()])
    rms, n = float(np.sqrt(power.max())), int(crossed[a : b + 1].sum())
    dense = n / duration >= 0.8 * c.weaving_crossings / c.weaving_window_s
    if rms < 0.8 * _limit(float(speed[a : b + 1].mean())) or n < 4 or not dense or np.abs(lat_acc[a : b + 1]).max() < 0.3:
        return None
    return {"start_ts": t[a], "end_ts": t[b], "frame_count": b - a + 1, "peak": float(np.abs(own).max()), "rms": rms, "crossings": n}


def _detect(c: Config):
    schema = pa.schema([("drive_id", pa.string()), ("start_ts", pa.float64()), ("end_ts", pa.float64()), ("frame_count", pa.int64()), ("peak", pa.float64()), ("rms", pa.float64()), ("crossings", pa.int64()), ("outliers", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("t")
        t, angle, speed, lat_acc = (np.nan_to_num(table[n].to_numpy().astype(float)) for n in ("t", "steering_angle", "speed", "lat_acc"))
        rows, drive = [], table["drive_id"][0].as_py()
        if len(t) >= 20:
            angle, rate, step, outliers = signals(t, angle, c)
            crossed = crossings(rate, speed, step)
            for a, b in spans(t, flags(t, angle, rate, speed, crossed, step, c), c):
                if event := measured(a, b, t, rate, speed, lat_acc, crossed, step, c):
                    rows.append(event | {"drive_id": drive, "outliers": 0})
            rows.append({"drive_id": drive, "outliers": outliers})
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def detect(rows: DataFrame, c: Config) -> DataFrame:
    """Events of rows (drive_id, segment, t, steering_angle, speed, lat_acc); one more row per segment counts outliers."""
    schema = "drive_id string, start_ts double, end_ts double, frame_count bigint, peak double, rms double, crossings bigint, outliers bigint"
    return rows.groupBy("segment").applyInArrow(_detect(c), schema)


def event_features(events: DataFrame, telemetry: Telemetry) -> DataFrame:
    """GeoJSON features of events (drive_id, start_ts, end_ts) with at least two positions: the line that the vehicle drove
    and its points, each with its steering rate and the share of the event's largest.

    Events last weaving_max_s at most, so one of them is a handful of rows; positions meet them by time bucket.
    """
    span = telemetry.config.weaving_max_s
    bucket = lambda t: F.floor(t / span)
    f = telemetry.frames_with("localization.lat", "localization.lon", "chassis.steering_rate").filter(valid_position(F.col("localization.lat"), F.col("localization.lon")))
    places = f.select("drive_id", "t", bucket(F.col("t")).alias("bucket"), F.col("localization.lat").alias("lat"), F.col("localization.lon").alias("lon"), F.coalesce("chassis.steering_rate", F.lit(0.0)).alias("rate"))
    spread = events.select("drive_id", "start_ts", "end_ts", F.explode(F.sequence(bucket(F.col("start_ts")), bucket(F.col("end_ts")))).alias("bucket"))
    w = Window.partitionBy("drive_id", "start_ts", "end_ts")
    placed = places.join(spread, ["drive_id", "bucket"]).filter((F.col("t") >= F.col("start_ts")) & (F.col("t") <= F.col("end_ts")))
    placed = placed.withColumns({"index": F.row_number().over(w.orderBy("t", "lat", "lon", "rate")) - 1, "n": F.count(F.lit(1)).over(w), "most": F.max(F.abs("rate")).over(w)}).filter("n >= 2")
    share = F.round(F.coalesce(F.try_divide(F.abs("rate"), F.col("most")), F.lit(0.0)), 3)
    columns = ["kind", "drive_id", "start_ts", "index", "geojson"]
    points = placed.select(F.lit("point").alias("kind"), "drive_id", "start_ts", "index", F.round("rate", 1).alias("steering_rate"), share.alias("share"), "t", "lon", "lat")
    line = F.transform(F.array_sort(F.collect_list(F.struct("index", "lon", "lat"))), lambda p: F.array(p["lon"], p["lat"]))
    shape = F.struct(F.lit("LineString").alias("type"), line.alias("coordinates"))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(F.first("drive_id").alias("drive_id"), F.first("start_ts").alias("start_ts"), F.first("end_ts").alias("end_ts")).alias("properties")))
    lines = placed.groupBy("drive_id", "start_ts", "end_ts").agg(feature.alias("geojson")).select(F.lit("line").alias("kind"), "drive_id", "start_ts", F.lit(None).cast("int").alias("index"), "geojson")
    return features(points, "Point").select(columns).unionByName(lines)


@program("weaving", needs=("mileage",))
def weaving(telemetry: Telemetry) -> Result:
    c = telemetry.config
    rows = telemetry.chassis_hf().filter("is_auto AND steering_angle IS NOT NULL").select("drive_id", "t", "steering_angle", "speed", "lat_acc")
    found = telemetry.once("weaving", lambda: detect(segments(rows, "drive_id", "t", c.run_gap_s), c))
    events = found.filter("start_ts IS NOT NULL")
    per = found.groupBy("drive_id").agg(F.count("start_ts").alias("n"), F.sum("outliers").alias("outliers"))
    joined = mileage.per_drive(telemetry).join(per, "drive_id", "left").fillna(0, ["n", "outliers"])
    value, text = km_per_event(F.col("n"), F.col("auto_km"))
    metrics = {"weaving_events": (F.col("n"), ""), "weaving_outliers": (F.col("outliers"), ""), "weaving_per_100km": (per_100(F.col("n"), F.col("auto_km")), "1/100 km"), "km_per_weaving": (value, "km")}
    return Result(metric_rows(joined, metrics, {"km_per_weaving": text}), event_rows(events, "weaving"))
