"""Distance and time by driving mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import valid_position
from ..functions.geo import haversine
from ..operators.chunked import Series, over_chunks
from .base import Result, Telemetry, metric_rows, program


def steps(rows: DataFrame, max_dt: float = 1.0, max_kmh: float = 200.0, order: tuple[str, ...] = ("t",), chunk: float | None = None) -> DataFrame:
    """rows (drive_id, t, lat, lon, is_auto) with dt and d (metres) from the row before and whether the step is valid. A
    step belongs to the mode of the row it leads to. With chunk, drives are cut into pieces of that many seconds."""

    def measured(df, w):
        return df.withColumns({"dt": F.col("t") - F.lag("t").over(w), "d": haversine(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))})

    out = over_chunks(rows, Series(("drive_id",), order, chunk), measured, 1)
    return out.withColumn("valid", F.coalesce((F.col("dt") > 0) & (F.col("dt") <= max_dt) & (F.try_divide("d", "dt") * 3.6 <= max_kmh), F.lit(False)))


def positions(frames: DataFrame) -> DataFrame:
    """The frames with a position: drive_id, t, is_auto, lat, lon."""
    f = frames.select("drive_id", "t", "is_auto", F.col("localization.lat").alias("lat"), F.col("localization.lon").alias("lon"))
    return f.filter(valid_position(F.col("lat"), F.col("lon")))


def totals() -> list[Column]:
    """Sums over the valid steps by mode: auto_km, manual_km, auto_s, manual_s."""
    total = lambda what, mode: F.coalesce(F.sum(F.when(F.col("valid") & (F.col("is_auto") == mode), F.col(what))), F.lit(0.0))
    return [(total("d", True) / 1000).alias("auto_km"), (total("d", False) / 1000).alias("manual_km"), total("dt", True).alias("auto_s"), total("dt", False).alias("manual_s")]


def per_drive(telemetry: Telemetry) -> DataFrame:
    """km and seconds by mode, one row per drive."""
    c = telemetry.config
    s = lambda: steps(positions(telemetry.frames_with("localization.lat", "localization.lon")), c.max_step_s, c.max_speed_kmh, chunk=c.chunk_s)
    return telemetry.once("mileage-per-drive", lambda: s().groupBy("drive_id").agg(*totals()))


def report(m: DataFrame) -> DataFrame:
    """The metrics of per_drive's rows."""
    auto_km, manual_km, auto_s = F.col("auto_km"), F.col("manual_km"), F.col("auto_s")
    total = auto_km + manual_km
    return metric_rows(
        m,
        {
            "total_km": (total, "km"), "auto_km": (auto_km, "km"), "manual_km": (manual_km, "km"), "auto_min": (auto_s / 60, "min"), "manual_min": (F.col("manual_s") / 60, "min"),
            "auto_kmh": (F.try_divide(auto_km, auto_s / 3600), "km/h"), "auto_pct": (F.try_divide(auto_km * 100, total), "%"),
        },
    )


@program("mileage")
def mileage(telemetry: Telemetry) -> Result:
    return Result(report(per_drive(telemetry)))
