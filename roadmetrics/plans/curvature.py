"""Curvature of the reference path at the vehicle, and the distance from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes, geo
from ..functions.bands import road_class
from ..operators import stats
from ..sources.reports import features
from ..sources.shared import written
from .base import Result, Telemetry, metric_rows, program


def matched(telemetry: Telemetry, zone: int | None = None) -> DataFrame:
    """Autonomous frames with the nearest path point: kappa, distance, road class, positions."""
    c, loc, path = telemetry.config, F.col("localization"), F.col("trajectory.path")
    f = telemetry.frames_with("localization.lat", "localization.lon", "trajectory.path").filter(F.col("is_auto") & (loc["lat"] != 0) & (loc["lon"] != 0) & (F.size(path) > 0))
    x, y = geo.utm_forward(loc["lat"], loc["lon"], F.lit(zone) if zone else geo.utm_zone(loc["lon"]))
    f = f.select("drive_id", "t", loc["lat"].alias("lat"), loc["lon"].alias("lon"), path.alias("path"), x.alias("x"), y.alias("y"))
    f = f.withColumn("at", boxes.nearest_point(F.col("x"), F.col("y"), F.col("path"))["i"])
    point = F.get("path", F.col("at"))
    f = f.select("drive_id", "t", "lat", "lon", "x", "y", point["kappa"].alias("kappa"), point["x"].alias("path_x"), point["y"].alias("path_y"), boxes.path_distance(F.col("x"), F.col("y"), F.col("path"), F.col("at"), c.bend).alias("distance"))
    return f.withColumn("road", road_class(F.col("kappa"), c.bend, c.sharp))


@program("curvature")
def curvature(telemetry: Telemetry) -> Result:
    share = lambda *names: stats.rate(F.col("road").isin(*names))
    per = matched(telemetry).groupBy("drive_id").agg(
        F.avg(F.abs("kappa")).alias("kappa"), F.stddev_pop(F.abs("kappa")).alias("std"), share("straight").alias("straight"), share("small_curve", "large_curve").alias("curve"), share("small_curve").alias("small"), share("large_curve").alias("large"), F.avg("distance").alias("distance")
    )
    metrics = {"kappa_mean": ("kappa", "1/m"), "kappa_std": ("std", "1/m"), "straight_pct": ("straight", "%"), "curve_pct": ("curve", "%"), "small_curve_pct": ("small", "%"), "large_curve_pct": ("large", "%"), "match_distance": ("distance", "m")}
    return Result(metric_rows(per, {k: (F.col(c), u) for k, (c, u) in metrics.items()}))


def map_features(telemetry: Telemetry, zone: int, least_m: float = 0.1) -> DataFrame:
    """GeoJSON features of the autonomous frames: the vehicle's point, the matched path point, and the line between them if
    they are more than least_m apart. Path points are in the UTM zone given."""
    m = written(matched(telemetry, zone).drop("x", "y"), "matched")
    lat2, lon2 = geo.utm_inverse(F.col("path_x"), F.col("path_y"), F.lit(zone))
    m = m.select("drive_id", "t", "road", "kappa", "distance", "lat", "lon", lat2.alias("lat2"), lon2.alias("lon2"))
    columns = ["kind", "drive_id", "t", "road", "kappa", "distance", "lon", "lat"]
    kind = lambda df, name: df.withColumn("kind", F.lit(name))
    vehicle = kind(m, "vehicle").select(columns)
    path = kind(m, "path").withColumns({"lon": F.col("lon2"), "lat": F.col("lat2")}).select(columns)
    apart = kind(m.filter(F.col("distance") > least_m), "offset").select(*columns, "lon2", "lat2")
    point = lambda df: features(df, "Point").select("kind", "drive_id", "t", "road", "geojson")
    return point(vehicle).unionByName(point(path)).unionByName(features(apart, "LineString", lon2="lon2", lat2="lat2").select("kind", "drive_id", "t", "road", "geojson"))
