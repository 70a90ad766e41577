"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(rows: DataFrame, path: str, kind: str = "parquet", by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Metrics or events as csv (with a header), json lines or parquet, in folders by the given columns."""
    if kind not in ("csv", "json", "parquet"):
        raise ValueError(f"no such report: {kind}")
    writer = rows.write.mode(mode).partitionBy(*by) if by else rows.write.mode(mode)
    (writer.option("header", True) if kind == "csv" else writer).format(kind).save(path)


def features(rows: DataFrame, geometry: str, lon: str = "lon", lat: str = "lat", lon2: str | None = None, lat2: str | None = None) -> DataFrame:
    """rows with a column geojson: a Feature whose geometry is the point (lon, lat), or the line from it to (lon2, lat2),
    and whose properties are the other columns."""
    places = [x for x in (lon, lat, lon2, lat2) if x]
    properties = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in places])
    here = F.array(F.col(lon), F.col(lat))
    coordinates = here if geometry == "Point" else F.array(here, F.array(F.col(lon2), F.col(lat2)))
    shape = F.struct(F.lit(geometry).alias("type"), coordinates.alias("coordinates"))
    return rows.withColumn("geojson", F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), properties.alias("properties"))))
