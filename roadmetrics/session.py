"""A session with the settings that the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "roadmetrics", **conf: str) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()
