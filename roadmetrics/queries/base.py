"""Registry of queries, and the roles that the driver's tables play.

``events`` stand for recordings: a user is a drive, an event type a topic, value the signal, values above 20 autonomous
mode. ``lineitem`` rows of an order are the obstacles of a frame. ``embeddings`` are arrays of points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

SQL_BY_TIME = "(PARTITION BY drive_id ORDER BY t, event_id)"
#: Events with their roles, as a common table expression.
EV = """ev AS (SELECT event_id, user_id AS drive_id, event_type AS topic, value, CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS t, value > 20 AS is_auto,
    31 + (event_id % 1000) * 1e-4 AS lat, 121 + (event_id % 777) * 1e-4 AS lon FROM events)"""
#: Obstacles with their roles.
OB = """ob AS (SELECT l_orderkey AS frame_id, l_quantity - 25 AS x, l_discount * 100 - 5 AS y, 0.5 + l_tax * 50 AS length, 0.5 + l_linenumber * 0.3 AS width,
    l_extendedprice / 10000 AS heading, l_quantity / 10 AS vx, l_returnflag AS motion, l_linestatus AS kind, l_partkey AS track_id FROM lineitem)"""


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLE_SQL[build.__name__] = sql
        return build

    return register


def query_in_chunks(sql: str, *seconds: float):
    """Registers build(spark, sf_dir, chunk) without chunks, and once more in chunks of each of the given lengths, which cut
    through the runs and windows of the data; all give the same rows."""

    def register(build):
        def registered(name, chunk):
            def at(spark, sf_dir):
                return build(spark, sf_dir, chunk)

            at.__name__ = name
            query(sql)(at)

        registered(build.__name__, None)
        for i, x in enumerate(seconds):
            registered(f"{build.__name__}_chunked" + (f"_{i + 1}" if i else ""), x)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_time() -> WindowSpec:
    """A drive's rows in the order of time."""
    return Window.partitionBy("drive_id").orderBy("t", "event_id")


def seconds(ts) -> F.Column:
    return F.unix_micros(ts.cast("timestamp")).cast("double") / 1e6


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("drive_id"), F.col("event_type").alias("topic"), "value", seconds(F.col("ts")).alias("t"), (F.col("value") > 20).alias("is_auto"),
        (31 + (F.col("event_id") % 1000) * F.lit(1e-4)).alias("lat"), (121 + (F.col("event_id") % 777) * F.lit(1e-4)).alias("lon"),
    )


def obstacles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_id"), (F.col("l_quantity") - 25).alias("x"), (F.col("l_discount") * 100 - 5).alias("y"), (0.5 + F.col("l_tax") * 50).alias("length"),
        (0.5 + F.col("l_linenumber") * F.lit(0.3)).alias("width"), (F.col("l_extendedprice") / 10000).alias("heading"), (F.col("l_quantity") / 10).alias("vx"),
        F.col("l_returnflag").alias("motion"), F.col("l_linestatus").alias("kind"), F.col("l_partkey").alias("track_id"),
    )
