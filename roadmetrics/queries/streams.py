"""Streams and batches over the driver's tables, held against the SQL of the same results over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans import partial
from ..sources.shared import shared_folder
from ..streaming.live import live_takeovers, run_to_end
from .base import EV, events, query
from .programs import PROGRAM_SQL, _rounded, telemetry
from .sequences import _MODE, DAY, HOUR


def _own_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f'WITH {EV}, {_MODE} SELECT drive_id, "at", prior, valid FROM e')
def takeover_edges_live(spark, sf_dir, pieces: int = 3):
    """The takeovers of events that arrive piece by piece, found by a stateful stream; two heartbeats close it."""
    folder = _own_folder(spark, "live")
    rows = events(spark, sf_dir).select("drive_id", "t", F.col("event_id").alias("key"), "is_auto")
    first, last = rows.agg(F.min("t"), F.max("t")).first()
    if first is None:
        return rows.select("drive_id", F.col("t").alias("at"), F.col("t").alias("prior"), F.col("is_auto").alias("valid"))
    piece = F.least(F.floor((F.col("t") - first) / ((last - first) / pieces or 1)), F.lit(pieces - 1))
    none = spark.range(1).select(F.lit(None).cast("bigint").alias("drive_id"), F.lit(0).cast("bigint").alias("key"), F.lit(False).alias("is_auto"))
    beats = [none.withColumn("t", F.lit(last + i * DAY)).select(*rows.columns) for i in (1, 2)]
    for come in [*(rows.filter(piece == i) for i in range(pieces)), *beats]:
        come.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        run_to_end(spark, live_takeovers(stream, DAY, HOUR, 60.0), f"{folder}/out", f"{folder}/mark")
    return spark.read.parquet(f"{folder}/out").select("drive_id", "at", "prior", "valid")


def _in_batches(name: str):
    def build(spark, sf_dir):
        tel, folder = telemetry(spark, sf_dir).shared(whole=False), _own_folder(spark, "batches")
        frames = tel.frames_with(*partial.FIELDS[name])
        for number in (2, 0, 1):
            partial.add_batch(frames.filter(F.pmod(F.floor((F.col("t") - 1_700_000_000.0) / 7.5), F.lit(3)) == number), folder, number, tel.config, (name,))
        return _rounded(partial.read_metrics(spark, folder, name, tel.config))

    build.__name__ = f"metrics_{name}_in_batches"
    build.__doc__ = "The program's metrics from three batches of alternating stretches of every drive, in mixed order."
    return query(PROGRAM_SQL[name])(build)


for _name in partial.STATES:
    _in_batches(_name)


@query(f"WITH {EV} SELECT event_id, drive_id, topic, value, CAST(round(t * 1000000) AS BIGINT) * 1000 AS timestamp FROM ev WHERE topic IN ('click', 'error') AND round(t * 1000000) * 1000 >= 1704672000000000000")
def bags_round_trip(spark, sf_dir):
    """Events written as bag files, a file for each task's drives, and read back by topic and time."""
    from ..sources.bags import register

    folder = _own_folder(spark, "bags")
    ev = events(spark, sf_dir)
    at = (F.round(F.col("t") * 1_000_000).cast("bigint") * 1000).alias("timestamp")
    register(spark)
    ev.select("topic", at, F.struct("event_id", "drive_id", "value").alias("message")).repartition(8, "topic").write.format("bags").mode("append").save(folder)
    back = spark.read.format("bags").option("topics", "click,error").option("from", 1_704_672_000_000_000_000).load(folder)
    return back.select("message.event_id", "message.drive_id", "topic", "message.value", "timestamp")


@query(f"WITH {EV} SELECT event_id, topic, value, drive_id % 5 AS bag, CASE WHEN drive_id % 5 = 2 THEN 2 ELSE 1 END AS data_build FROM ev WHERE drive_id % 5 <> 4")
def incremental_rebuild(spark, sf_dir):
    """A table over five bags, of which one gets more rows and one goes: only the changed bag is read and written again."""
    from ..sources.catalogue import recordings
    from ..sources.incremental import current, refresh

    folder = _own_folder(spark, "incremental")
    ev = events(spark, sf_dir).select("event_id", "topic", "value", (F.col("drive_id") % 5).alias("bag"))
    put = lambda name, rows: rows.drop("bag").coalesce(1).write.mode("overwrite").parquet(f"{folder}/in/{name}")
    listed = lambda *names: recordings(spark, f"{folder}/in", "*.parquet").filter(F.col("bag").isin(*names))

    def read(files):
        paths = [r.path for r in files.select("path").collect()]
        rows = spark.read.parquet(*paths) if paths else ev.drop("bag").limit(0)
        return rows.withColumn("bag", F.regexp_extract(F.input_file_name(), "/([^/]+)/[^/]*$", 1))

    for bag in range(5):
        put(bag, ev.filter((F.col("bag") == bag) & ((F.col("bag") != 2) | (F.col("topic") != "error"))))
    refresh(spark, listed(*"01234"), read, f"{folder}/table")
    put(2, ev.filter("bag = 2"))
    refresh(spark, listed(*"0123"), read, f"{folder}/table")
    return current(spark, f"{folder}/table").select("event_id", "topic", "value", F.col("bag").cast("bigint").alias("bag"), "data_build")
