"""Live detection of takeovers: a stateful operator over the stream of driving modes.

Rows of a drive may arrive in any order within the watermark's delay. They wait in the state until the watermark has
passed them (an event-time timer), and are then taken in the order of time into the drive's open run: where it began, its
last row and mode. What leaves the operator is final. Drives are dealt by hash over a number of buckets, and a bucket is one
key of the state: its drives' open runs as one array and the rows of the last ``late_s`` seconds as an array for each
batch, so that a batch costs calls for each bucket, not for each drive, and rows are taken by whole arrays. The state is in
a RocksDB store that is checkpointed with the stream. A bucket's open runs and waiting rows must fit a task's memory: more
drives want more buckets, which are set when a stream is started first.

Edge cases: rows that come later than the watermark allows are dropped by Spark before they reach the operator; rows
without a drive are heartbeats, which move the watermark on and nothing else; rows without a time are left out; a row
without a mode ends a run and is no takeover; equal times are taken in the order of key; rows that repeat count as steps of
no length; a run that is still open when the stream ends gives nothing, as it has not been taken over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EDGES = "drive_id bigint, at double, prior double, valid boolean, frames bigint"
#: Modes: 1 autonomous, 0 manual, -1 unknown, and -2 for a heartbeat.
ROWS = np.dtype([("drive", "<i8"), ("t", "<f8"), ("key", "<i8"), ("mode", "i1")])
RUNS = np.dtype([("drive", "<i8"), ("began", "<f8"), ("last", "<f8"), ("mode", "i1"), ("frames", "<i8")])


def settle(runs: np.ndarray, rows: np.ndarray, max_gap: float, min_prior: float) -> tuple[np.ndarray, pd.DataFrame]:
    """The open runs (one of a drive) after these rows, in any order, and the edges that the rows make."""
    both = lambda of_run, of_row: np.concatenate([runs[of_run], rows[of_row]])
    own = np.repeat([0, 1], [len(runs), len(rows)])  # a drive's open run comes before its rows
    order = np.lexsort((both("mode", "mode"), np.concatenate([np.zeros(len(runs), np.int64), rows["key"]]), both("last", "t"), own, both("drive", "drive")))
    drive, began, t, mode = (both(*names)[order] for names in (("drive", "drive"), ("began", "t"), ("last", "t"), ("mode", "mode")))
    new = np.ones(len(order), bool)
    new[1:] = drive[1:] != drive[:-1]
    starts = new.copy()
    starts[1:] |= (mode[1:] != mode[:-1]) | (mode[1:] < 0) | (np.diff(t) > max_gap)
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(order))[: len(first)] - 1
    frames = np.add.reduceat(np.concatenate([runs["frames"], np.ones(len(rows), np.int64)])[order], first) if len(first) else np.zeros(0, np.int64)
    at, end = first[1:], last[:-1]
    taken = np.flatnonzero(~new[at] & (mode[end] == 1) & (mode[at] == 0) & (t[at] - t[end] <= max_gap))
    prior = t[end[taken]] - began[first[taken]]
    edges = pd.DataFrame({"drive_id": drive[at[taken]], "at": t[at[taken]], "prior": prior, "valid": prior >= min_prior, "frames": frames[taken]})
    still = np.flatnonzero(np.append(new[at], True)[: len(first)])
    out = np.empty(len(still), RUNS)
    for name, column in (("drive", drive[first]), ("began", began[first]), ("last", t[last]), ("mode", mode[first]), ("frames", frames)):
        out[name] = column[still]
    return out, edges


class TakeoverProcessor(StatefulProcessor):
    def __init__(self, max_gap: float, min_prior: float):
        self.max_gap, self.min_prior = max_gap, min_prior

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "packed binary")
        self.waiting = handle.getListState("waiting", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        come = []
        for batch in rows:
            batch = batch[batch["mode"] > -2]  # not filtered before: a filter would move ahead of the watermark
            come.append(np.empty(len(batch), ROWS))
            for name in ROWS.names:
                come[-1][name] = batch[name].to_numpy()
        come = np.concatenate(come)
        if len(come):
            self.waiting.appendValue((come.tobytes(),))
            self.handle.registerTimer(int(come["t"].max() * 1000) + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Rows up to the watermark are complete: take them in order; the others wait for a later timer."""
        settled = timerValues.getCurrentWatermarkInMs() / 1000
        packed = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
        if not packed:
            return
        rows = np.concatenate([np.frombuffer(p, ROWS) for p in packed])
        later = rows["t"] > settled
        self.waiting.clear()
        if later.any():
            self.waiting.put([(rows[later].tobytes(),)])
        runs = np.frombuffer(self.runs.get()[0], RUNS) if self.runs.exists() else np.zeros(0, RUNS)
        runs, found = settle(runs, rows[~later], self.max_gap, self.min_prior)
        if len(runs):
            self.runs.update((runs.tobytes(),))
        if len(found):
            yield found

    def close(self) -> None:
        pass


def live_takeovers(modes: DataFrame, max_gap: float = 1.0, min_prior: float = 1.0, late_s: float = 60.0, buckets: int = 256) -> DataFrame:
    """Edges from autonomous to manual of a stream (drive_id, t, key, is_auto), as ``plans.takeover.edges`` finds them in a
    table, each at the latest when the watermark has passed all rows that came to its bucket with it."""
    at = F.timestamp_micros(F.round(F.col("t") * 1_000_000).cast("bigint"))
    rows = modes.filter("t IS NOT NULL").withColumn("ts", at).withWatermark("ts", f"{round(late_s * 1000)} milliseconds")
    mode = F.when(F.col("drive_id").isNull(), -2).otherwise(F.coalesce(F.col("is_auto").cast("int"), F.lit(-1)))
    rows = rows.select(
        "ts", "t", F.coalesce("drive_id", F.lit(0)).alias("drive"), F.coalesce("key", F.lit(-(1 << 63))).alias("key"), mode.cast("tinyint").alias("mode"),
        F.pmod(F.xxhash64("drive_id"), F.lit(buckets)).alias("bucket"),
    )
    return rows.groupBy("bucket").transformWithStateInPandas(TakeoverProcessor(max_gap, min_prior), outputStructType=EDGES, outputMode="append", timeMode="eventTime")


def run_to_end(spark: SparkSession, found: DataFrame, to: str, mark: str) -> StreamingQuery:
    """Write a stream's rows to Parquet until nothing is new. A stream that is started again goes on from its mark."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        run = found.writeStream.format("parquet").option("path", to).option("checkpointLocation", mark).outputMode("append").trigger(availableNow=True).start()
        run.awaitTermination()
        return run
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
