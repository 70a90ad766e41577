"""Sampling and top-k."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def every_nth(df: DataFrame, order: list[str], n: int, bucket: Column) -> DataFrame:
    """Rows 1, n + 1, 2n + 1, ... in the global order.

    bucket is a coarse key that grows with the order (a day, say). Rows are numbered inside their buckets, and the sums
    of the earlier buckets' sizes (one row per bucket) shift the numbers, so no task sees the whole series.
    """
    keyed = df.withColumn("_bucket", bucket)
    local = keyed.withColumn("_row", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifted = local.join(sizes.select("_bucket", before.alias("_before")), "_bucket")
    return shifted.filter((F.col("_row") + F.col("_before") - 1) % n == 0).drop("_bucket", "_row", "_before")


def first_per_group(df: DataFrame, by: list[str], order: list[Column | str], n: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n).drop("_k")


def decimate(df: DataFrame, by: list[str], on: str, interval: float) -> DataFrame:
    """The first row of each interval-long bucket of a series."""
    w = Window.partitionBy(*by, F.floor(F.col(on) / interval)).orderBy(on)
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def _successors(t: np.ndarray, interval: float) -> np.ndarray:
    """For each row of ordered times the first later one at least interval after it, by binary search on the difference
    itself (a sum of time and interval may be rounded to its other side); the last place, len(t), stands for none."""
    low, high = np.arange(1, len(t) + 1), np.full(len(t), len(t))
    while (low < high).any():
        middle = np.minimum((low + high) // 2, len(t) - 1)
        far = (t[middle] - t >= interval) & (low < high)
        high = np.where(far, middle, high)
        low = np.where(far | (low >= high), low, middle + 1)
    return high


def _doublings(n: int) -> range:
    return range(max(1, int(n).bit_length()))


def _chain_ends(t: np.ndarray, interval: float) -> np.ndarray:
    """For each row the last row that is kept if it is kept, by doubling the successor pointers."""
    after = _successors(t, interval)
    jump = np.where(after < len(t), after, np.arange(len(t)))
    for _ in _doublings(len(t)):
        jump = jump[jump]
    return jump


def _entry(t: np.ndarray, last: float | None, interval: float) -> int:
    """The first row that is kept after a row at time ``last``; len(t) for none."""
    return 0 if last is None or np.isnan(last) else int(np.searchsorted(t - last, interval))


def _kept(t: np.ndarray, last: float | None, interval: float) -> np.ndarray:
    """The kept rows, from the last one kept before: the set of rows reached, doubled in each step."""
    n, first = len(t), _entry(t, last, interval)
    reached = np.zeros(n + 1, bool)
    reached[first] = True
    jump = np.append(_successors(t, interval), n)
    for _ in _doublings(n):
        reached[jump[np.flatnonzero(reached)]] = True
        jump = jump[jump]
    return np.flatnonzero(reached[:n])


def decimate_greedy(df: DataFrame, by: str, on: str, interval: float, order: tuple[str, ...] = (), chunk: float | None = None) -> DataFrame:
    """Rows at least interval after the last row kept, per series in the order of ``on`` (and ``order`` among equal times).

    A series is cut into chunks of ``chunk`` seconds (64 intervals unless given). Each row points to the first row at least
    an interval after it. As the last row kept before a chunk lies before its start, a chunk is entered within its first
    interval or at the first row after that: for these rows only the last row kept of the chunk is worked out, by doubling
    the pointers, and passed on. One pass over these short lists of a series gives each chunk's last row kept before
    it, from which its kept rows follow by doubling again.
    """
    chunk = chunk or 64 * interval
    lists = df.groupBy(F.col(by).alias("_by"), F.floor(F.col(on) / chunk).alias("_chunk")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(on).cast("double").alias("_t"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")))).alias("_rows")
    )
    times = F.transform("_rows", lambda r: r["_t"])

    @F.pandas_udf("t array<double>, last array<double>")
    def entries(t: pd.Series, number: pd.Series) -> pd.DataFrame:
        out = []
        for x, k in zip(t, number):
            x = np.asarray(x, float)
            n = min(len(x), int(np.searchsorted(x, k * chunk + 1.001 * interval)) + 1)
            out.append((x[:n], x[_chain_ends(x, interval)[:n]]))
        return pd.DataFrame(out, columns=["t", "last"])

    @F.pandas_udf("array<double>")
    def passed_on(chunks: pd.Series) -> pd.Series:
        """For each chunk of a series, in order, the last row kept before it."""

        def walk(rows):
            last, out = np.nan, []
            for r in rows:
                out.append(last)
                t = np.asarray(r["t"], float)
                i = _entry(t, last, interval)
                last = float(r["last"][i]) if i < len(t) else last
            return out

        return chunks.map(walk)

    @F.pandas_udf("array<int>")
    def kept(t: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([_kept(np.asarray(x, float), y, interval) for x, y in zip(t, last)])

    ends = lists.select("_by", "_chunk", entries(times, F.col("_chunk")).alias("e")).groupBy("_by").agg(F.array_sort(F.collect_list(F.struct("_chunk", "e.t", "e.last"))).alias("all"))
    before = ends.select("_by", F.explode(F.arrays_zip(F.transform("all", lambda x: x["_chunk"]).alias("_chunk"), passed_on("all").alias("_last"))).alias("z")).select("_by", "z.*")
    same = lists["_by"].eqNullSafe(before["_by"]) & (lists["_chunk"] == before["_chunk"])
    chosen = lists.join(before, same).select("_rows", kept(times, F.col("_last")).alias("_kept"))
    return chosen.select(F.explode(F.transform("_kept", lambda i: F.get("_rows", i)["_row"])).alias("r")).select("r.*")


def random_rows(df: DataFrame, n: int, seed: int = 7) -> DataFrame:
    return df.orderBy(F.rand(seed)).limit(n)
