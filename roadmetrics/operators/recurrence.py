"""Low-pass filtering of long series, block by block.

The filter is a recurrence over two states. A chunk of rows maps the states before it to those after it by an affine map:
a power of one matrix, and what the chunk makes of the zero state. Chunks are run from the zero state in any order, their
maps are composed over a series (one small row for each chunk), and each chunk is then run once more from its own states. The
backward pass does the same from the other end, so a task holds one chunk and no series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filters import PAD, block_pass, butter2, steady_state

_SUMMARY = "n int, first double, last double, z1 double, z2 double"


def _compose(n: np.ndarray, first: float, z: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The states before each chunk (chunks x 2) from the chunks' rows n and the states z that they make of the zero state;
    the first starts in the steady state of the first value."""
    step = np.array([[-a[1], 1.0], [-a[2], 0.0]])
    state, before = steady_state(b, a) * first, np.empty((len(n), 2))
    for i, rows in enumerate(n.tolist()):
        before[i] = state
        state = np.linalg.matrix_power(step, rows) @ state + z[i]
    return before


def _scan(chunks: DataFrame, summary: Column, b: np.ndarray, a: np.ndarray, forward: bool) -> DataFrame:
    """_by, _chunk, _z1, _z2: the states before each chunk in the pass's direction. Python gets plain arrays, a few bytes for
    each chunk and not an object."""

    @F.pandas_udf("_z1 array<double>, _z2 array<double>")
    def states(n: pd.Series, first: pd.Series, z1: pd.Series, z2: pd.Series) -> pd.DataFrame:
        found = [_compose(np.asarray(k), x, np.column_stack([p, q]), b, a) for k, x, p, q in zip(n, first, z1, z2)]
        return pd.DataFrame({"_z1": [z[:, 0] for z in found], "_z2": [z[:, 1] for z in found]})

    place = F.col("_chunk") if forward else -F.col("_chunk")
    per = chunks.groupBy("_by").agg(F.array_sort(F.collect_list(F.struct(place.alias("p"), "_chunk", summary.alias("s")))).alias("all"))
    one = lambda name: F.col(f"all.s.{name}")
    made = per.select("_by", F.col("all._chunk").alias("_chunk"), states(one("n"), F.get(one("first"), 0), one("z1"), one("z2")).alias("_z"))
    zipped = F.arrays_zip("_chunk", F.col("_z._z1").alias("_z1"), F.col("_z._z2").alias("_z2"))
    return made.select("_by", F.explode(zipped).alias("r")).select("_by", "r._chunk", "r._z1", "r._z2")


def lowpass_series(df: DataFrame, by: str, on: str, value: str, out: str, cutoff_hz: float, rate_hz: float, chunk: float, order: tuple[str, ...] = (), least: int = 10) -> DataFrame:
    """df with a column out: the zero-phase low-pass of value, per series in the order of ``on`` (and ``order`` among equal
    times), in chunks of that many seconds. As for ``filters.lowpass``: odd extensions of nine values, and series of fewer
    than ``least`` rows, or cutoffs beyond the Nyquist rate, pass unchanged. A null value counts as a NaN."""
    cutoff, least = cutoff_hz / (rate_hz / 2), max(least, PAD + 1)
    if cutoff >= 1 or cutoff <= 0:
        return df.withColumn(out, F.col(value).cast("double"))
    b, a = butter2(cutoff)

    @F.pandas_udf(_SUMMARY)
    def forward_map(x: pd.Series) -> pd.DataFrame:
        rows = []
        for v in x:
            v = np.asarray(v, float)
            y, z = block_pass(b, a, v, np.zeros(2))
            rows.append((len(v), v[0], y[-1], *z))
        return pd.DataFrame(rows, columns=["n", "first", "last", "z1", "z2"])

    @F.pandas_udf("array<double>")
    def forward(x: pd.Series, z1: pd.Series, z2: pd.Series) -> pd.Series:
        return pd.Series([block_pass(b, a, np.asarray(v, float), np.array([p, q]))[0] for v, p, q in zip(x, z1, z2)])

    @F.pandas_udf("array<double>")
    def backward(y: pd.Series, z1: pd.Series, z2: pd.Series) -> pd.Series:
        return pd.Series([block_pass(b, a, np.asarray(v, float)[::-1], np.array([p, q]))[0][::-1] for v, p, q in zip(y, z1, z2)])

    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    lists = df.groupBy(F.col(by).alias("_by"), F.floor(F.col(on) / chunk).alias("_chunk")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(on).alias("_t"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("_v"), row.alias("_row")))).alias("_rows")
    ).withColumn("_x", F.transform("_rows", lambda r: r["_v"]))
    # The ends of a series stand in its first and last few chunks: ten values of each chunk's ends are enough.
    tail = F.slice("_x", F.greatest(F.size("_x") - PAD, F.lit(1)), F.lit(PAD + 1))
    ends = lists.groupBy("_by").agg(F.array_sort(F.collect_list(F.struct("_chunk", F.size("_x").alias("n"), F.slice("_x", 1, PAD + 1).alias("head"), tail.alias("tail")))).alias("all"))
    heads, tails = F.flatten(F.transform("all", lambda c: c["head"])), F.flatten(F.transform("all", lambda c: c["tail"]))
    total = F.aggregate("all", F.lit(0), lambda n, c: n + c["n"])
    ends = ends.select("_by", F.get("all", 0)["_chunk"].alias("_from"), F.element_at("all", -1)["_chunk"].alias("_to"), total.alias("_n"), F.slice(heads, 1, PAD + 1).alias("_h"), F.slice(F.reverse(tails), 1, PAD + 1).alias("_l"))
    odd = lambda near: F.transform(F.slice(near, 2, PAD), lambda v: 2 * F.get(near, 0) - v)  # noqa: E731  from the end outwards
    none = F.array().cast("array<double>")
    placed = lists.join(ends.withColumnRenamed("_by", "_of"), F.col("_by").eqNullSafe(F.col("_of"))).drop("_of")
    left = F.when(F.col("_chunk") == F.col("_from"), F.reverse(odd(F.col("_h")))).otherwise(none)
    right = F.when(F.col("_chunk") == F.col("_to"), odd(F.col("_l"))).otherwise(none)
    long = placed.filter(F.col("_n") >= least).select("_by", "_chunk", "_rows", F.concat(left, F.col("_x"), right).alias("_x"), F.size(left).alias("_skip"))

    def with_states(chunks: DataFrame, summary: Column, ahead: bool) -> DataFrame:
        states = _scan(chunks, summary, b, a, ahead).withColumnRenamed("_by", "_of").withColumnRenamed("_chunk", "_number")
        return chunks.join(states, F.col("_by").eqNullSafe(F.col("_of")) & (F.col("_chunk") == F.col("_number"))).drop("_of", "_number")

    passed = with_states(long, forward_map("_x"), True).withColumn("_y", forward("_x", "_z1", "_z2")).drop("_z1", "_z2", "_x")
    done = with_states(passed, forward_map(F.reverse("_y")), False).withColumn("_y", backward("_y", "_z1", "_z2"))
    made = done.select("_rows", F.slice("_y", F.col("_skip") + 1, F.size("_rows")).alias("_y"))
    short = placed.filter(F.col("_n") < least).select("_rows", F.col("_x").alias("_y"))
    both = F.explode(F.zip_with("_rows", "_y", lambda r, y: F.struct(r["_row"].alias("row"), y.alias("y"))))
    return made.unionByName(short).select(both.alias("z")).select("z.row.*", F.col("z.y").alias(out))
