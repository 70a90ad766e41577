"""Gaps and islands: runs of flagged rows, runs of equal class, and merging of neighbouring events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunked import CHUNK, Series, own_rows, running_sum, uncut, with_edges


def number_islands(df: DataFrame, by: Sequence[str], order: Sequence[str], breaks: Column, name: str = "island", chunk: float | None = None) -> DataFrame:
    """df with a running number that grows at each row where breaks (a condition on the row alone) holds. With ``chunk``,
    rows are numbered within pieces of that many seconds and the pieces' sums of breaks shift the numbers, so aggregates by
    island merge what the pieces hold of it."""
    s = Series(tuple(by), tuple(order), chunk)
    return uncut(running_sum(s.cut(df) if CHUNK not in df.columns else df, s, F.when(breaks, 1).otherwise(0), name))


def _with_breaks(df: DataFrame, s: Series, breaks) -> DataFrame:
    """df (still cut, if s is) with the column _break; breaks is a function of the window whose lags it needs."""
    if not s.seconds:
        return df.withColumn("_break", breaks(s.window()))
    return own_rows(with_edges(df, s).withColumn("_break", breaks(s.window())))


def runs(df: DataFrame, by: Sequence[str], order: Sequence[str], flag: Column, on: str = "t", max_gap: float | None = None, extra_break=None, chunk: float | None = None) -> DataFrame:
    """The flagged rows with the number of their island. An island ends where the flag changes, where a step is longer
    than max_gap, or where extra_break (a function of the window, for lags by one row) holds. chunk: see number_islands; a
    run may span any number of pieces."""
    s = Series(tuple(by), tuple(order), chunk)

    def breaks(w):
        found = ~F.lag("_flag").over(w).eqNullSafe(F.col("_flag"))
        if max_gap is not None:
            found |= F.coalesce(F.col(on) - F.lag(on).over(w) > max_gap, F.lit(False))
        if extra_break is not None:
            found |= F.coalesce(extra_break(w), F.lit(False))
        return found

    staged = _with_breaks(df.withColumn("_flag", F.coalesce(flag, F.lit(False))), s, breaks)
    return number_islands(staged, by, order, F.col("_break"), chunk=chunk).filter("_flag").drop("_flag", "_break")


def sparse_runs(df: DataFrame, by: Sequence[str], order: Sequence[str], flag: Column, on: str = "t", max_rows: int | None = None, max_gap: float | None = None, same: Sequence[str] = (), chunk: float | None = None) -> DataFrame:
    """The flagged rows with island numbers, where islands may hold unflagged rows: an island ends where flagged rows are
    more than max_rows rows or max_gap apart, or differ in one of the columns ``same``. chunk: see number_islands; rows are
    counted over all pieces."""
    s = Series(tuple(by), tuple(order), chunk)

    def breaks(w):
        found = F.lag(on).over(w).isNull()
        if max_rows is not None:
            found |= F.col("_row") - F.lag("_row").over(w) > max_rows
        if max_gap is not None:
            found |= F.col(on) - F.lag(on).over(w) > max_gap
        for c in same:
            found |= ~F.lag(c).over(w).eqNullSafe(F.col(c))
        return found

    numbered = uncut(running_sum(s.cut(df), s, F.lit(1), "_row")) if max_rows is not None else df
    hits = _with_breaks(numbered.filter(flag), s, breaks)
    return number_islands(hits, by, order, F.col("_break"), chunk=chunk).drop("_break", "_row")


def summarise(rows: DataFrame, by: Sequence[str], value: Column, on: str = "t", peak: str = "abs_max", *more: Column) -> DataFrame:
    """One event per island: start_ts, end_ts, duration, frame_count, mean_value, peak."""
    peaks = {"max": F.max(value), "min": F.min(value), "abs_max": F.max_by(value, F.abs(value))}
    return rows.groupBy(*by, "island").agg(
        F.min(on).alias("start_ts"), F.max(on).alias("end_ts"), (F.max(on) - F.min(on)).alias("duration"), F.count(F.lit(1)).alias("frame_count"),
        F.avg(value).alias("mean_value"), peaks[peak].alias("peak"), *more,
    )


def merge_events(events: DataFrame, by: Sequence[str], gap: float, strict: bool = False, chunk: float | None = None) -> DataFrame:
    """Number of the merged event for each event: neighbours by start merge if they are at most (strictly less than, if
    strict) gap apart. The gap is measured from the previous event's end. chunk: see number_islands."""
    order = ["start_ts", "end_ts"]

    def breaks(w):
        apart = F.col("start_ts") - F.lag("end_ts").over(w)
        return apart.isNull() | (apart >= gap if strict else apart > gap)

    staged = _with_breaks(events, Series(tuple(by), tuple(order), chunk), breaks)
    return number_islands(staged, by, order, F.col("_break"), "merged", chunk).drop("_break")
