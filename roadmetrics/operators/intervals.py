"""Points in intervals: the intervals that hold a point, or the one nearest to it.

Intervals of very uneven length are kept in cells of many sizes: an interval lies in the cells, each twice as long as those
of the level below, of the first level whose cells are as long as the interval is. It is in two cells at most, whether it
lasts a second or a year, and a point is looked up in one cell of each level that its series has intervals of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import Right, align


def _cell(t: Column, level: Column, width: float) -> Column:
    return F.floor(t / (F.lit(float(width)) * F.pow(F.lit(2.0), level)))


def in_cells(intervals: DataFrame, width: float, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """intervals with _level and _cell, one row for each of the two cells at most that an interval reaches."""
    units = F.greatest((F.col(end) - F.col(start)) / width, F.lit(1.0))
    levelled = intervals.withColumn("_level", F.ceil(F.log2(units)).cast("int"))
    return levelled.withColumn("_cell", F.explode(F.sequence(*[_cell(F.col(c), F.col("_level"), width) for c in (start, end)])))


def meet(points: DataFrame, intervals: DataFrame, width: float, on: str = "t", by: str = "drive_id", start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """Each point beside each interval (of its series) that holds it, ends included. width: the length of the smallest
    cells; intervals shorter than that share them."""
    cells = in_cells(intervals.filter(F.col(start) <= F.col(end)), width, start, end)
    levels = cells.groupBy(by).agg(F.collect_set("_level").alias("_levels"))  # some sixty at most
    asked = points.join(levels, by).withColumn("_level", F.explode("_levels")).drop("_levels").withColumn("_cell", _cell(F.col(on), F.col("_level"), width))
    return asked.join(cells, [by, "_level", "_cell"]).filter(F.col(on).between(F.col(start), F.col(end))).drop("_level", "_cell")


def locate(points: DataFrame, intervals: DataFrame, width: float, on: str = "t", by: str = "drive_id", key: str = "event_id", chunk: float | None = None) -> DataFrame:
    """points plus ``inside`` and ``nearest``: the names of the first interval (start_ts, end_ts, name) of the series that
    holds the point and of the nearest one by its start or end, the first of equals.

    Points meet only the intervals of their cells (see above); the nearest start and end come from one as-of pass, in
    chunks if ``chunk`` is given.
    """
    inside = meet(points.select(by, key, on), intervals, width, on, by).groupBy(key).agg(F.min(F.struct("start_ts", "name"))["name"].alias("inside"))
    zero = F.lit(0).cast(points.schema[key].dataType).alias(key)
    edge = lambda at: intervals.groupBy(by, F.col(at).alias(on)).agg(F.min(F.struct("start_ts", "name")).alias("of")).select(by, on, zero, "of")
    both = align(points, [Right(edge("start_ts"), "_start"), Right(edge("end_ts"), "_end")], on=on, by=(by,), key=key, chunk=chunk)
    option = lambda side: F.when(F.col(side).isNotNull(), F.struct(F.abs(F.col(f"{side}.{on}") - F.col(on)).alias("away"), F.col(f"{side}.of.start_ts").alias("start_ts"), F.col(f"{side}.of.name").alias("name")))
    return both.withColumn("nearest", F.least(option("_start"), option("_end"))["name"]).drop("_start", "_end").join(inside, key, "left")
