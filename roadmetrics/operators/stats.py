"""Statistics bundles, histograms, ratio metrics and the merging of partial results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bundle(value: Column) -> dict[str, Column]:
    """Nine statistics of a column; an empty input gives zeros."""
    parts = {
        "mean": F.avg(value), "std": F.stddev_pop(value), "min_value": F.min(value), "max_value": F.max(value), "median": F.percentile(value, F.lit(0.5)),
        "abs_mean": F.avg(F.abs(value)), "rms": F.sqrt(F.avg(value * value)), "p95": F.percentile(value, F.lit(0.95)), "p99": F.percentile(value, F.lit(0.99)),
    }
    return {k: F.coalesce(c, F.lit(0.0)).alias(k) for k, c in parts.items()}


def rate(condition: Column) -> Column:
    """Percent of rows for which the condition holds."""
    return F.avg(F.when(condition, 100.0).otherwise(0.0))


def low_percentile(value: Column, p: float = 0.05, least: int = 20) -> Column:
    """The percentile, or the minimum of fewer than least values."""
    return F.when(F.count(value) >= least, F.percentile(value, F.lit(p))).otherwise(F.min(value))


def per_100(count: Column, km: Column) -> Column:
    return F.coalesce(F.try_divide(count * 100.0, km), F.lit(0.0))


def km_per_event(count: Column, km: Column) -> tuple[Column, Column]:
    """Kilometres per event: the number, or null with the text inf if there is no event."""
    value = F.try_divide(km, count)
    return value, F.when(count == 0, F.lit("inf"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts of equal bins between the smallest and the largest value; the last bin holds the largest."""
    ends = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_no = F.coalesce(F.least(F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)), F.lit(bins - 1)), F.lit(0)).cast("int")
    return df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merge_results(results: DataFrame, order: str = "ord") -> DataFrame:
    """Partial results (metric, strategy, value, weight) of several recordings merged by metric: sum, average,
    weighted_avg, max, min, last, custom (a sum). Values are rounded to four places unless one result stands alone."""
    value, weight = F.col("value"), F.coalesce("weight", F.lit(1.0))
    ways = {
        "sum": F.sum(value), "custom": F.sum(value), "average": F.avg(value), "max": F.max(value), "min": F.min(value),
        "last": F.max_by(value, F.col(order)), "weighted_avg": F.coalesce(F.try_divide(F.sum(value * weight), F.sum(weight)), F.lit(0.0)),
    }
    merged = results.groupBy("metric", "strategy").agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("_only"), *[c.alias(f"_{k}") for k, c in ways.items()])
    pick = F.lit(None).cast("double")
    for k in ways:
        pick = F.when(F.col("strategy") == k, F.col(f"_{k}")).otherwise(pick)
    return merged.select("metric", "strategy", "n", F.when(F.col("n") == 1, F.col("_only")).otherwise(F.round(pick, 4)).alias("value"))


def concat_results(results: DataFrame, order: str = "ord") -> DataFrame:
    """Partial lists (metric, items) of several recordings joined to one list per metric, in the recordings' order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("ord"), "items")))
    return results.filter("items IS NOT NULL").groupBy("metric").agg(F.flatten(F.transform(parts, lambda p: p["items"])).alias("items"))
