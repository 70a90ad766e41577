"""Grouped kernels: a numpy function over each series where no expression can do it (recursive filters)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_series(df: DataFrame, by: str, on: str, value: str, out: str, kernel: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """df with a column out = kernel(times, values) of each series, computed in the order of time.

    One series is one task's input: split long recordings by drive or by continuous segment first.
    """
    schema = df.withColumn(out, F.lit(None).cast("double")).schema

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(on)
        t, x = table[on].to_numpy().astype(float), table[value].to_numpy().astype(float)
        y = np.asarray(kernel(t, x), float)
        return table.append_column(out, pa.array(y, pa.float64(), from_pandas=True))

    return df.groupBy(by).applyInArrow(run, schema)


def segments(df: DataFrame, by: str, on: str, gap: float, name: str = "segment") -> DataFrame:
    """df with the number of its continuous segment (a text with the series' id), so that filters do not run over gaps."""
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(on)
    breaks = F.coalesce((F.col(on) - F.lag(on).over(w) > gap).cast("int"), F.lit(0))
    number = F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_b", breaks).withColumn(name, F.concat_ws("-", F.col(by).cast("string"), number.cast("string"))).drop("_b")
