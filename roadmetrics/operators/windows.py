"""Sequence operators over ordered rows: derivatives, sliding statistics, sign changes, repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def gap(w: WindowSpec, on: str = "t") -> Column:
    return F.col(on) - F.lag(on).over(w)


def change(w: WindowSpec, value: str) -> Column:
    """The value's difference from the row before."""
    return F.col(value) - F.lag(value).over(w)


def derivative(w: WindowSpec, value: str, on: str = "t", max_dt: float = 1.0) -> tuple[Column, Column]:
    """Difference quotient to the previous row where 0 < dt <= max_dt (else null), and the step's middle time."""
    dt = gap(w, on)
    ok = (dt > 0) & (dt <= max_dt)
    return F.when(ok, (F.col(value) - F.lag(value).over(w)) / dt), F.when(ok, (F.col(on) + F.lag(on).over(w)) / 2)


def central_difference(w: WindowSpec, value: str, dt: Column) -> Column:
    """Central differences with a constant step; one-sided at the ends."""
    before, after, own = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return F.when(before.isNull(), F.try_divide(after - own, dt)).when(after.isNull(), F.try_divide(own - before, dt)).otherwise(F.try_divide(after - before, 2 * dt))


def median_step(df: DataFrame, by: list[str], on: str = "t", upto: float | None = None) -> DataFrame:
    """Per series the median of the positive steps (up to a bound) and the rate it implies, kept within 1 and 100 Hz."""
    w = Window.partitionBy(*by).orderBy(on)
    steps = df.withColumn("_dt", gap(w, on)).filter("_dt > 0")
    if upto is not None:
        steps = steps.filter(F.col("_dt") < upto)
    dt = F.percentile("_dt", 0.5)
    return steps.groupBy(*by).agg(dt.alias("dt"), F.least(F.greatest(1 / dt, F.lit(1.0)), F.lit(100.0)).alias("rate"))


def sliding_rms(w: WindowSpec, value: str, rows: int) -> Column:
    """RMS of the row and the rows - 1 rows after it; null where fewer follow."""
    frame = w.rowsBetween(0, rows - 1)
    return F.when(F.count(F.lit(1)).over(frame) == rows, F.sqrt(F.avg(F.col(value) * F.col(value)).over(frame)))


def moving_average(w: WindowSpec, value: str, rows: int) -> Column:
    """Centred average with zeros beyond the ends, always divided by rows."""
    return F.sum(value).over(w.rowsBetween(-(rows // 2), rows - 1 - rows // 2)) / rows


def exponential_average(values: Column, alpha: float) -> Column:
    """The last value of the recursive exponential average over an ordered array."""
    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.get(values, 0), lambda a, x: a * (1 - alpha) + x * alpha)


def polynomial_smoothing(w: WindowSpec, value: str, window: int, order: int = 3) -> Column:
    """Savitzky-Golay smoothing: the value of the least-squares polynomial over the rows around each row; the ends take
    the polynomial of the first and last full window. Shorter series keep their values; a null among a window's values
    gives null. Rows are weighed by constants, so nothing leaves the JVM."""
    import numpy as np

    window += 1 - window % 2
    own, half, reach = F.col(value).cast("double"), window // 2, window - 1
    if window <= order:
        return own
    powers = np.vander(np.arange(window) - half, order + 1, increasing=True)
    weights = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in powers @ np.linalg.pinv(powers)])
    around = F.collect_list(F.struct(own.alias("x"))).over(w.rowsBetween(-reach, reach))
    behind, ahead = F.count(F.lit(1)).over(w.rowsBetween(-reach, -1)), F.count(F.lit(1)).over(w.rowsBetween(1, reach))
    # The row's place in its window: the middle, or less or more towards the ends.
    place = F.when(behind < half, behind).when(ahead < half, reach - ahead).otherwise(half).cast("int")
    rows = F.slice(around, (behind - place + 1).cast("int"), F.lit(window))
    smooth = F.aggregate(F.zip_with(rows, F.get(weights, place), lambda r, k: r["x"] * k), F.lit(0.0), lambda a, x: a + x)
    return F.when(behind + ahead < reach, own).otherwise(smooth)
