"""Series that are cut into time chunks, so that one long series is shared by many tasks.

A chunk is the partition of every window: rows of a series within the same ``seconds``. What a row needs from outside its chunk
comes by one of two ways, both through tables of one row per chunk that are worked out beside the rows:

* neighbours: each chunk gets the last rows of the chunks before it and the first rows of those after it, as edge rows
  that windows see and that are dropped afterwards (``with_edges``, ``over_chunks``);
* running values: each chunk's own sum or last value is combined over the chunks before it and joined to the chunk's rows
  (``running_sum``, ``carried_value``). Both combine associatively, so partial results of chunks can be merged in any grouping.

Windows over a whole series see chunks only, never rows. Without ``seconds`` a series is one partition, which is cheaper
where series are known to be short.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK, EDGE = "_chunk", "_edge"


@dataclass(frozen=True)
class Series:
    """The key columns of a series, the columns of its order (the time first), and the seconds of a chunk, if it is cut."""

    by: tuple[str, ...] = ("drive_id",)
    order: tuple[str, ...] = ("t",)
    seconds: float | None = None

    @property
    def keys(self) -> list[str]:
        return [*self.by, CHUNK] if self.seconds else [*self.by]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def backwards(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*[F.desc(c) for c in self.order])

    def chunks(self) -> WindowSpec:
        """The chunks of a series in their order."""
        return Window.partitionBy(*self.by).orderBy(CHUNK)

    def cut(self, df: DataFrame) -> DataFrame:
        return df.withColumn(CHUNK, F.floor(F.col(self.order[0]) / self.seconds)) if self.seconds else df


def _rows_at_ends(rows: DataFrame, s: Series, columns: list[str], behind: int, ahead: int) -> DataFrame:
    """Per chunk ``_tail``, its last rows, and ``_head``, its first ones, both in the order of the series."""
    row, place = F.struct(*[F.col(f"`{c}`") for c in columns]), F.struct(*s.order)
    if behind <= 1 and ahead <= 1:
        return rows.groupBy(*s.keys).agg(F.array(F.max_by(row, place)).alias("_tail"), F.array(F.min_by(row, place)).alias("_head"))
    first, last = F.row_number().over(s.window()), F.row_number().over(s.backwards())
    ranked = rows.select(*s.keys, row.alias("_r"), first.alias("_first"), last.alias("_last")).filter((F.col("_first") <= ahead) | (F.col("_last") <= behind))

    def gathered(rank: str, most: int, sign: int) -> Column:
        found = F.collect_list(F.when(F.col(rank) <= most, F.struct((F.col(rank) * sign).alias("k"), "_r")))
        return F.transform(F.array_sort(found, lambda a, b: a["k"] - b["k"]), lambda x: x["_r"])

    return ranked.groupBy(*s.keys).agg(gathered("_last", behind, -1).alias("_tail"), gathered("_first", ahead, 1).alias("_head"))


def with_edges(df: DataFrame, s: Series, behind: int = 1, ahead: int = 0) -> DataFrame:
    """df with the columns _chunk and _edge, and for each chunk up to ``behind`` edge rows from the chunks before it and
    ``ahead`` from those after it, however many chunks away they are."""
    columns, rows = df.columns, s.cut(df)
    ends = _rows_at_ends(rows, s, columns, behind, ahead)
    own = rows.withColumn(EDGE, F.lit(False))
    near = []
    if behind:
        ends = ends.withColumn("_p", F.flatten(F.collect_list("_tail").over(s.chunks().rowsBetween(-behind, -1))))
        near.append(F.slice("_p", F.greatest(F.size("_p") - behind + 1, F.lit(1)), F.lit(behind)))
    if ahead:
        ends = ends.withColumn("_n", F.flatten(F.collect_list("_head").over(s.chunks().rowsBetween(1, ahead))))
        near.append(F.slice("_n", 1, ahead))
    found = ends.select(*s.keys, F.explode(F.concat(*near)).alias("_r"))
    edges = found.select(*[F.col(f"_r.`{c}`").alias(c) for c in columns], CHUNK, F.lit(True).alias(EDGE))
    return own.unionByName(edges)


def own_rows(rows: DataFrame) -> DataFrame:
    """rows without the edge rows; they keep their chunk."""
    return rows.filter(~F.col(EDGE)).drop(EDGE) if EDGE in rows.columns else rows


def over_chunks(df: DataFrame, s: Series, build: Callable[[DataFrame, WindowSpec], DataFrame], behind: int = 0, ahead: int = 0) -> DataFrame:
    """build(rows, window), for windows that look at most ``behind`` rows back and ``ahead`` rows on. build keeps the
    columns that it finds."""
    if not s.seconds:
        return build(df, s.window())
    return own_rows(build(with_edges(df, s, behind, ahead), s.window())).drop(CHUNK)


def _from_chunks_before(rows: DataFrame, s: Series, summary: Column, combine: Callable[[str], Column], name: str) -> DataFrame:
    """rows (of chunks, without edges) with what the summaries of the chunks before theirs combine to."""
    upto = s.chunks().rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*s.keys).agg(summary.alias("_s")).select(*s.keys, combine("_s").over(upto).alias(name))
    same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in s.keys]
    condition = same[0]
    for x in same[1:]:
        condition &= x
    return rows.alias("a").join(carried.alias("b"), condition, "left").select("a.*", F.col(f"b.{name}").alias(name))


def running_sum(rows: DataFrame, s: Series, value: Column, name: str) -> DataFrame:
    """rows (cut, if s is) with the sum of a whole-number value over the series up to each row."""
    upto = s.window().rowsBetween(Window.unboundedPreceding, 0)
    staged = rows.withColumn("_x", value)
    if not s.seconds:
        return staged.withColumn(name, F.sum("_x").over(upto)).drop("_x")
    out = _from_chunks_before(staged, s, F.sum("_x"), F.sum, "_before")
    return out.withColumn(name, F.coalesce("_before", F.lit(0)) + F.sum("_x").over(upto)).drop("_x", "_before")


def carried_value(rows: DataFrame, s: Series, value: Column, name: str) -> DataFrame:
    """rows (cut, if s is) with the last value of the series that isn't null, up to and with each row."""
    upto = s.window().rowsBetween(Window.unboundedPreceding, 0)
    staged = rows.withColumn("_x", value)
    if not s.seconds:
        return staged.withColumn(name, F.last("_x", ignorenulls=True).over(upto)).drop("_x")
    last = F.max_by("_x", F.when(F.col("_x").isNotNull(), F.struct(*s.order)))
    out = _from_chunks_before(staged, s, last, lambda c: F.last(c, ignorenulls=True), "_before")
    return out.withColumn(name, F.coalesce(F.last("_x", ignorenulls=True).over(upto), "_before")).drop("_x", "_before")


def uncut(rows: DataFrame) -> DataFrame:
    return rows.drop(CHUNK)
