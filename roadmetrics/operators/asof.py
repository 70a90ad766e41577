"""As-of alignment of time series.

One pass serves any number of right sides: base and right rows are unioned with a tag and every right side's nearest
rows before and after a base row are read off one window order, so several aligned topics cost one exchange and one
sort. A base row sorts before right rows at the same time, so an equal time counts as "after".
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunked import CHUNK, Series


@dataclass
class Right:
    """A right side: its rows, its name in the result, the tolerance, who wins a tie (earlier or later), and the columns of the
    result's struct (the time among them and no key columns; all of the rows' columns unless given)."""

    rows: DataFrame
    name: str
    tolerance: float | None = None
    tie: str = "earlier"
    fields: tuple[str, ...] | None = None

    def carried(self, by: tuple[str, ...]) -> Column:
        """The struct that is exchanged: the key columns are beside it."""
        return F.struct(*[F.col(f"`{c}`") for c in self.fields or self.rows.columns if c not in by])

    def whole(self, found: str, by: tuple[str, ...]) -> Column:
        """The result's struct from one that was exchanged."""
        if self.fields:
            return F.col(found)
        return F.when(F.col(found).isNotNull(), F.struct(*[F.col(f"`{c}`") if c in by else F.col(f"{found}.`{c}`").alias(c) for c in self.rows.columns]))


def _pick(before: Column, after: Column, at: Column, on: str, tolerance: float | None, tie: str) -> Column:
    back, ahead = at - before[on], after[on] - at
    earlier = back <= ahead if tie == "earlier" else back < ahead
    pick = F.when(after.isNull() | (before.isNotNull() & earlier), before).otherwise(after)
    if tolerance is None:
        return pick
    return F.when(F.abs(pick[on] - at) <= tolerance, pick)


def _nearest(name: str, keys: list[str], on: str) -> tuple[Column, Column]:
    """The last value of a column before a row and the first one after it, nulls left out, in one window order: a second, descending
    one would sort all rows again, and a frame that ends at the partition's end would be evaluated anew for each row."""
    by, order = (", ".join(f"`{c}`" for c in x) for x in (keys, [on, "_tag", "_key"]))
    return tuple(F.expr(f"{way}(`{name}`) IGNORE NULLS OVER (PARTITION BY {by} ORDER BY {order})") for way in ("lag", "lead"))


def _carried(base: DataFrame, right: DataFrame, on: str, by: tuple[str, ...], key: str, chunk: float) -> DataFrame:
    """right's rows for the chunks of base that they reach without a bound: for each chunk that holds base rows the last
    right row of the chunks before it and the first of those after it, with the chunk's number. Only each chunk's
    first and last right rows are compared, never a series' rows."""
    s = Series(by, (on,), chunk)
    place, row = F.struct(on, key), F.struct(*[F.col(f"`{c}`") for c in right.columns])
    ends = s.cut(right).groupBy(*s.keys).agg(F.min_by(row, place).alias("_first"), F.max_by(row, place).alias("_last"))
    none = [F.lit(None).cast(ends.schema["_first"].dataType).alias(c) for c in ("_first", "_last")]
    wanted = s.cut(base.select(*by, on)).select(*s.keys).distinct().select("*", *none, F.lit(1).alias("_wanted"))
    both = ends.withColumn("_wanted", F.lit(0)).unionByName(wanted)
    chunks = both.groupBy(*s.keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("_first", "_last")], F.max("_wanted").alias("_wanted"))
    before = F.last("_last", ignorenulls=True).over(s.chunks().rowsBetween(Window.unboundedPreceding, -1))
    later = Window.partitionBy(*by).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    found = chunks.select(*s.keys, "_wanted", before.alias("_p"), F.last("_first", ignorenulls=True).over(later).alias("_n")).filter("_wanted = 1")
    return found.select(CHUNK, F.explode(F.array("_p", "_n")).alias("_r")).filter("_r IS NOT NULL").select("_r.*", CHUNK)


def _tagged(base: DataFrame, rights: list[Right], on: str, by: tuple[str, ...], key: str, chunk: float | None) -> DataFrame:
    """base's rows (tag 0; _base has the columns that are not beside it) and all right rows (tag 1), each right side in a
    struct column of its own; with chunk, right rows stand in all the chunks whose base rows they can be nearest to."""
    empty = [F.lit(None).cast(r.rows.select(r.carried(by).alias("s")).schema["s"].dataType).alias(f"_{r.name}") for r in rights]
    more = F.struct(F.lit(True).alias("_is"), *[F.col(f"`{c}`") for c in base.columns if c not in (*by, on, key)])
    rows = base.select(*by, on, F.col(key).alias("_key"), F.lit(0).alias("_tag"), more.alias("_base"), *empty)
    if chunk:
        rows = rows.withColumn(CHUNK, F.floor(F.col(on) / chunk))
    none = F.lit(None).cast(rows.schema["_base"].dataType).alias("_base")
    for i, r in enumerate(rights):
        own = r.rows
        if chunk and r.tolerance is not None and r.tolerance <= chunk:
            reach = F.sequence(F.floor((F.col(on) - r.tolerance) / chunk), F.floor((F.col(on) + r.tolerance) / chunk))
            own = own.withColumn(CHUNK, F.explode(reach))
        elif chunk:
            own = own.withColumn(CHUNK, F.floor(F.col(on) / chunk)).unionByName(_carried(base, own, on, by, key, chunk))
        rows = rows.unionByName(own.select(*by, on, F.col(key).alias("_key"), F.lit(1).alias("_tag"), none, *[r.carried(by).alias(f"_{r.name}") if j == i else empty[j] for j in range(len(rights))], *([CHUNK] if chunk else [])))
    return rows


def _base_columns(base: DataFrame, on: str, by: tuple[str, ...], key: str) -> list[Column]:
    """base's columns of tagged rows."""
    return [F.col("_key").alias(c) if c == key else F.col(f"`{c}`") if c in (*by, on) else F.col(f"_base.`{c}`").alias(c) for c in base.columns]


def align(base: DataFrame, rights: list[Right], on: str = "t", by: tuple[str, ...] = ("drive_id",), key: str = "event_id", chunk: float | None = None) -> DataFrame:
    """base plus, per right side, a struct column of its nearest row (null beyond the tolerance or if there is none).

    key is a column of both that orders rows of equal time. With ``chunk``, series are cut into pieces of that many
    seconds, so one very long series is shared by many tasks. A right row is copied to the pieces that its tolerance
    reaches; where there is no tolerance, or a longer one than a piece, each piece gets the last right row before it and the
    first one after it from a scan over the pieces' ends.
    """
    keys = [*by] + ([CHUNK] if chunk else [])
    rows = _tagged(base, rights, on, by, key, chunk)
    # Only base rows keep what is found.
    found = [F.when(F.col("_tag") == 0, c).alias(f"_{r.name}{end}") for r in rights for c, end in zip(_nearest(f"_{r.name}", keys, on), ("_p", "_n"))]
    out = rows.select("_tag", "_base", "_key", *by, on, *found).filter("_tag = 0")
    picks = [_pick(F.col(f"_{r.name}_p"), F.col(f"_{r.name}_n"), F.col(on), on, r.tolerance, r.tie).alias(f"_{r.name}") for r in rights]
    return out.select("_base", "_key", *by, on, *picks).select(*_base_columns(base, on, by, key), *[r.whole(f"_{r.name}", by).alias(r.name) for r in rights])


def neighbours(base: DataFrame, right: DataFrame, on: str = "t", by: tuple[str, ...] = ("drive_id",), key: str = "event_id", chunk: float | None = None) -> DataFrame:
    """base plus structs prev (last right row before it) and next (first at or after it). chunk: see align."""
    side = Right(right, "r")
    rows = _tagged(base, [side], on, by, key, chunk)
    prev, after = _nearest("_r", [*by] + ([CHUNK] if chunk else []), on)
    out = rows.select("_tag", "_base", "_key", *by, on, prev.alias("_prev"), after.alias("_next")).filter("_tag = 0")
    return out.select(*_base_columns(base, on, by, key), side.whole("_prev", by).alias("prev"), side.whole("_next", by).alias("next"))


def interpolate(base: DataFrame, right: DataFrame, value: str, name: str, on: str = "t", by: tuple[str, ...] = ("drive_id",), key: str = "event_id", chunk: float | None = None) -> DataFrame:
    """base plus the linear interpolation of right's value at base's times, clamped at both ends. chunk: see align."""
    both = neighbours(base, right.select(*by, on, key, value), on, by, key, chunk)
    p, n, t = F.col("prev"), F.col("next"), F.col(on)
    share = F.try_divide(t - p[on], n[on] - p[on])
    lerp = F.when(p.isNull(), n[value]).when(n.isNull(), p[value]).when(n[on] == t, n[value]).otherwise(p[value] + (n[value] - p[value]) * share)
    return both.withColumn(name, lerp).drop("prev", "next")
