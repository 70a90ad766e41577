"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only).

A document's hash is the first 60 bits of the MD5 of its id and text. Words are summed by source and hash bucket; the bucket in
which a source's budget runs out is found in the histogram's running sum, only that boundary bucket is refined by the
next bits, and the last, tiny bucket by the whole hash. The documents are then filtered by hash <= threshold: they are
never sorted. Thresholds are nested: a larger budget takes a superset.

A source whose target exceeds its size is taken whole floor(target / size) times and by threshold for the rest.

Rows of a source that share their id and text are told apart by an occurrence number, from which all but the first get a
hash of their own. The numbers are given within what each task has read, from sums over the tasks before it, so that a row
that is repeated in a third of the table is numbered by many tasks; which of equal rows gets which number doesn't matter.

Edge cases: null text has size 0; null is a source of its own, ordered last; repeated rows are units of their own, of which
any may be taken; a source of size 0 has target 0; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, materialize, no_clash

HASH_BITS = 60
#: Bits of the hash by which the two histograms are made.
LEVELS = (12, 24)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def row_hash(doc_id: Column, text: Column) -> Column:
    said = F.concat_ws("\n", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_repeats: int = 3) -> DataFrame:
    """Targets of the sources (one row each: source, source_size) by weighted sharing with caps.

    With the sources in order of cap / weight, a source is capped if its share of what the sources before it leave
    would exceed its cap; the first that is not sets the share of one unit of weight for all after it.
    """
    by_name, whole = Window.orderBy(F.col("source").asc_nulls_last()), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("bigint")
    caps = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most_repeats)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = caps.withColumn("unit", left.cast("double") / F.sum("weight").over(after))
    first_free = F.when(F.col("unit") * F.col("weight") <= F.col("cap"), F.col("unit"))
    unit = F.first(first_free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return share.withColumn("free_unit", unit).select(
        "source", "source_size", F.coalesce(F.col("free_unit") * F.col("weight"), F.col("cap").cast("double")).alias("target")
    )


def _boundary(histogram: DataFrame, bucket: str) -> DataFrame:
    """Of each source the bucket in which its budget (need) runs out, and what is left of the budget there."""
    running = F.sum("words").over(Window.partitionBy("source").orderBy(bucket))
    out = histogram.withColumn("upto", running).filter("upto > need")
    first = out.groupBy("source").agg(F.min_by(F.struct(bucket, (F.col("need") - F.col("upto") + F.col("words")).alias("need")), bucket).alias("at"))
    return first.select("source", f"at.{bucket}", "at.need")


def _with(rows: DataFrame, per_source: DataFrame, most_sources: int, *more: str) -> DataFrame:
    small = bounded_broadcast(per_source.select(F.col("source").alias("_source"), *[F.col(c).alias(f"_{c}") if c in rows.columns else F.col(c) for c in per_source.columns if c != "source"]), most_sources)
    condition = F.col("source").eqNullSafe(F.col("_source"))
    for c in more:
        condition &= F.col(c) == F.col(f"_{c}")
    return rows.join(small, condition).drop("_source", *[f"_{c}" for c in more])


def _told_apart(sized: DataFrame, most_sources: int) -> DataFrame:
    """sized with hashes of their own for the second and later of rows that share source, doc_id and text."""
    keys = ["source", "doc_id", "hash"]
    per_task = sized.groupBy(*keys, "task").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(per_task.groupBy(*keys).agg(F.sum("n").alias("copies")).filter("copies > 1").drop("copies"), "mixing-repeated")
    if not repeated.head(1):
        return sized.drop("task")
    few = bounded_broadcast(repeated.select(*[F.col(k).alias(f"_{k}") for k in keys]), most_sources)
    same = F.col("hash") == F.col("_hash")
    for k in keys[:2]:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    within = lambda df: df.join(few, same, "left_semi")
    upto = Window.partitionBy(*keys).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = within(per_task).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("task").alias("_task"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*keys, "task").orderBy("task")) - 1
    copies = within(sized).withColumn("_own", own).join(before, same & (F.col("task") == F.col("_task")))
    number = F.col("_before") + F.col("_own")
    apart = F.conv(F.substring(F.md5(F.concat_ws("\n", F.col("hash"), number).cast("binary")), 1, 15), 16, 10).cast("bigint")
    renamed = copies.withColumn("hash", F.when(number == 0, F.col("hash")).otherwise(apart))
    return sized.join(few, same, "left_anti").drop("task").unionByName(renamed.select(*[c for c in sized.columns if c != "task"]))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_repeats: int = 3, most_sources: int = 50_000) -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), taken (words, repeats counted), epochs.

    Tables with one row per source are broadcast if counted to hold at most most_sources rows, else joined by shuffle.
    """
    read = materialize(
        no_clash(docs, "doc_id", "source", "text")
        .select("doc_id", "source", word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("hash"), F.spark_partition_id().alias("task")),
        "mixing-rows",
    )
    cells = {f"b{i}": F.shiftright("hash", HASH_BITS - bits) for i, bits in enumerate(LEVELS)}
    sized = materialize(_told_apart(read, most_sources).withColumns(cells), "mixing-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(most_repeats))).otherwise(0).cast("bigint")
    targets = materialize(
        source_targets(sizes, weights, most_repeats).withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")),
        "mixing-targets",
    )
    edge = targets.select("source", "need")
    for i in range(len(LEVELS)):
        last = [f"b{i - 1}"] if i else []
        histogram = _with(sized, edge, most_sources, *last).groupBy("source", f"b{i}").agg(F.sum("size").alias("words"), F.first("need").alias("need"))
        edge = materialize(_boundary(histogram, f"b{i}"), f"mixing-edge{i}")
    last = f"b{len(LEVELS) - 1}"
    units = _with(sized, edge, most_sources, last).groupBy("source", "hash").agg(F.sum("size").alias("words"), F.first("need").alias("need"))
    middle = F.sum("words").over(Window.partitionBy("source").orderBy("hash")) - F.col("words") / 2
    inside = units.withColumn("middle", middle).filter("middle <= need").groupBy("source").agg(F.max("hash").alias("inside"))
    below = F.shiftleft(F.col(last), HASH_BITS - LEVELS[-1]) - 1
    both = edge.select("source", below.alias("threshold")).unionByName(inside.select("source", F.col("inside").alias("threshold")))
    threshold = both.groupBy("source").agg(F.max("threshold").alias("threshold"))
    plan = (
        targets.select("source", "source_size", "target", "whole").unionByName(threshold, allowMissingColumns=True)
        .groupBy("source").agg(*[F.max(c).alias(c) for c in ("source_size", "target", "whole", "threshold")])
    )
    taken = _with(sized, plan, most_sources).withColumn("epochs", F.col("whole") + F.when(F.col("hash") <= F.col("threshold"), 1).otherwise(0))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"), F.col("epochs").cast("bigint").alias("epochs"))
