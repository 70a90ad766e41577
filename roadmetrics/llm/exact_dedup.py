"""Exact dedup by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z. Three combining stages, each of which groups by the
digest and the full content, so that different texts are never merged; if two share a SHA-256 digest, by which rows are
told apart in the result, the query fails with that digest rather than mix them up:

1. locally: each task combines what it has read (the map side of the salted aggregate);
2. salted: rows of one digest are merged under up to ``salts`` salts, so a group with a third of all rows meets in
   many tasks, each of which receives one row per upstream task at most;
3. globally: the salts' winners (at most ``salts`` rows a group) are combined by digest.

Only groups of two rows or more are joined back to the documents, on the narrow (digest, doc_id) columns; Spark splits
skewed partitions of that join.

Edge cases: a null text counts as empty; null doc_ids lose against any other id (keep_id is null if a group has no id);
rows that repeat a doc_id of the group's winner are all shown as kept, and ``exact_dedup`` returns one of them; an
empty table gives an empty result; other columns of the input are carried by ``exact_dedup`` and ignored by
``duplicate_groups``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_clash, rows_of_texts, steps


def _normalised(with_content: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            content = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
            digest = pa.array([hashlib.sha256(x.as_buffer() or b"").digest() for x in content], pa.binary())
            columns = {"doc_id": batch.column("doc_id"), "digest": digest}
            yield pa.RecordBatch.from_pydict(columns | ({"content": content} if with_content else {}))

    return run


def combined_groups(docs: DataFrame, salts: int = 32) -> DataFrame:
    """One row per distinct content: digest (binary), keep_id (largest doc_id), group_size."""
    keyed = no_clash(docs, "doc_id", "text").mapInArrow(_normalised(True), "doc_id bigint, digest binary, content string")
    salted = (
        keyed.withColumn("salt", F.spark_partition_id() % F.lit(salts))
        .groupBy("digest", "salt", "content")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    merged = salted.repartition("digest").groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    one = merged.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    collision = F.raise_error(F.concat(F.lit("different texts share the SHA-256 digest "), F.hex("digest")))
    return one.select("digest", "keep_id", F.when(F.col("contents") == 1, F.col("group_size")).otherwise(collision.cast("bigint")).alias("group_size"))


def duplicate_groups(docs: DataFrame, salts: int = 32) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text, hex)."""
    groups = combined_groups(docs, salts).filter("group_size > 1")
    rows = no_clash(docs, "doc_id", "text").mapInArrow(_normalised(False), "doc_id bigint, digest binary")
    joined = rows.join(groups, "digest", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, salts: int = 32) -> DataFrame:
    """One row of docs of each text, with all its columns."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kept = duplicate_groups(docs, salts).filter("kept").select("doc_id", F.col("text_sha256").alias("text_hash"))
    return rows_of_texts(docs, kept, F.sha2(F.translate(F.coalesce("text", F.lit("")), upper, upper.lower()), 256))
