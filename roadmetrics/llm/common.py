"""What the operators share: durable intermediate tables and vectorised text handling on Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step holds; a longer text is a step of its own.
STEP_BYTES = 4 << 20

UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
UPPER_TO_LOWER[65:91] += 32


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a folder of our own in local mode
    (tests); on a cluster, whose machines would not see it, an error."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="checkpoints-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, most_rows: int) -> DataFrame:
    """df with a broadcast hint if it has been counted to hold at most most_rows rows, else df as it is for a shuffled join."""
    if df.limit(most_rows + 1).count() <= most_rows:
        return F.broadcast(df)
    return df


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of whole rows with about step_bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        step = np.cumsum(size) // step_bytes
        cuts = np.flatnonzero(np.diff(step)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(lo, hi - lo)


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes in one array and the offsets of its rows in it; null is empty."""
    column = pc.fill_null(column.cast(pa.large_utf8()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that stay within a row, and the offsets of the rows in them."""
    if not len(member):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inner = offsets[:-1][offsets[:-1] < len(member)]
    before = np.empty_like(member)
    before[0], before[1:] = False, member[:-1]
    before[inner] = False
    starts = np.flatnonzero(member & ~before)
    after = np.empty_like(member)
    after[-1], after[:-1] = False, member[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_LOW_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit words (xor-shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of data, eight bytes at a time."""
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), np.dtype("<u8"), padded, strides=(1,))
    which, at, left = None, starts, lengths
    while len(at):
        word = eight[at] & _LOW_BYTES[np.clip(left, 0, 8)]
        if which is None:
            out = mix(out ^ word)
            which = np.flatnonzero(left > 8)
            at, left = starts[which] + 8, left[which] - 8
        else:
            out[which] = mix(out[which] * np.uint64(3) ^ word)
            more = left > 8
            which, at, left = which[more], at[more] + 8, left[more] - 8
    return out


#: Word bytes after lower-casing: digits, a-z and everything beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
#: Everything but ASCII white space.
VISIBLE_BYTE = np.ones(256, bool)
VISIBLE_BYTE[[0x20, *range(0x09, 0x0E)]] = False


def no_clash(df: DataFrame, *names: str) -> DataFrame:
    """df with only the named columns; one that is missing is a null column of type string (bigint for ids)."""
    have = set(df.columns)
    return df.select(*(F.col(f"`{n}`") if n in have else F.lit(None).cast("bigint" if n.endswith("_id") else "string").alias(n) for n in names))


def rows_of_texts(docs: DataFrame, chosen: DataFrame, text_hash: Column) -> DataFrame:
    """One row of docs, with all its columns, of each (doc_id, text_hash) in chosen; null is an id. text_hash is never
    null and is worked out in the same way for chosen. The texts cross one exchange, which the semi-join and the choice
    of one row share."""
    keys = ["_row_hash", "_row_id", "_row_nameless"]
    keyed = lambda df, h: df.withColumns({"_row_hash": h, "_row_id": F.coalesce("doc_id", F.lit(0)), "_row_nameless": F.col("doc_id").isNull()})
    wanted = keyed(chosen.select("doc_id", "text_hash"), F.col("text_hash")).select(keys).distinct()
    rows = keyed(docs, text_hash).join(wanted, keys, "left_semi").dropDuplicates(keys)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def remainder(doc_id, modulus: int):
    """crc32 of the id as text, by which rows are held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most_rows: int, most_bytes: int = 64_000) -> list[tuple[str, int]]:
    """(text, label) of at most most_rows labelled documents that are not held out, in an order that is the same at every
    run. Texts beyond most_bytes are not fitted on, so the sample's size is bounded by most_rows * most_bytes."""
    learn = (
        labels.filter(remainder(F.col("doc_id"), 3) != 1).filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("_label"))
    )
    order = F.xxhash64("doc_id")
    chosen = learn.orderBy(order, "doc_id").limit(most_rows)
    texts = no_clash(docs, "doc_id", "text").filter(F.octet_length("text") <= most_bytes)
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_label").alias("_label")).collect()
    return [(r.text, int(r["_label"])) for r in sorted(rows, key=lambda r: r.doc_id)]
