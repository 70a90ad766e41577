"""Importance resampling towards a target distribution, over an integer word dictionary.

Texts (lower-cased A-Z, words of digits, letters and bytes beyond ASCII) are cut into blocks of a few MB of text; a block
holds its own list of distinct words with their counts and, for every word of its rows, the place in that list. Each
distinct word of all blocks gets an integer id, which is the tuple of its unigram; for longer n-grams the ids go back to
the blocks, which form their tuples of ids and count the distinct ones. Counts are summed by tuple, each distinct tuple's
words are joined back and its bytes hashed once, and the buckets' counts of all documents and of the target give each
bucket's gain. The gains are joined back by tuple, so a block can add up its rows' weights.

What crosses the network for a word or a tuple is one row for each block that holds it: a word that is a third of all
words is as many rows as there are blocks, in joins that Spark splits when they are skewed. The gains' table has
``buckets`` rows at most and is broadcast.

The draw sorts no more than it returns: the score at which enough documents are reached is found by counting scores by
their leading bits, 8,192 counts at a time, and only the documents from that score on are sorted by range and
numbered from the sizes of the ranges.

Edge cases: a null text has no words and no features (weight 0); documents of fewer than ``least_words`` words are never
drawn; a null doc_id is an empty string in the hash and comes last among equal scores; rows that repeat a doc_id are
documents of their own; an empty target leaves the gains of the documents' own counts; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import UPPER_TO_LOWER, WORD_BYTE, materialize, no_clash, runs, steps, utf8_bytes

BLOCK_BYTES = 8 << 20
_BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("places", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _as_blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in steps(batches, step_bytes=block_bytes):
            data, offsets = utf8_bytes(batch.column("text"))
            data = UPPER_TO_LOWER[data]
            inside = WORD_BYTE[data]
            starts, ends, of_row = runs(inside, offsets)
            where = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            letters = data[inside]  # nothing but the words, one after the other
            words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(where), pa.py_buffer(letters)).dictionary_encode()
            places = words.indices.to_numpy(zero_copy_only=False)
            counts = np.bincount(places, minlength=len(words.dictionary)).astype(np.int64)
            places = places.astype(np.uint16 if len(words.dictionary) <= 1 << 16 else np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(of_row).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([places.tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary.cast(pa.string())),
                    pa.array([counts], pa.list_(pa.int64())),
                ],
                schema=_BLOCKS,
            )
            block += 1

    return run


def _grams(places: np.ndarray, sizes: np.ndarray, n_words: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n up to longest: the n-grams' numbers at all places where one begins, those places' rows, and the distinct
    n-grams' places in the list of words (one row each, in the order of their numbers)."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    end = np.cumsum(sizes)[row] if len(row) else row
    at, code = np.arange(len(places)), places.astype(np.int64)
    tuples = np.arange(n_words)[:, None]
    for n in range(1, longest + 1):
        if n > 1:
            keep = at + n <= end[at]
            at, code = at[keep], code[keep]
            both = code * n_words + places[at + n - 1]
            values, code = np.unique(both, return_inverse=True)
            tuples = np.column_stack([tuples[values // max(1, n_words)], values % max(1, n_words)])
        yield code, row[at], tuples


def _block_of(columns: dict, i: int) -> tuple[np.ndarray, np.ndarray, int]:
    n_words = len(columns["word_ids"][i].as_py() or []) if "word_ids" in columns else columns["n_words"][i].as_py()
    places = np.frombuffer(columns["places"][i].as_buffer() or b"", np.uint16 if n_words <= 1 << 16 else np.uint32).astype(np.int64)
    return places, np.array(columns["sizes"][i].as_py(), np.int64), n_words


def _count_grams(longest: int):
    """The distinct n-grams of two words or more of each block, numbered on from its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                places, sizes, n_words = _block_of(columns, i)
                ids = np.array(columns["word_ids"][i].as_py() or [], np.int64)
                first = 0
                for code, _, tuples in _grams(places, sizes, n_words, longest):
                    if tuples.shape[1] == 1:
                        first = len(tuples)
                        continue
                    count = np.bincount(code, minlength=len(tuples))
                    named = ids[tuples]
                    offsets = np.arange(len(tuples) + 1, dtype=np.int32) * tuples.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(tuples), columns["block"][i].as_py(), np.int64)),
                            pa.array(np.full(len(tuples), columns["target"][i].as_py())),
                            pa.array(first + np.arange(len(tuples), dtype=np.int64)),
                            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(named.ravel())),
                            pa.array(count.astype(np.int64)),
                        ],
                        names=["block", "target", "number", "gram", "n"],
                    )
                    first += len(tuples)

    return run


def _add_gains(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                places, sizes, n_words = _block_of(columns, i)
                gains = np.array(columns["gains"][i].as_py() or [], np.int64)
                weight, features, first = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
                for code, row, tuples in _grams(places, sizes, n_words, longest):
                    np.add.at(weight, row, gains[first + code])
                    features += np.bincount(row, minlength=len(sizes))
                    first += len(tuples)
                yield pa.RecordBatch.from_arrays(
                    [columns["ids"][i].values, pa.array(sizes), pa.array(features), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"]
                )

    return run


def _collected(rows: DataFrame, place: str, value: str, name: str) -> DataFrame:
    """Per block the values in the order of their places."""
    gathered = rows.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), F.col(value).alias("v")))).alias("all"))
    return gathered.select("block", F.transform("all", lambda x: x["v"]).alias(name))


def weigh(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    shape = "block bigint, ids array<bigint>, sizes array<int>, places binary, words array<string>, counts array<bigint>"
    cut = lambda df: no_clash(df, "doc_id", "text").mapInArrow(_as_blocks(block_bytes), shape)
    raw = cut(docs).withColumn("target", F.lit(False))
    aim = cut(target.select(F.lit(0).cast("bigint").alias("doc_id"), "text")).withColumns({"target": F.lit(True), "block": -1 - F.col("block")})
    blocks = materialize(raw.unionByName(aim), "resampling-blocks")
    listed = blocks.select("block", "target", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select("block", "target", "place", "w.words", F.col("w.counts").alias("n")).withColumnRenamed("words", "word")
    dictionary = materialize(listed.select("word").distinct().withColumn("id", F.monotonically_increasing_id()), "resampling-dictionary")
    known = listed.join(dictionary, "word")
    grams = known.select("block", "target", F.col("place").cast("bigint").alias("number"), F.array("id").alias("gram"), "n")
    if longest > 1:
        with_ids = blocks.select("block", "target", "sizes", "places").join(_collected(known, "place", "id", "word_ids"), "block")
        grams = grams.unionByName(with_ids.mapInArrow(_count_grams(longest), "block bigint, target boolean, number bigint, gram array<bigint>, n bigint"))
    grams = materialize(grams, "resampling-grams")
    counts = materialize(grams.groupBy("gram").agg(F.sum(F.when(~F.col("target"), F.col("n")).otherwise(0)).alias("s"), F.sum(F.when(F.col("target"), F.col("n")).otherwise(0)).alias("t")), "resampling-counts")
    spelt = counts.select("gram", F.posexplode("gram").alias("p", "id")).join(dictionary, "id").groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("p", "word"))).alias("all"))
    text = F.concat_ws(" ", F.transform("all", lambda x: x["word"]))
    placed = materialize(counts.join(spelt, "gram").select("gram", "s", "t", (F.crc32(text.cast("binary")) % buckets).alias("bucket")), "resampling-buckets")
    totals = placed.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    d = lambda c: F.col(c).cast("double")
    share = ((d("t") + 1) * (d("all_s") + buckets)) / ((d("s") + 1) * (d("all_t") + buckets))
    everything = W.partitionBy()  # at most `buckets` rows
    gains = totals.withColumns({"all_s": F.sum("s").over(everything), "all_t": F.sum("t").over(everything)}).select("bucket", F.floor(F.lit(1000.0) * F.log(share)).cast("bigint").alias("gain"))
    of_gram = placed.join(F.broadcast(gains), "bucket").select("gram", "gain")
    of_block = _collected(grams.filter("NOT target").select("block", "number", "gram").join(of_gram, "gram"), "number", "gain", "gains")
    own = blocks.filter("NOT target").select("block", "ids", "sizes", "places", F.size("words").alias("n_words"))
    return own.join(of_block, "block", "left").mapInArrow(_add_gains(longest), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def _lowest_drawn(scores: DataFrame, wanted: int) -> int:
    """The largest score that at least `wanted` rows reach, by counting the leading bits of those not yet told apart."""
    prefix, left = None, wanted
    for shift in (52, 39, 26, 13, 0):
        rows = scores if prefix is None else scores.filter(F.shiftright("score", shift + 13) == prefix)
        counts = rows.groupBy(F.shiftright("score", shift).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()  # 8,192 rows at most
        for p, n in sorted(counts, reverse=True):
            prefix = p
            if n >= left:
                break
            left -= n
    return prefix


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: str = "2024", longest: int = 1, buckets: int = 10_000, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank counts the drawn ones from the highest score."""
    weights = weigh(docs, target, longest, buckets, block_bytes)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")
    rows = materialize(weights.withColumns({"score": F.col("weight") + noise, "row": F.monotonically_increasing_id()}), "resampling-weights")
    able = rows.filter(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    drawn = able.filter(F.col("score") >= _lowest_drawn(able, wanted))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    ranged = materialize(drawn.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "resampling-drawn")
    part = F.shiftright("at", 33)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))  # one row for each range
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    ranks = ranged.withColumn("part", part).join(F.broadcast(before), "part").select("row", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("rank"))
    return rows.join(ranks.filter(F.col("rank") <= wanted), "row", "left").select(*columns, "rank")
