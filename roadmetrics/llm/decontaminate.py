"""Benchmark decontamination with suffix arrays over the training text.

The training text is cut into shards (a few MB of whole documents each; a longer document is a shard of its own). Per
shard the suffixes are sorted in the order of all their words by prefix doubling; only suffixes from runs of test words
that are long enough to hold a window are in the array, since no other can match. Each test suffix that starts a window
(``window`` words, or a whole shorter item) is binary-searched in the array: the range that is found holds all its
verbatim occurrences. The longest verbatim match is that of an occurrence with its neighbours among all test suffixes.

The test set is the stated query set. It is cut into blocks of at most ``block_words`` words, which bounds what is held
and broadcast at a time. One block is one pass over the documents without a shuffle; with more, each pass writes the
rows with hits before the next block is read, and hits are merged per document.

Words are runs of digits, a-z (after lower-casing A-Z) and bytes beyond ASCII; they are compared by a 64-bit hash.

Edge cases: null and word-less texts have no words and are never hit; an item without words has no window; items that
repeat an item_id count once; words that an item with a null item_id holds are hit, but it is not listed or counted;
of equally long matches the first in the document is given; repeated rows are judged alike; empty tables give empty or
clean results; further columns are carried by ``remove_contaminated`` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER_TO_LOWER, WORD_BYTE, materialize, no_clash, runs, span_hashes, steps, utf8_bytes

HITS = "doc_id bigint, digest binary, n_words bigint, hit_start array<int>, hit_end array<int>, items array<string>, longest_words bigint, longest_item string, longest_at bigint"
_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.int64()]
_HITS = pa.schema([(c.split()[0], t) for c, t in zip(HITS.split(", "), _TYPES)])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words and the offsets of the rows in them."""
    data, offsets = utf8_bytes(texts)
    data = UPPER_TO_LOWER[data]
    starts, ends, of_row = runs(WORD_BYTE[data], offsets)
    return span_hashes(data, starts, ends), of_row


@dataclass
class TestBlock:
    """Some items as one text of word numbers (1..), each item followed by 0."""

    vocabulary: np.ndarray  # sorted word hashes; the number of a word is its place + 1
    numbers: np.ndarray
    left: np.ndarray  # words from each place to the end of its item
    item: np.ndarray  # number of the item of each place
    names: list[str | None]
    starts: dict[int, np.ndarray]  # per window length the places where windows start


def make_block(items: list[tuple[str | None, np.ndarray]], window: int) -> TestBlock:
    vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
    zero, starts, at = np.zeros(1, np.int64), {}, 0
    for _, words in items:
        length = min(window, len(words))
        starts.setdefault(length, []).append(at + np.arange(len(words) - length + 1))
        at += len(words) + 1
    return TestBlock(
        vocabulary,
        np.concatenate([zero[:0], *(x for _, w in items for x in (np.searchsorted(vocabulary, w) + 1, zero))]),
        np.concatenate([zero[:0], *(np.arange(len(w), -1, -1) for _, w in items)]),
        np.repeat(np.arange(len(items)), [len(w) + 1 for _, w in items]),
        [name for name, _ in items],
        {length: np.concatenate(x) for length, x in sorted(starts.items())},
    )


def paired(front: np.ndarray, words: int, back: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Ranks of all places by front (the order by so many words) and then by back, that many words on; an end comes
    before any word."""
    then = np.where(left > words, back[np.minimum(np.arange(len(back)) + words, len(back) - 1)], 0)
    return np.unique(front * (int(then.max()) + 1) + then, return_inverse=True)[1]


class Suffixes:
    """Ranks of the suffixes of a text by their first 1, 2, 4, ... words, up to the longest that matters."""

    def __init__(self, numbers: np.ndarray, left: np.ndarray, longest: int):
        self.left, self.levels = left, [numbers]
        while 1 << (len(self.levels) - 1) < longest:
            self.levels.append(paired(self.levels[-1], 1 << (len(self.levels) - 1), self.levels[-1], left))
        self.rank = self.levels[-1]

    def by_first(self, words: int) -> np.ndarray:
        """Ranks by exactly so many first words."""
        rank, done = None, 0
        for i in reversed(range(len(self.levels))):
            if words >> i & 1:
                rank = self.levels[i] if rank is None else paired(rank, done, self.levels[i], self.left)
                done += 1 << i
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many first words the suffixes at a and b share."""
        out, most = np.zeros(len(a), np.int64), np.minimum(self.left[a], self.left[b])
        for i in reversed(range(len(self.levels))):
            inside = out < most
            same = inside & (self.levels[i][np.where(inside, a + out, a)] == self.levels[i][np.where(inside, b + out, b)])
            out += same << i
        return np.minimum(out, most)


@dataclass
class Found:
    """Occurrences in a shard: place, length, number of the window; and of each window its items."""

    places: np.ndarray
    lengths: np.ndarray
    windows: np.ndarray
    items: list[list[str]]
    longest: np.ndarray  # the longest match that starts at each occurrence, and its item
    longest_item: np.ndarray


def occurrences(block: TestBlock, words: np.ndarray, of_row: np.ndarray, with_longest: bool = True) -> Found:
    none = np.zeros(0, np.int64)
    if not block.starts or not len(words):
        return Found(none, none, none, [], none, none)
    place = np.searchsorted(block.vocabulary, words)
    place[place == len(block.vocabulary)] = 0
    known = block.vocabulary[place] == words
    first, last, _ = runs(known, of_row)
    enough = last - first >= min(block.starts)
    first, size = first[enough], (last - first)[enough] + 1
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    left = np.repeat(size - 1, size) - within
    origin = np.minimum(np.repeat(first, size) + within, len(words) - 1)
    tests = len(block.numbers)
    text = Suffixes(np.concatenate([block.numbers, np.where(left > 0, place[origin] + 1, 0)]), np.concatenate([block.left, left]), int(block.left.max()))
    array = np.flatnonzero(left) + tests
    array = array[np.argsort(text.rank[array], kind="stable")]
    at, lengths, windows, items = [none], [none], [none], []
    for length, starts in block.starts.items():
        rank = text.by_first(length)
        sought, of_start = np.unique(rank[starts], return_inverse=True)
        low, high = (np.searchsorted(rank[array], sought, side) for side in ("left", "right"))
        for u in np.flatnonzero(high > low).tolist():
            at.append(array[low[u] : high[u]])
            lengths.append(np.full(high[u] - low[u], length))
            windows.append(np.full(high[u] - low[u], len(items)))
            items.append(sorted({block.names[i] for i in block.item[starts[of_start == u]]} - {None}))
    at = np.concatenate(at)
    longest = longest_item = np.zeros(len(at), np.int64)
    if len(at) and with_longest:
        test = np.flatnonzero(block.numbers)
        test = test[np.argsort(text.rank[test], kind="stable")]
        after = np.searchsorted(text.rank[test], text.rank[at])
        near = [test[np.clip(after + d, 0, len(test) - 1)] for d in (-1, 0)]
        both = [text.common(at, x) for x in near]
        longest, longest_item = np.maximum(*both), block.item[np.where(both[0] >= both[1], *near)]
    return Found(origin[at - tests], np.concatenate(lengths), np.concatenate(windows), items, longest, longest_item)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as disjoint ones."""
    order = np.argsort(starts, kind="stable")
    starts, upto = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > upto[:-1]]) if len(starts) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return starts[first], upto[np.append(first[1:] - 1, len(upto) - 1)] if len(first) else upto


def _search(broadcast, every_row: bool, keyed: bool = False):
    """Rows of HITS; without every_row only of documents with hits; keyed adds the digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: TestBlock = broadcast.value
        for batch in steps(batches):
            words, of_row = word_hashes(batch.column("text"))
            found = occurrences(block, words, of_row)
            rows = np.searchsorted(of_row, found.places, "right") - 1
            n = batch.num_rows
            out = [[[]] * n, [[]] * n, [[]] * n, [0] * n, [None] * n, [None] * n]
            order = np.argsort(rows, kind="stable")
            hit, edge = np.unique(rows[order], return_index=True)
            for r, own in zip(hit.tolist(), np.split(order, edge[1:])):
                s, e = merged(found.places[own], found.places[own] + found.lengths[own])
                best = own[np.lexsort((found.places[own], -found.longest[own]))[0]]
                values = (s - of_row[r]).tolist(), (e - of_row[r]).tolist(), sorted({x for w in np.unique(found.windows[own]) for x in found.items[w]})
                for column, value in zip(out, (*values, int(found.longest[best]), block.names[found.longest_item[best]], int(found.places[best] - of_row[r]))):
                    column[r] = value
            some = np.arange(n) if every_row else hit
            texts = batch.column("text").to_pylist()
            digests = [hashlib.sha256((texts[r] or "").encode()).digest() for r in some.tolist()] if keyed else [b""] * len(some)
            columns = [batch.column("doc_id").take(pa.array(some)), pa.array(digests, pa.binary()), pa.array(np.diff(of_row)[some])]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([column[r] for r in some.tolist()], f.type) for column, f in zip(out, list(_HITS)[3:]))], schema=_HITS)

    return run


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            s, e = (np.array([x for part in r[c] for x in part], np.int64) for c in ("starts", "ends"))
            s, e = merged(s, e)
            longest = min(r["longest"], key=lambda x: (-x["longest_words"], x["longest_at"], x["longest_item"] or ""))
            rows.append({"doc_id": r["doc_id"], "digest": r["digest"], "n_words": r["n_words"], "hit_start": s.tolist(), "hit_end": e.tolist(), "items": sorted({x for part in r["parts"] for x in part}), **longest})
        yield pa.RecordBatch.from_pylist(rows, schema=_HITS)


def test_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[TestBlock]:
    """The test set, read item by item and handed out in blocks of at most block_words words (or one longer item)."""
    block, words = [], 0
    for r in no_clash(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        hashes, _ = word_hashes(pa.array([r.text], pa.string()))
        if block and words + len(hashes) > block_words:
            yield make_block(block, window)
            block, words = [], 0
        if len(hashes):
            block.append((r.item_id, hashes))
            words += len(hashes)
    if block:
        yield make_block(block, window)


def _merged_passes(text: DataFrame, blocks: Iterator[TestBlock]) -> DataFrame:
    """The hits of one pass per block, each written before the next block is read; one row per (doc_id, digest) with hits."""
    context, every = text.sparkSession.sparkContext, None
    for block in blocks:
        sent = context.broadcast(block)
        hits = materialize(text.mapInArrow(_search(sent, every_row=False, keyed=True), HITS), "test-hits")
        sent.unpersist()
        every = hits if every is None else every.unionByName(hits)
    longest = F.struct("longest_words", "longest_item", "longest_at")
    together = every.groupBy("doc_id", "digest").agg(
        F.max("n_words").alias("n_words"), F.collect_set("hit_start").alias("starts"), F.collect_set("hit_end").alias("ends"), F.collect_set("items").alias("parts"), F.collect_set(longest).alias("longest")
    )
    return materialize(together.mapInArrow(_union, HITS), "test-hits")


def _digest(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 200_000) -> DataFrame:
    """Per row of docs: doc_id, n_words, the disjoint intervals of word places that are hit, the items, the longest
    verbatim match (words, item, place in the document)."""
    blocks, text = test_blocks(benchmark, window, block_words), no_clash(docs, "doc_id", "text")
    first, more = next(blocks, None) or make_block([], window), next(blocks, None)
    plain = lambda b: docs.sparkSession.sparkContext.broadcast(b)
    if more is None:
        return text.mapInArrow(_search(plain(first), every_row=True), HITS).drop("digest")
    hits = _merged_passes(text, chain([first, more], blocks))
    rows = text.mapInArrow(_search(plain(make_block([], window)), every_row=True, keyed=True), HITS).select("doc_id", "digest", "n_words")
    own = hits.drop("n_words").withColumnsRenamed({"doc_id": "_doc_id", "digest": "_digest"})
    joined = rows.join(own, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest")), "left")
    empty = {c: F.coalesce(F.col(c), F.array().cast(t)) for c, t in (("hit_start", "array<int>"), ("hit_end", "array<int>"), ("items", "array<string>"))}
    return joined.withColumns(empty | {"longest_words": F.coalesce("longest_words", F.lit(0).cast("bigint"))}).drop("_doc_id", "digest", "_digest")


def _n_hit():
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return total("hit_end") - total("hit_start")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 200_000) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and 20 * n_hit >= n_words), and the
    longest verbatim match."""
    counted = find_hits(docs, benchmark, window, block_words).withColumn("n_hit", _n_hit())
    return counted.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "longest_words", "longest_item", "longest_at",
    )


def _clean(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            words, of_row = word_hashes(batch.column("text"))
            found = occurrences(broadcast.value, words, of_row, with_longest=False)
            hit = np.zeros(len(words) + 1, np.int64)
            np.add.at(hit, found.places, 1)
            np.add.at(hit, found.places + found.lengths, -1)
            covered = np.concatenate([[0], np.cumsum(np.cumsum(hit)[:-1] > 0)])
            n_hit = covered[of_row[1:]] - covered[of_row[:-1]]
            yield batch.filter(pa.array(~((n_hit > 0) & (20 * n_hit >= np.diff(of_row)))))

    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 200_000) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns; in one pass if the test set is one block."""
    blocks = test_blocks(benchmark, window, block_words)
    first, more = next(blocks, None) or make_block([], window), next(blocks, None)
    if more is None:
        return docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(first)), docs.schema)
    hits = _merged_passes(no_clash(docs, "doc_id", "text"), chain([first, more], blocks)).withColumn("_n", _n_hit())
    bad = hits.filter((F.col("_n") > 0) & (20 * F.col("_n") >= F.col("n_words"))).select(F.col("doc_id").alias("_doc_id"), F.lower(F.hex("digest")).alias("_digest"))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (_digest("text") == F.col("_digest")), "left_anti")
