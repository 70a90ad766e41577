"""Line dedup by winnowing over line hashes.

A shingle is the shortest run of lines from a line on with ``shingle_words`` words, a window the shortest one, from a
line on or up to a line, with ``run_words`` words. Of the shingles inside each window the one with the least hash is a fingerprint; whatever run of at
least ``run_words`` words two documents share, they share the fingerprint of the run's first window. Fingerprint
positions are joined with the first position of the same fingerprint, matches are extended line by line both ways (as
far as the next fingerprint can be), and a run of at least ``run_words`` words is deleted where it stands later. Where
the first position gives a shorter run, or one that does not hold all windows of the fingerprint, these windows
themselves are joined with their first position, so that no shared run of ``run_words`` words is missed.

Order is (doc_id, text hash, line); the first copy of every line stays. Joins are with one first position per key, so a
run that a third of all documents share costs one row per document.

Only lines with words are hashed, compared and extended over; lines without words go if they stand inside a deleted run.
Winnowing takes time in proportion to the lines: run hashes come from prefix sums, window minima from one queue.

Edge cases: null text stays null and has no lines; lines are compared without surrounding white space; null doc_ids come first; rows that repeat doc_id and text are treated as one document
(all of them keep the same lines); a document of which nothing is left has empty text; texts of any length are cut into
lines once, and a fingerprint carries as many lines beside it as run_words words take; an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import VISIBLE_BYTE, materialize, mix, no_clash, runs, steps, utf8_bytes

MATCH = "key bigint, doc_id bigint, text_hash bigint, first int, last int, words int, before array<bigint>, before_words array<int>, before_at array<int>, after array<bigint>, after_words array<int>, after_at array<int>, windows array<struct<hash:bigint,first:int,last:int>>"
_MATCH = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("words", pa.int32())]
    + [(c + e, pa.list_(t)) for c in ("before", "after") for e, t in (("", pa.int64()), ("_words", pa.int32()), ("_at", pa.int32()))]
    + [("windows", pa.list_(pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])))]
)


#: Odd, so that it has an inverse modulo 2^64: a run's hash is worked out from two sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Lines:
    """The lines of one document that have words: their places among all lines, word counts and hashes."""

    def __init__(self, places: np.ndarray, words: np.ndarray, hashes: np.ndarray):
        self.places, self.words = places, words
        self.upto = np.concatenate([[0], np.cumsum(words)])
        powers = np.full(len(words), _BASE, np.uint64)
        powers[:1] = 1
        self._powers = np.cumprod(powers, dtype=np.uint64)
        powers[1:] = np.uint64(_INVERSE)
        self._inverse = np.cumprod(powers, dtype=np.uint64)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * self._powers, dtype=np.uint64)])

    def ends(self, least: int) -> np.ndarray:
        """For each line the last line of the shortest run from it on with that many words; -1 if there is none."""
        end = np.searchsorted(self.upto, self.upto[:-1] + least) - 1
        return np.where(end < len(self.words), end, -1)

    def run_hashes(self, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        """The hashes of runs of lines, each in constant time."""
        sums = (self._sums[lasts + 1] - self._sums[firsts]) * self._inverse[firsts]
        return mix(sums ^ mix((lasts - firsts + 1).astype(np.uint64))).view(np.int64)

    def reach(self, at: int, step: int, run_words: int) -> np.ndarray:
        """The lines next to a shingle, outwards, until run_words words (each line has one at least)."""
        if not 0 <= at < len(self.words):
            return np.arange(0)
        if step > 0:
            return np.arange(at, min(int(np.searchsorted(self.upto, self.upto[at] + run_words)), len(self.words)))
        return np.arange(at, max(int(np.searchsorted(self.upto, self.upto[at + 1] - run_words, "right")) - 1, 0) - 1, -1)


def winnow(lines: Lines, shingle_words: int, run_words: int) -> dict[int, list[tuple[int, int, int]]]:
    """The fingerprints: of each selected shingle its first line, with the windows (hash, first, last) that select it.
    The minima of all windows are found in one pass with a queue of rising keys. The shortest windows that end at a line
    go with the window that starts where they do: each line of a run lies in one of the two kinds inside the run."""
    shingle, window = lines.ends(shingle_words), lines.ends(run_words)
    whole = int((shingle >= 0).sum())
    keys = lines.run_hashes(np.arange(whole), shingle[:whole]).tolist()
    count = int((window >= 0).sum())
    hashes = lines.run_hashes(np.arange(count), window[:count]).tolist()
    last = np.flatnonzero(lines.upto[1:] >= run_words)
    begin = np.searchsorted(lines.upto, lines.upto[last + 1] - run_words, "right") - 1
    longer = np.flatnonzero(last > window[begin]) if len(last) else last
    ending: dict[int, list] = {}
    for h, i, j in zip(lines.run_hashes(begin[longer], last[longer]).tolist(), begin[longer].tolist(), last[longer].tolist()):
        ending.setdefault(i, []).append((h, i, j))
    shingle, window = shingle.tolist(), window.tolist()
    queue: deque[int] = deque()
    chosen: dict[int, list] = {}
    ahead = 0
    for i in range(count):
        while ahead < whole and shingle[ahead] <= window[i]:
            while queue and keys[queue[-1]] >= keys[ahead]:
                queue.pop()
            queue.append(ahead)
            ahead += 1
        while queue[0] < i:
            queue.popleft()
        chosen.setdefault(queue[0], []).extend(((hashes[i], i, window[i]), *ending.get(i, ())))
    return chosen


def _fingerprints(shingle_words: int, run_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            data, offsets = utf8_bytes(batch.column("text"))
            starts, _, _ = runs(VISIBLE_BYTE[data], offsets)
            breaks = np.flatnonzero(data == 10)
            raw, rows = data.tobytes(), []
            of_break = np.searchsorted(breaks, offsets)
            ids, text_hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for d in range(batch.num_rows):
                inner = breaks[of_break[d] : of_break[d + 1]]
                firsts = np.concatenate([[offsets[d]], inner + 1])
                lasts = np.append(inner, offsets[d + 1])
                words = np.diff(np.searchsorted(starts, np.append(firsts, offsets[d + 1])))
                if words.sum() < run_words:
                    continue
                worded = np.flatnonzero(words)
                hashes = np.array([xxhash.xxh3_64_intdigest(raw[a:b].strip()) for a, b in zip(firsts[worded].tolist(), lasts[worded].tolist())], np.uint64)
                lines = Lines(worded, words[worded], hashes)
                chosen, shingle = winnow(lines, shingle_words, run_words), lines.ends(shingle_words)
                selected = np.array(list(chosen))
                keys = lines.run_hashes(selected, shingle[selected]).tolist()
                signed = hashes.view(np.int64)
                for key, (s, windows) in zip(keys, chosen.items()):
                    e = int(shingle[s])
                    back, on = lines.reach(s - 1, -1, run_words), lines.reach(e + 1, 1, run_words)
                    rows.append((key, ids[d], text_hashes[d], int(worded[s]), int(worded[e]), int(lines.words[s : e + 1].sum()), signed[back], lines.words[back], worded[back], signed[on], lines.words[on], worded[on], [{"hash": h, "first": int(worded[i]), "last": int(worded[j])} for h, i, j in windows]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MATCH)], schema=_MATCH)

    return run


def _equal_lines(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    stop = F.array_position(same, False)
    return F.when(stop == 0, F.size(same)).otherwise(stop - 1).cast("int")


def _total(words: Column, n: Column) -> Column:
    return F.aggregate(F.slice(words, F.lit(1), n), F.lit(0), lambda t, x: t + x)


def _outermost(places: str, n: str, own: str) -> Column:
    """The place of the n-th line outwards, or its own where no line matched."""
    return F.when(F.col(n) > 0, F.element_at(places, F.col(n))).otherwise(F.col(own)).cast("int").alias(own)


def repeated_runs(docs: DataFrame, shingle_words: int = 25, run_words: int = 50) -> DataFrame:
    """doc_id, text_hash, first, last: runs of lines of at least run_words words that stand elsewhere earlier."""
    text = no_clash(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_hash"), "text").filter("text IS NOT NULL")
    prints = materialize(text.mapInArrow(_fingerprints(shingle_words, run_words), MATCH), "line-fingerprints")
    place = F.struct("doc_id", "text_hash", "first")
    firsts = prints.groupBy("key").agg(F.min(place).alias("origin"), F.max(place).alias("latest")).filter("origin != latest").drop("latest")
    shared = materialize(prints.join(firsts, "key"), "line-matches")
    origin = shared.filter(place.eqNullSafe(F.col("origin"))).groupBy("key").agg(F.min(F.struct("before", "after")).alias("there"))
    later = shared.filter(~place.eqNullSafe(F.col("origin"))).join(origin, "key")
    back, on = _equal_lines(F.col("before"), F.col("there.before")), _equal_lines(F.col("after"), F.col("there.after"))
    extended = later.withColumns({"back": back, "on": on}).withColumn("total", F.col("words") + _total(F.col("before_words"), F.col("back")) + _total(F.col("after_words"), F.col("on")))
    extended = materialize(extended.select("doc_id", "text_hash", _outermost("before_at", "back", "first"), _outermost("after_at", "on", "last"), "total", "windows"), "line-extended")
    windows = lambda df: df.select("doc_id", "text_hash", F.explode("windows").alias("w")).select("doc_id", "text_hash", "w.*")
    window_place = F.struct("doc_id", "text_hash", "first")
    first_windows = windows(shared).groupBy("hash").agg(F.min(window_place).alias("origin"), F.max(window_place).alias("latest")).filter("origin != latest")
    outside = extended.withColumn("windows", F.when(F.col("total") < run_words, F.col("windows")).otherwise(F.filter("windows", lambda w: (w["first"] < F.col("first")) | (w["last"] > F.col("last")))))
    other = windows(outside.filter(F.size("windows") > 0)).join(first_windows, "hash").filter(~window_place.eqNullSafe(F.col("origin")))
    cut = ["doc_id", "text_hash", "first", "last"]
    return extended.filter(F.col("total") >= run_words).select(*cut).unionByName(other.select(*cut)).distinct()


def dedup_lines(docs: DataFrame, shingle_words: int = 25, run_words: int = 50, counts: bool = False) -> DataFrame:
    """docs without the repeated runs; counts adds n_lines and n_removed."""
    cuts = repeated_runs(docs, shingle_words, run_words).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("_cuts"))
    cuts = cuts.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    hashed = docs.withColumn("_own_hash", F.xxhash64("text"))
    joined = hashed.join(cuts, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_own_hash") == F.col("_text_hash")), "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x, i: ~F.exists("_cuts", lambda c: i.between(c["first"], c["last"])))
    out = joined.withColumn("_kept", F.when(F.col("_cuts").isNotNull(), kept))
    new = F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n"))
    columns = [new.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        n = F.coalesce(F.size(lines), F.lit(0)).cast("bigint")
        columns += [n.alias("n_lines"), F.coalesce(n - F.size("_kept"), F.lit(0)).cast("bigint").alias("n_removed")]
    return out.select(*columns)
