"""Near-dedup with Order MinHash and verification by banded alignment.

A text's words (lower-cased A-Z, runs of digits, letters and bytes beyond ASCII) are read as k-mers of five words, each
labelled with its occurrence number. An Order MinHash sketch samples the two labelled k-mers of least hash and retains
their order in the text. Texts that agree in one of the sketches (bands) are candidates. Candidates are verified by
alignment: the labelled k-mers that both texts hold, within a band around the diagonal, are aligned in text order (labels
are unique in a text, so the alignment is a longest increasing run of places), and what lies between them is aligned word
by word. A pair is linked if the aligned k-mers make up at least ``similarity`` of all k-mers of the two, or if the
words inserted, deleted or replaced are at most 1 - ``edit`` of the longer text's words: five k-mers hang on each word,
so that texts with one changed word in ten share fewer than half of them. Classes are the connected components of the
links.

With two k-mers a sketch and 20 bands, a pair of one changed word in ten at equal distances (edit similarity 0.9, 0.42
of the k-mers common) is missed as a candidate with a chance of about 2 %, one of one word in twenty with 4e-5, one at
k-mer similarity 0.8 with 1e-9. The words counted are those of one alignment, so never fewer than the least possible; a
gap without a common k-mer that is longer than ``GAP`` words on a side is compared place by place, and may then count
more.

What keeps groups bounded: texts with the same words are one node from the start, whatever their number; a bucket
becomes a task of at most about ``task_rows`` nodes. A larger bucket is cut into chunks. First each chunk meets the
bucket's first chunk only, which links a group of near copies in as many tasks as it has chunks. Then, of what these
links have not yet joined into one class, chunks of different classes meet, so that no link between classes is lost; a
bucket of one class is done. (A large bucket of many classes costs its size times its number of chunks in rows.)
Inside a task the pairs' overlaps are found by sparse counting in blocks, and only a spanning forest of verified links
leaves it. Node tables, tasks, links and each round of the components are written to the shared folder.

Edge cases: null text is empty; texts without words are one class; texts of fewer than five words are alike only if
they have the same words; words and k-mers are compared by 32 bits in the alignment, so two unlike ones pass for equal
with a chance of 2^-32; null doc_ids never name a class unless the whole class has none; repeated rows share their
class; an empty table gives an empty result; further columns are kept by ``near_dedup``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER_TO_LOWER, WORD_BYTE, bounded_broadcast, materialize, mix, no_clash, rows_of_texts, runs, span_hashes, steps, utf8_bytes

KMER, BANDS, SKETCHES_PER_BAND, GAP = 5, 20, 1, 4096
#: Nodes in second tasks up to which they are broadcast to filter the words; beyond, all words are dealt out again.
REST_NODES = 1 << 18
_NODES = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("node", pa.binary()), ("words", pa.binary()), ("bands", pa.list_(pa.int64()))])


def kmer_labels(words: np.ndarray, of_row: np.ndarray, k: int = KMER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-labelled k-mers of all rows in text order, and the offsets of the rows in them."""
    counts = np.diff(of_row)
    counts = np.where(counts > 0, np.maximum(1, counts - k + 1), 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    at = of_row[row] + np.arange(offsets[-1]) - offsets[row]
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + np.where(at + j < of_row[row + 1], padded[at + j], np.uint64(0))
    h = mix(h)
    order = np.lexsort((h, row))
    sorted_h, sorted_row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (sorted_h[1:] != sorted_h[:-1]) | (sorted_row[1:] != sorted_row[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    occurrence = np.empty(len(h), np.uint64)
    occurrence[order] = (np.arange(len(h)) - first).astype(np.uint64)
    return mix(h + occurrence * np.uint64(0x9E3779B97F4A7C15)), offsets


def _places(v: np.ndarray, least: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Of each row the first place of its least value."""
    at = np.flatnonzero(v == least[row])
    return at[np.unique(row[at], return_index=True)[1]]


def order_minhash(labels: np.ndarray, offsets: np.ndarray, bands: int = BANDS, per_band: int = SKETCHES_PER_BAND) -> np.ndarray:
    """Band keys (rows x bands) of rows that all have labels."""
    first, row = offsets[:-1], np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    seeds = mix(np.arange(1, bands * per_band + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    keys = np.zeros((len(first), bands), np.uint64)
    for t, seed in enumerate(seeds):
        v = (labels ^ seed) * np.uint64(0xE7037ED1A0B428DB)
        v ^= v >> np.uint64(29)
        v *= np.uint64(0x8EBC6AF09C88C6E3)
        at_one = _places(v, np.minimum.reduceat(v, first), row)
        v[at_one] = none
        two = np.minimum.reduceat(v, first)
        at_two = np.where(two == none, at_one, _places(v, two, row))
        a, b = labels[np.minimum(at_one, at_two)], labels[np.maximum(at_one, at_two)]
        keys[:, t // per_band] = mix(keys[:, t // per_band] * np.uint64(3) + mix(a * np.uint64(5) + mix(b)) + np.uint64(t))
    return keys


def _nodes(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            data, offsets = utf8_bytes(batch.column("text"))
            data = UPPER_TO_LOWER[data]
            starts, ends, of_row = runs(WORD_BYTE[data], offsets)
            words = span_hashes(data, starts, ends)
            raw = words.tobytes()
            node = [xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for a, b in zip(of_row[:-1].tolist(), of_row[1:].tolist())]
            fresh = {n: i for i, n in reversed(list(enumerate(node)))}  # the first row of each node of this step
            labels, where = kmer_labels(words, of_row)
            full = np.flatnonzero(np.diff(of_row) >= KMER)
            keys = np.zeros((batch.num_rows, bands), np.int64)
            if len(full):
                keep = np.repeat(np.diff(of_row) >= KMER, np.diff(where))
                counts = np.diff(where)[full]
                keys[full] = order_minhash(labels[keep], np.concatenate([[0], np.cumsum(counts)]), bands).view(np.int64)
            short = words.astype(np.uint32)
            sent = [fresh[n] == i and of_row[i + 1] - of_row[i] >= KMER for i, n in enumerate(node)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(node, pa.binary()),
                    pa.array([short[of_row[i] : of_row[i + 1]].tobytes() if s else None for i, s in enumerate(sent)], pa.binary()),
                    pa.array([keys[i] if s else None for i, s in enumerate(sent)], pa.list_(pa.int64())),
                ],
                schema=_NODES,
            )

    return run


def _increasing(places: np.ndarray) -> np.ndarray:
    """Which of the places make a longest strictly increasing run."""
    if len(places) < 2 or (np.diff(places) > 0).all():
        return np.arange(len(places))
    tails: list[int] = []
    at: list[int] = []
    before = np.full(len(places), -1)
    for n, p in enumerate(places.tolist()):
        k = bisect_left(tails, p)
        tails[k : k + 1], at[k : k + 1] = [p], [n]
        if k:
            before[n] = at[k - 1]
    run = [at[-1]]
    while before[run[-1]] >= 0:
        run.append(before[run[-1]])
    return np.array(run[::-1])


def gap_cost(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Words to insert, delete or replace between a and b; where it is more than most, some number above most."""
    short = min(len(a), len(b))
    unlike = np.flatnonzero(a[:short] != b[:short])
    head = int(unlike[0]) if len(unlike) else short
    a, b, short = a[head:], b[head:], short - head
    unlike = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(unlike[0]) if len(unlike) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(a) > len(b):
        a, b = b, a
    if len(a) < 2:
        return len(b) - (len(a) == 1 and bool((b == a[0]).any()))
    if len(b) - len(a) > most:
        return most + 1
    if len(b) > GAP:
        return len(b) - int((a == b[: len(a)]).sum())
    return edit_distance(a.tolist(), b.tolist(), most)


def edit_distance(a: list[int], b: list[int], most: int) -> int:
    """Words to insert, delete or replace between a (not empty) and b; where it is more than most, some number above most.
    Column by column, the steps up and down a column in the bits of two numbers (Myers 1999, Hyyrö 2003)."""
    places: dict[int, int] = {}
    for n, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << n
    last = 1 << len(a) - 1
    full, down, cost = 2 * last - 1, 0, len(a)
    up = full
    for left, word in zip(range(len(b) - 1, -1, -1), b):
        same = places.get(word, 0)
        level = same | down
        across = ((same & up) + up ^ up) | same
        more, less = down | full & ~(across | up), up & across
        cost += bool(more & last) - bool(less & last)
        if cost - left > most:
            return most + 1
        more, less = more << 1 | 1, less << 1
        up, down = (less | ~(level | more)) & full, more & level & full
    return cost


def edit_cost(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> int:
    """Words to insert, delete or replace between a and b where their k-mers at places i and j are held together; where it
    is more than most, some number above most."""
    cuts = np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1))
    cost = x = y = 0
    if len(i):
        for s, e in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(i) - 1]):
            over = max(0, x - int(i[s]), y - int(j[s]))  # k-mers of two diagonals may share words; the first keeps them
            if i[s] + over >= i[e] + KMER:
                continue
            cost += gap_cost(a[x : i[s] + over], b[y : j[s] + over], most - cost)
            if cost > most:
                return cost
            x, y = int(i[e]) + KMER, int(j[e]) + KMER
    return cost + gap_cost(a[x:], b[y:], most - cost)


def aligned(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, similarity: float, edit: float) -> bool:
    """Whether a and b (words) with the labels of_a and of_b (k-mers) are linked: by k-mers that align in order within the
    band, or by the words that differ."""
    _, i, j = np.intersect1d(of_a, of_b, assume_unique=True, return_indices=True)
    total = len(of_a) + len(of_b)
    most = int((1 - edit) * max(len(a), len(b)) + 1e-9)
    if len(i) < min(similarity * (total - len(i)), max(len(a), len(b)) - KMER + 1 - KMER * most):
        return False
    band = max(most, int(total * (1 - similarity) / (1 + similarity)) + 2)  # no pair at the thresholds strays further
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    order = np.argsort(i)
    i, j = i[order], j[order]
    run = _increasing(j)
    n = len(run)
    return n >= similarity * (total - n) or edit_cost(a, b, i[run], j[run], most) <= most


def word_counts(rows: list[np.ndarray], run: int = 1, cells: int = 1 << 23) -> np.ndarray:
    """Each row's words, or pairs of neighbouring words (run 2), counted by hash: rows x buckets."""
    width = 1 << max(6, min(int((16 // run**2) * np.median([len(r) for r in rows])), cells // len(rows)).bit_length() - 1)
    counts = np.zeros((len(rows), width), np.uint32)
    for n, r in enumerate(rows):
        x = r.astype(np.uint64)
        x = mix(x if run == 1 else x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:])
        counts[n] = np.bincount((x & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return counts


def common_counts(counts: np.ndarray, i: np.ndarray, j: np.ndarray, cells: int = 1 << 20) -> np.ndarray:
    """Of rows i and j each no fewer words, or pairs of words, than they have in common: what shares one long passage only
    is told from near copies without an alignment."""
    step = max(1, cells // counts.shape[1])
    return np.concatenate([np.minimum(counts[i[k : k + step]], counts[j[k : k + step]]).sum(1, dtype=np.int64) for k in range(0, len(i), step)] or [np.zeros(0, np.int64)])


def task_links(rows: list[np.ndarray], similarity: float, edit: float) -> list[tuple[int, int]]:
    """A spanning forest of the links among the rows (words) of one task."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    labels, where = kmer_labels(np.concatenate(rows).astype(np.uint64), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
    sizes = np.diff(where)
    kmers = np.split(labels, where[1:-1])
    links = []

    def link(i, j, may=None, block=1 << 13):
        """Verify these pairs in order, but those that are in one class by then and those that may not be linked."""
        while len(i):
            root = np.array([find(n) for n in range(len(rows))])
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            x, y = i[:block], j[:block]
            if may and len(x):
                held = may(x, y)
                x, y = x[held], y[held]
            for a, b in zip(x.tolist(), y.tolist()):
                p, q = find(a), find(b)
                if p != q and aligned(rows[a], rows[b], kmers[a], kmers[b], similarity, edit):
                    parent[max(p, q)] = min(p, q)
                    links.append((a, b))
            i, j = i[block:], j[block:]

    if len(rows) == 2:
        link(np.array([0]), np.array([1]))
        return links
    values, column = np.unique(labels, return_inverse=True)
    often = np.bincount(column, minlength=len(values)) > 1
    number = np.where(often, np.cumsum(often) - 1, -1)[column]
    owner = np.repeat(np.arange(len(rows)), sizes)
    owner, number = owner[number >= 0], number[number >= 0]
    both = np.zeros((len(rows), len(rows)), np.float32)
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    width = 4096
    for lo in range(0, int(often.sum()), width):
        x, y = np.searchsorted(number, [lo, lo + width])
        holds = np.zeros((len(rows), width), np.float32)
        holds[owner[x:y], number[x:y] - lo] = 1
        both += holds @ holds.T
    close = both >= similarity * (sizes[:, None] + sizes - both) - 1e-3
    longer = np.maximum(sizes[:, None], sizes) + KMER - 1
    most = np.floor((1 - edit) * longer + 1e-9)  # a word that differs costs at most KMER k-mers and two pairs of words
    unsure = ~close & (both >= longer - KMER + 1 - KMER * most)
    i, j = np.nonzero(np.triu(close, 1))
    best = np.argsort(-both[i, j], kind="stable")
    link(i[best], j[best])
    i, j = np.nonzero(np.triu(unsure, 1))
    best = np.argsort(-both[i, j], kind="stable")
    counts: dict[int, np.ndarray] = {}

    def may(x, y):
        """Whether enough pairs of words, and enough words, are common: a word that differs costs one word of the longer text."""
        held = np.arange(len(x))
        for run in (2, 1):
            if len(held):
                counts[run] = counts[run] if run in counts else word_counts(rows, run)
                p, q = x[held], y[held]
                held = held[common_counts(counts[run], p, q) >= longer[p, q] - run + 1 - run * most[p, q]]
        return held

    link(i[best], j[best], may)
    return links


def _verify(similarity: float, edit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nodes, rows = None, [], []
        found: list[tuple[bytes, bytes]] = []

        def close():
            found.extend((nodes[i], nodes[j]) for i, j in task_links(rows, similarity, edit))

        for batch in batches:
            for t, n, w in zip(*(batch.column(c).to_pylist() for c in ("task", "node", "words"))):
                if t != task:
                    if len(rows) > 1:
                        close()
                    task, nodes, rows = t, [], []
                nodes.append(n)
                rows.append(np.frombuffer(w, np.uint32))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])
                found.clear()
        if len(rows) > 1:
            close()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])

    return run


def _as_tasks(groups: DataFrame) -> DataFrame:
    """task, node: the groups of nodes, those with the same nodes once."""
    tasks = groups.withColumn("task", F.md5(F.concat_ws("", F.transform("nodes", F.hex)).cast("binary"))).dropDuplicates(["task"])
    return tasks.select("task", F.explode("nodes").alias("node"))


def _chunks(members: DataFrame, *of: str) -> DataFrame:
    return members.groupBy("band", "key", *of).agg(F.array_sort(F.collect_list("node")).alias("nodes"))


def first_tasks(members: DataFrame, task_rows: int) -> tuple[DataFrame, DataFrame]:
    """The buckets of up to task_rows nodes whole; of a larger one each chunk beside the bucket's first chunk. Also band,
    key, node of the larger ones."""
    chunk = F.when(F.col("cuts") > 1, F.pmod(F.xxhash64("node"), F.col("cuts").cast("bigint"))).otherwise(0).cast("int")
    chunks = materialize(_chunks(members.withColumn("chunk", chunk), "cuts", "chunk"), "near-chunks")
    large = chunks.filter("cuts > 1")
    lead = large.groupBy("band", "key").agg(F.min_by("nodes", "chunk").alias("lead"))
    beside = F.array_sort(F.array_union("nodes", F.coalesce("lead", F.array().cast("array<binary>"))))
    return _as_tasks(chunks.join(lead, ["band", "key"], "left").select(beside.alias("nodes"))), large.select("band", "key", F.explode("nodes").alias("node"))


def rest_tasks(large: DataFrame, roots: DataFrame, task_rows: int) -> DataFrame:
    """Of the large buckets the chunks of different classes beside each other: whatever is already linked to the same
    root needs no further link. A class of half a task or more has chunks of its own, the others share chunks."""
    placed = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("n") * 2 >= task_rows
    buckets = sizes.groupBy("band", "key").agg(F.count(F.lit(1)).alias("classes"), F.sum(F.when(~own, F.col("n"))).alias("shared")).filter("classes > 1")
    cut = sizes.join(buckets, ["band", "key"]).select("band", "key", "root", F.when(own, F.col("root")).alias("class"), F.ceil(F.when(own, F.col("n")).otherwise(F.col("shared")) / task_rows).alias("cuts"))
    members = placed.join(cut, ["band", "key", "root"]).withColumn("chunk", F.pmod(F.when(F.col("class").isNotNull(), F.xxhash64("node")).otherwise(F.xxhash64("root")), "cuts"))
    chunks = materialize(_chunks(members, "class", "chunk"), "near-chunks")
    left, right = (chunks.select("band", "key", *[F.col(c).alias(c + e) for c in ("class", "chunk", "nodes")]) for e in "12")
    after = F.struct(F.coalesce("class1", F.lit(b"")), "chunk1") < F.struct(F.coalesce("class2", F.lit(b"")), "chunk2")
    other = F.col("class1").isNull() | ~F.col("class1").eqNullSafe(F.col("class2"))
    pairs = left.join(right, ["band", "key"]).filter(after & other).select(F.concat("nodes1", "nodes2").alias("nodes"))
    single = chunks.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n = 1")  # others meet beside a second chunk
    alone = chunks.filter("class IS NULL AND size(nodes) > 1").join(single, ["band", "key"], "left_semi")
    return _as_tasks(pairs.unionByName(alone.select("nodes")))


def find_links(nodes: DataFrame, words: DataFrame, similarity: float, edit: float, task_rows: int) -> DataFrame:
    """a, b: links that connect all classes of the candidates. words may repeat a node."""

    def verified(tasks: DataFrame, words: DataFrame) -> DataFrame:
        rows = tasks.join(words.dropDuplicates(["node"]), "node").repartition("task").sortWithinPartitions("task", "node")
        return materialize(rows.mapInArrow(_verify(similarity, edit), "a binary, b binary"), "near-links")

    bands = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = bands.join(sizes, ["band", "key"]).withColumn("cuts", F.ceil(F.col("n") / task_rows).cast("int")).drop("n")
    tasks, large = first_tasks(members, task_rows)
    links = verified(tasks, words)
    if large.isEmpty():
        return links
    rest = rest_tasks(large, components(links, early=3), task_rows)
    wanted = bounded_broadcast(rest.select("node").distinct(), REST_NODES)  # few as a rule: then only their words are dealt out again
    return links.unionByName(verified(rest, words.join(wanted, "node", "left_semi")))


def components(links: DataFrame, most_rounds: int = 60, early: int = 0) -> DataFrame:
    """node, root for all linked nodes, by alternating large-star and small-star rounds. With early, what so many rounds
    have joined: nodes of one root are connected, but a class may still have several roots."""
    edges = materialize(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-edges")
    state = None
    for done in range(1, most_rounds + 1):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v")).filter("u != v").distinct()
        edges = materialize(small, "near-edges")
        if done == early:
            return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _classes(docs: DataFrame, similarity: float, edit: float, bands: int, task_rows: int) -> tuple[DataFrame, DataFrame]:
    """Per row its node; per node its class, and of that the doc_id and text_hash of the row that stays (the least id,
    null last)."""
    text = no_clash(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    table = materialize(text.mapInArrow(_nodes(bands), "doc_id bigint, text_hash bigint, node binary, words binary, bands array<bigint>"), "near-nodes")
    nodes = table.filter("bands IS NOT NULL")
    links = find_links(nodes.select("node", "bands").dropDuplicates(["node"]), nodes.select("node", "words"), similarity, edit, task_rows)
    roots = components(links)
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    own = table.groupBy("node").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"))
    placed = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = placed.groupBy("root").agg(F.min("first").alias("stays"), F.sum("copies").alias("class_size"))
    return table, placed.join(classes, "root").select("root", "node", "copies", "stays", "class_size")


def near_classes(docs: DataFrame, similarity: float = 0.8, edit: float = 0.9, bands: int = BANDS, task_rows: int = 1024) -> DataFrame:
    """Per row: doc_id, class_id (least doc_id of the class), class_size (documents), copies (documents with the same
    words), kept (whether it is the one of its class that stays)."""
    table, of_node = _classes(docs, similarity, edit, bands, task_rows)
    of_node = of_node.select("node", "copies", F.col("stays.doc_id").alias("class_id"), "class_size")
    return table.select("doc_id", "node").join(of_node, "node").select(
        "doc_id", "class_id", "class_size", "copies", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def near_dedup(docs: DataFrame, similarity: float = 0.8, edit: float = 0.9, bands: int = BANDS, task_rows: int = 1024) -> DataFrame:
    """One row of docs of each class, with all its columns."""
    _, of_node = _classes(docs, similarity, edit, bands, task_rows)
    return rows_of_texts(docs, of_node.select("stays.doc_id", "stays.text_hash"), F.xxhash64("text"))
