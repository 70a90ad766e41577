"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix with its transpose.

A document's row holds its distinct n-gram shingles. Two documents link when their overlap is at least ``percent`` of
their union. What is computed of the product:

1. Equal rows are one node, whatever their number.
2. Size-derived bounds leave out columns: under any one order of all columns, two linked rows share a column among the
   first ``size - ceil(size * percent / 100) + 1`` of each. Columns in few rows come first in the order, which is kept as
   a table of ``1 << 20`` counters, summed over all documents, and then the column's hash. The order decides only how much
   is to be done, not what is found.
3. A column's entries are a bucket, cut by size where no row on one side can link with one on the other. An entry alone
   goes, and so do two whose places in the order leave too few columns to be common (the first common column of two
   linked rows never does).
4. A row's signature holds, for each of 0.5 to 1 bits a column, whether an odd number of its columns fall there. Two
   signatures differ in no more bits than the rows do in columns, so a pair whose signatures differ in more than a linked
   pair may is left; rows that share a column by chance are told apart without being sent.
5. A first round takes a row's two rarest shared columns only; the rows of a bucket go to tasks of at most about
   ``task_rows`` rows, a larger bucket's chunks each beside its first one. Rows with a signature like another's in the task
   are verified: the product is worked out in blocks of rows by blocks of columns; a block of row pairs goes as soon as
   the counts so far and the columns still to come stay below the pair's bound, and only a spanning forest of links leaves
   a task. These links join most copies into classes.
6. Of all buckets, what stays open are pairs of different classes. Where few rows stand outside the largest class of a
   bucket (``loose``), their pairs are compared by size, place and signature; where many do, chunks of different classes
   meet in tasks as in the first round, with signatures alone. What these pairs connect is a group, whatever the number of
   its buckets; in it chunks of different classes meet to be verified. (A bucket, or a group, with many rows of many
   classes costs its size times its number of chunks; the bucket in signatures.) No pair that links is lost, and copies
   are never expanded into all pairs.

Only rows that a task asks for are sent to be verified: texts are read again for it, and what tasks ask for is broadcast
if it has been counted to hold at most ``most_broadcast`` rows; else rows are first held against a bit map of the nodes
asked for (16 MB at most), then joined by exchange. Shingles are compared by 64-bit hashes. Node tables, tasks, links and
rounds are written to the shared folder.

Edge cases: null text or text without words is an empty row, linked with nothing and its own component; a text of fewer
than n words is one shingle, its whole sequence; repeated rows are one node; a null doc_id names a component only if the
component has no other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import UPPER_TO_LOWER, VISIBLE_BYTE, bounded_broadcast, materialize, mix, no_clash, runs, span_hashes, steps, utf8_bytes
from .near_dedup import components, first_tasks, rest_tasks

N, PERCENT = 4, 85
SLOT_BITS, SLOT_CHUNKS = 20, 16
#: Bits of the map of nodes that tasks ask for.
WANTED_BITS = 27
ROWS, COLUMNS = 256, 4096


def shingle_sets(text: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all rows, one row after the other, and the rows' offsets in them."""
    data, offsets = utf8_bytes(text)
    data = UPPER_TO_LOWER[data]
    starts, ends, of_row = runs(VISIBLE_BYTE[data], offsets)
    words = span_hashes(data, starts, ends)
    counts = np.diff(of_row)
    counts = np.where(counts > 0, np.maximum(1, counts - n + 1), 0)
    where = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    at = of_row[row] + np.arange(where[-1]) - where[row]
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    h = np.zeros(len(at), np.uint64)
    for j in range(n):
        h = h * np.uint64(0xD6E8FEB86659FD93) + np.where(at + j < of_row[row + 1], padded[at + j], np.uint64(j + 1))
    h = mix(h)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(counts)))]).astype(np.int64)


def _nodes(h: np.ndarray, where: np.ndarray) -> list[bytes | None]:
    raw = h.tobytes()
    return [xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) if b > a else None for a, b in zip(where[:-1].tolist(), where[1:].tolist())]


def signatures(h: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the parities of how many of its columns fall on each bit, as 64-bit words, and the offsets of the rows in
    them. A row has a power of two of words, a bit for one column or two."""
    size = np.diff(where)
    words = np.where(size > 0, 1 << np.ceil(np.log2(np.maximum(size, 128) / 128)).astype(np.int64), 0)
    start = np.concatenate([[0], np.cumsum(words)])
    row = np.repeat(np.arange(len(size)), size)
    bit = 64 * start[row] + (h & (64 * words[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(bit, minlength=64 * start[-1]) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8"), start


def _rows(n: int):
    """A row for each document, and for each task one for each chunk of the counters."""

    def row(doc_id, node, size, sign=None, chunk=None, counts=None):
        none = lambda x, kind: pa.nulls(len(size), kind) if x is None else x
        return pa.RecordBatch.from_arrays([none(doc_id, pa.int64()), none(node, pa.binary()), size, none(sign, pa.list_(pa.int64())), none(chunk, pa.int32()), none(counts, pa.binary())], names=["doc_id", "node", "n_shingles", "sign", "chunk", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in steps(batches):
            h, where = shingle_sets(batch.column("text"), n)
            total += np.bincount((h >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(total))
            sign, start = signatures(h, where)
            yield row(batch.column("doc_id"), pa.array(_nodes(h, where), pa.binary()), pa.array(np.diff(where)), pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(sign)))
        if total.any():
            parts = total.reshape(SLOT_CHUNKS, -1)
            kind = np.uint32 if parts.max() < 1 << 32 else np.uint64
            yield row(None, None, pa.nulls(SLOT_CHUNKS, pa.int64()), None, pa.array(range(SLOT_CHUNKS), pa.int32()), pa.array([x.astype(kind).tobytes() for x in parts], pa.binary()))

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = (1 << SLOT_BITS) // SLOT_CHUNKS
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            raw = raw.as_buffer()
            counts = np.frombuffer(raw, np.uint32 if raw.size == 4 * width else np.uint64)
            total[chunk] = total.get(chunk, np.zeros(width, np.int64)) + counts.astype(np.int64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.minimum(np.rint(8 * np.log2(x + 1)), 255).astype(np.uint8).tobytes() for x in total.values()])], names=["chunk", "counts"])


def column_levels(slots: DataFrame) -> np.ndarray:
    """How frequent the columns of each slot are together, in eighths of a power of two: 1 MB, whatever the input's size."""
    parts = slots.repartition(SLOT_CHUNKS, "chunk").mapInArrow(_summed, "chunk int, counts binary").collect()
    levels = np.zeros((SLOT_CHUNKS, (1 << SLOT_BITS) // SLOT_CHUNKS), np.uint8)
    for r in parts:
        levels[r.chunk] = np.frombuffer(r.counts, np.uint8)
    return levels.ravel()


def _prefixes(n: int, percent: int, levels):
    """key, node, at: the first columns of each row in the order; at holds the row's size (upper half) and the column's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in steps(batches):
            h, where = shingle_sets(batch.column("text"), n)
            nodes = _nodes(h, where)
            fresh = {x: i for i, x in reversed(list(enumerate(nodes)))}
            size = np.diff(where)
            row = np.repeat(np.arange(len(size)), size)
            h = h[np.lexsort((h, level[(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], row))]
            place = np.arange(len(h)) - where[row]
            first = size - (size * percent + 99) // 100 + 1
            own = np.array([x is not None and fresh[x] == i for i, x in enumerate(nodes)], bool)
            keep = (place < first[row]) & own[row] if len(row) else np.zeros(0, bool)
            row, h, place = row[keep], h[keep], place[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(nodes, pa.binary()).take(pa.array(row)), pa.array(size[row] << 32 | place)],
                names=["key", "node", "at"],
            )

    return run


def _slots(nodes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(x[:4] for x in nodes), np.uint32) >> np.uint32(32 - WANTED_BITS)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = np.unique(_slots(batch.column("node").to_pylist()))
        chunk = slot // ((1 << WANTED_BITS) // SLOT_CHUNKS)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (chunk, slot)], names=["chunk", "slot"])


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = (1 << WANTED_BITS) // SLOT_CHUNKS
    bits: dict[int, np.ndarray] = {}
    for batch in batches:
        chunk, slot = (batch.column(c).to_numpy() for c in ("chunk", "slot"))
        for c in np.unique(chunk).tolist():
            bits.setdefault(c, np.zeros(width, bool))[slot[chunk == c] - c * width] = True
    if bits:
        yield pa.RecordBatch.from_arrays([pa.array(list(bits), pa.int32()), pa.array([np.packbits(x).tobytes() for x in bits.values()])], names=["chunk", "bits"])


def wanted_map(tasks: DataFrame) -> np.ndarray:
    """A bit for each slot of nodes, set where the tasks ask for one: 16 MB, whatever their number."""
    parts = tasks.select("node").mapInArrow(_asked, "chunk int, slot int").repartition(SLOT_CHUNKS, "chunk").mapInArrow(_mapped, "chunk int, bits binary").collect()
    bits = np.zeros((SLOT_CHUNKS, (1 << WANTED_BITS) // SLOT_CHUNKS // 8), np.uint8)
    for r in parts:
        bits[r.chunk] = np.frombuffer(r.bits, np.uint8)
    return bits.ravel()


def _sets(n: int, wanted=None):
    """node, columns: each node once in what a task has read; with wanted (a map of nodes) hardly any others than those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in steps(batches):
            h, where = shingle_sets(batch.column("text"), n)
            nodes = _nodes(h, where)
            full = [i for i, x in enumerate(nodes) if x is not None]
            if wanted is not None and full:
                slot = _slots([nodes[i] for i in full])
                full = [i for i, held in zip(full, wanted.value[slot >> 3] << (slot & 7).astype(np.uint8) & 128) if held]
            own = []
            for i in full:
                x = nodes[i]
                if x not in seen:
                    seen.add(x)
                    own.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in own], pa.binary()), pa.array([h[where[i] : where[i + 1]].tobytes() for i in own], pa.binary())], names=["node", "columns"])

    return run


def linked_pairs(rows: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """The pairs of rows (sorted distinct columns) that link, by blocks of the product of the incidence matrix with its
    transpose."""
    if len(rows) == 2:
        both = len(np.intersect1d(*rows, assume_unique=True))
        if 100 * both >= percent * (len(rows[0]) + len(rows[1]) - both):
            yield 0, 1
        return
    sizes = np.array([len(r) for r in rows])
    by_size = np.argsort(sizes, kind="stable")
    sizes = sizes[by_size]
    values, column, often = np.unique(np.concatenate([rows[i] for i in by_size]), return_inverse=True, return_counts=True)
    number = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[column]
    owner = np.repeat(np.arange(len(rows)), sizes)[number >= 0]
    number = number[number >= 0]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    blocks = [(a, min(a + ROWS, len(rows))) for a in range(0, len(rows), ROWS)]
    # a smaller row must have at least that share of a larger one
    product = {(i, j): np.zeros((blocks[i][1] - blocks[i][0], blocks[j][1] - blocks[j][0]), np.float32) for j in range(len(blocks)) for i in range(j + 1) if 100 * sizes[blocks[i][1] - 1] >= percent * sizes[blocks[j][0]]}
    left = np.bincount(owner, minlength=len(rows)).astype(np.int64)  # columns still to come
    bound = {k: -(-percent * (sizes[slice(*blocks[k[0]]), None] + sizes[None, slice(*blocks[k[1]])]) // (100 + percent)) for k in product}
    for c in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        x, y = np.searchsorted(number, [c, c + COLUMNS])
        holds = np.zeros((len(rows), COLUMNS), np.float32)
        holds[owner[x:y], number[x:y] - c] = 1
        left -= np.bincount(owner[x:y], minlength=len(rows))
        for i, j in list(product):
            (a, b), (p, q) = blocks[i], blocks[j]
            both = product[i, j]
            both += holds[a:b] @ holds[p:q].T
            if (both + np.minimum(left[a:b, None], left[None, p:q]) < bound[i, j]).all():
                del product[i, j]
    for (i, j), both in product.items():
        u, v = np.nonzero(both >= bound[i, j])
        for a, b in zip((u + blocks[i][0]).tolist(), (v + blocks[j][0]).tolist()):
            if a < b:
                yield int(by_size[a]), int(by_size[b])


def _forest(rows: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for i, j in linked_pairs(rows, percent):
        x, y = find(i), find(j)
        if x != y:
            parent[max(x, y)] = min(x, y)
            links.append((i, j))
    return links


def _verify_tasks(percent: int):
    """a, b: a spanning forest of the links within each task; the rows of a task stand one after the other, and a row that
    several tasks have read counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nodes, rows = None, [], []

        def close():
            found = [(nodes[i], nodes[j]) for i, j in _forest(rows, percent)] if len(rows) > 1 else []
            return [pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])] if found else []

        for batch in batches:
            for t, node, columns in zip(*(batch.column(c) for c in ("task", "node", "columns"))):
                if t.as_py() != task:
                    yield from close()
                    task, nodes, rows = t.as_py(), [], []
                if nodes and nodes[-1] == node.as_py():
                    continue
                nodes.append(node.as_py())
                rows.append(np.frombuffer(columns.as_py(), np.uint64))
        yield from close()

    return run


def like_pairs(sizes: np.ndarray, signs: list[np.ndarray], percent: int, cells: int = 1 << 21) -> np.ndarray:
    """Which pairs of rows have signatures (unsigned words) so like each other that they could be linked: rows x rows."""
    like = np.zeros((len(sizes), len(sizes)), bool)
    words = np.array([len(x) for x in signs])
    for w in np.unique(words).tolist():
        of = np.flatnonzero(words == w)
        one = np.stack([signs[i] for i in of])
        longer = np.flatnonzero((words > w) & (words * percent <= 200 * w))  # any more words, and the row is too large
        other = np.concatenate([of, longer])
        two = np.concatenate([one, *(np.bitwise_xor.reduce(signs[i].reshape(-1, w))[None] for i in longer)])
        step = max(1, cells // (len(other) * w))
        for k in range(0, len(of), step):
            at = of[k : k + step]
            a, b = sizes[at, None], sizes[None, other]
            differ = np.bitwise_count(one[k : k + step, None] ^ two[None]).sum(-1, dtype=np.int64)
            like[np.ix_(at, other)] = (differ * (100 + percent) <= (100 - percent) * (a + b)) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
    like |= like.T
    np.fill_diagonal(like, False)
    return like


def _firsts(like: np.ndarray) -> np.ndarray:
    """Of each row the first one that it is connected with."""
    first = np.arange(len(like))
    while True:
        least = np.minimum(first, np.where(like, first[None], len(like)).min(1))
        least = least[least]
        if (least == first).all():
            return first
        first = least


def _like(percent: int):
    """task, a, b: within each task, what rows with signatures like each other connect, as links with the first row of each
    connected group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nodes, sizes, signs = None, [], [], []
        found: list[tuple[int, bytes, bytes]] = []

        def close():
            if len(nodes) > 1:
                first = _firsts(like_pairs(np.array(sizes), signs, percent))
                found.extend((task, nodes[first[i]], nodes[i]) for i in np.flatnonzero(first != np.arange(len(first))).tolist())

        def batch_of():
            kinds = zip(zip(*found), (pa.int64(), pa.binary(), pa.binary()))
            return [pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in kinds], names=["task", "a", "b"])] if found else []

        for batch in batches:
            sign = batch.column("sign")
            flat, where = sign.flatten().to_numpy().view(np.uint64), (sign.offsets.to_numpy() - sign.offsets[0].as_py()).tolist()
            for i, (t, node, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("task", "node", "size")))):
                if t != task:
                    close()
                    task, nodes, sizes, signs = t, [], [], []
                if nodes and nodes[-1] == node:
                    continue
                nodes.append(node)
                sizes.append(size)
                signs.append(flat[where[i] : where[i + 1]].copy())
            yield from batch_of()
            found.clear()
        close()
        yield from batch_of()

    return run


def _differ(a: Column, b: Column) -> Column:
    """In how many bits two signatures differ at least, one of them folded if it has twice the words; 0 if it has more."""

    def folded(x, other):
        half = F.floor(F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(other), F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    bits = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int"))
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda x, y: x + y), F.lit(0))


def shared_columns(index: DataFrame, percent: int) -> DataFrame:
    """key, node, size, place, n: the entries (key, node, at) that share a column with one that their row could be linked
    with, each once; n entries have this key."""
    order = W.partitionBy("key").orderBy("at", "node")
    once = index.repartition("key").withColumn("twin", F.lag("node").over(order)).filter("twin IS NULL OR twin != node")
    sized = once.select("key", "node", "at", F.shiftright("at", 32).alias("size"))
    near = sized.withColumns({"before": F.lag("size").over(order), "after": F.lead("size").over(order)})
    fits = lambda small, large: F.coalesce(F.col(small) * 100 >= F.col(large) * percent, F.lit(False))
    near = near.withColumn("first", (~fits("before", "size")).cast("int")).filter((F.col("first") == 0) | fits("size", "after"))
    runs = near.select("key", "node", "size", (F.col("at") - F.shiftleft("size", 32)).alias("place"), F.sum("first").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("run"))
    run = W.partitionBy("key", "run")
    counted = runs.withColumns({"n": F.count(F.lit(1)).over(run), "sizes": F.sum("size").over(run), "left": F.min(F.col("size") - F.col("place")).over(run)})
    held = counted.filter((F.col("n") > 2) | (F.col("left") * (100 + percent) >= F.col("sizes") * percent))
    return held.select(F.xxhash64("key", "run").alias("key"), "node", "size", "place", "n")  # two that meet by chance cost work only


def _cuts(n: Column, task_rows: int) -> Column:
    return F.ceil(n / task_rows).cast("int")


def find_links(docs: DataFrame, slots: DataFrame, signs: DataFrame, n: int, percent: int, task_rows: int, loose: int, seeds: int = 2, most_broadcast: int = 1_000_000) -> DataFrame:
    """a, b: links that connect whatever the join connects. signs: node, size, sign."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(column_levels(slots))
    index = docs.mapInArrow(_prefixes(n, percent, levels), "key bigint, node binary, at bigint")
    members = materialize(shared_columns(index, percent).withColumn("band", F.lit(0)), "jaccard-members")

    def like(tasks: DataFrame) -> DataFrame:
        rows = tasks.select(F.xxhash64("task").alias("task"), "node").join(signs, "node")
        return rows.repartition("task").sortWithinPartitions("task", "node").mapInArrow(_like(percent), "task bigint, a binary, b binary")

    def verified(tasks: DataFrame) -> DataFrame:
        tasks = materialize(tasks, "jaccard-tasks")
        few = bounded_broadcast(tasks, most_broadcast)
        wanted = spark.sparkContext.broadcast(wanted_map(tasks)) if few is tasks else None
        sets = docs.mapInArrow(_sets(n, wanted), "node binary, columns binary")
        rows = (sets if few is not tasks else sets.dropDuplicates(["node"])).join(few, "node").repartition("task").sortWithinPartitions("task", "node")
        return materialize(rows.mapInArrow(_verify_tasks(percent), "a binary, b binary"), "jaccard-links")

    rare = members.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "place", "key"))), 1, seeds).alias("first"))
    seeded = rare.select("node", F.explode("first").alias("f")).select(F.lit(0).alias("band"), F.col("f.key").alias("key"), "node")
    seeded = materialize(seeded.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key"))).filter("n > 1").withColumn("cuts", _cuts(F.col("n"), task_rows)).drop("n"), "jaccard-seeds")
    seed_tasks, _ = first_tasks(seeded, task_rows)  # larger buckets are met again with all others below
    links = verified(like(seed_tasks).select("task", F.explode(F.array("a", "b")).alias("node")).distinct())

    roots = materialize(components(links, early=3), "jaccard-roots")
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    buckets = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("main")).filter("classes > 1")
    outside = F.col("all") - F.col("main.n")
    open_ = materialize(placed.drop("n").join(buckets.select("key", F.col("main.root").alias("main"), outside.alias("outside")), "key"), "jaccard-open")

    few = open_.filter(F.col("outside") <= loose).join(signs.select("node", "sign"), "node")
    side = lambda df, e: df.select("key", *[F.col(c).alias(c + e) for c in ("node", "root", "main", "size", "place", "sign")])
    pairs = side(few.filter("root != main"), "_a").join(side(few, "_b"), "key").filter("root_a != root_b AND (root_b = main_b OR node_a < node_b) AND least(size_a, size_b) * 100 >= greatest(size_a, size_b) * " + str(percent))
    sizes = F.col("size_a") + F.col("size_b")
    placed_well = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) * (100 + percent) >= sizes * percent
    alike = F.when(placed_well, _differ(F.col("sign_a"), F.col("sign_b")) * (100 + percent) <= sizes * (100 - percent)).otherwise(False)
    likely = pairs.filter(alike).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    many = open_.filter(F.col("outside") > loose).select("band", "key", "node")
    if many.head(1):
        likely = likely.unionByName(like(rest_tasks(many, roots, task_rows)).select("a", "b"))
    groups = components(likely).select(F.lit(0).alias("band"), F.col("root").alias("key"), F.explode(F.array("node", "root")).alias("node")).distinct()
    tasks = rest_tasks(groups, roots, task_rows).select(F.xxhash64("task").alias("task"), "node")
    return links.unionByName(verified(tasks))


def jaccard_classes(docs: DataFrame, n: int = N, percent: int = PERCENT, task_rows: int = 1024, loose: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id of all that links connect with the document, its own included)."""
    text = no_clash(docs, "doc_id", "text")
    read = materialize(text.mapInArrow(_rows(n), "doc_id bigint, node binary, n_shingles bigint, sign array<bigint>, chunk int, counts binary"), "jaccard-rows")
    table, slots = read.filter("chunk IS NULL").select("doc_id", "node", "n_shingles"), read.filter("chunk IS NOT NULL").select("chunk", "counts")
    of_node = [F.min("doc_id").alias("least"), F.first("n_shingles").alias("size"), F.first("sign").alias("sign")]
    own = materialize(read.filter("node IS NOT NULL").groupBy("node").agg(*of_node), "jaccard-nodes")
    roots = components(find_links(text.select("text"), slots, own.select("node", "size", "sign"), n, percent, task_rows, loose))
    placed = own.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    joined = table.filter("node IS NOT NULL").join(least, "node").select("doc_id", "n_shingles", "component_id")
    return joined.unionByName(table.filter("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
