"""LM scoring with a probabilistic suffix tree over words.

A text is its words (lower-cased A-Z) and one end; the symbol before a text is the end. Contexts are the last one to
three symbols. A context is retained if its next-symbol distribution over all training rows diverges from its suffix's:
the leave-one-out log likelihood gain of its counts over the suffix's must reach ``divergence`` nats (so a context seen
once, of which nothing is left, is not). Nothing else is cut: the tree grows with the corpus. Counts are smoothed by
absolute discounting, and what is discounted goes to the suffix's distribution, the root's (words alone) into one symbol
for all unknown words, as the base has it; the discount is estimated from the words that occur once and twice. Each
symbol is predicted by the longest suffix of its history that is retained.

Neither word counts nor the tree fit on one machine, so both are exchanged, never collected or broadcast:

1. texts are read in blocks, which are written to a table bucketed by block, so that they need not be shuffled again;
   each block sends its distinct words (64-bit hashes) by hash bucket with their training counts; a bucket numbers its
   words, adds up the counts and answers each block;
2. each block sends its distinct word sequences (three of context, one symbol) as numbers, exactly, with their training
   counts, to the bucket of the last word. There all successors of a context meet: the bucket adds up the counts of all
   three depths, tests each context and works out the probability of each sequence;
3. buckets answer each block, and the block scores its documents.

A frequent last word would fill its bucket. The sequences of such a *heavy* word go to the bucket of the last two words,
or of all three if the last two are heavy. Their shorter contexts, whose successors are then in many buckets, are counted
and tested beforehand by plain aggregation over (context, symbol), which is spread evenly; the sequences carry the result
along. So no task receives more than a bounded share, and a word that makes up a third of all tokens is no exception.

Edge cases: null text is empty, and an empty text is one end token; with no training rows every symbol is unknown and
scores 0; rows that repeat are scored alike; null doc_ids are never held out; an empty table gives an empty result;
columns of other names are ignored; a text of any length is read whole (one that exceeds a block is a block).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER_TO_LOWER, VISIBLE_BYTE, bounded_broadcast, materialize, mix, no_clash, runs, shared_folder, span_hashes, steps, utf8_bytes

DEPTH = 3
END = np.uint64(0x5851F42D4C957F2D)
BLOCK_BYTES = 9 << 20
WORD_BUCKET_BYTES = 64 << 20
GRAM_BUCKET_BYTES = 4 << 20
#: A word is heavy from so many occurrences on: as many sequences a task holds at most besides its bucket's share.
HEAVY_FROM = 1 << 21
TEST_DISCOUNT = 0.7
#: Scores travel as fixed-point numbers of three bytes.
SCORE_UNIT = 1 << 20
BLOCKS = "block bigint, vocabulary binary, words binary, ids array<bigint>, tokens array<bigint>"
_BLOCKS = pa.schema([("block", pa.int64()), ("vocabulary", pa.binary()), ("words", pa.binary()), ("ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])
WORDS, FACTS, HEAVY, SCORES = 0, 1, 2, 3
#: Answers to a block: of words (numbers, training counts, heavy ones), of heavy contexts (test and final probability), of sequences.
ANSWERS = "kind int, block bigint, bucket int, a binary, b binary, c binary, w1 bigint, w2 bigint, s bigint, q double, p double"
_GRAMS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("depth", pa.int32()), *((c, pa.binary()) for c in ("w1", "s", "w2", "w3", "n", "times", "q", "p"))])
GRAMS = "bucket int, block bigint, depth int, w1 binary, s binary, w2 binary, w3 binary, n binary, times binary, q binary, p binary"
_ASKED = pa.schema([("block", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("s", pa.int64()), ("n", pa.int64()), ("times", pa.int64())])
ASKED = "block bigint, w1 bigint, w2 bigint, s bigint, n bigint, times bigint"


def is_held(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i in ids], bool)


def symbols_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, each row followed by END, and the rows' offsets in them."""
    data, offsets = utf8_bytes(text)
    data = UPPER_TO_LOWER[data]
    starts, ends, of_row = runs(VISIBLE_BYTE[data], offsets)
    rows = len(of_row) - 1
    out = np.full(len(starts) + rows, END, np.uint64)
    out[np.arange(len(starts)) + np.repeat(np.arange(rows), np.diff(of_row))] = span_hashes(data, starts, ends)
    return out, of_row + np.arange(rows + 1)


def to_bytes(numbers: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes, as many as the largest takes, and how many numbers they are."""
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(numbers).to_bytes(7, "little") + bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def from_bytes(data) -> np.ndarray:
    data = memoryview(data)
    n, width = int.from_bytes(data[:7], "little"), data[7]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel().astype(np.uint64)


def steps_of(numbers: np.ndarray) -> np.ndarray:
    """Each number less the one before it (modulo 2^64)."""
    return np.diff(numbers.astype(np.uint64), prepend=np.uint64(0))


def sums_of(numbers: np.ndarray) -> np.ndarray:
    return np.cumsum(numbers, dtype=np.uint64)


def floats(numbers: np.ndarray) -> bytes:
    return numbers.astype("<f4").tobytes()


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


class _Block:
    def __init__(self, number: int):
        self.number, self.bytes, self.ids, self.symbols, self.lengths = number, 0, [], [], []

    def add(self, batch: pa.RecordBatch):
        symbols, offsets = symbols_of(batch.column("text"))
        self.ids += batch.column("doc_id").to_pylist()
        self.symbols.append(symbols)
        self.lengths.append(np.diff(offsets))
        self.bytes += batch.column("text").nbytes

    def close(self) -> pa.RecordBatch:
        """Words are numbered by falling frequency in the block, equally frequent ones by hash."""
        hashes, word, times = np.unique(np.concatenate(self.symbols), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        row = {"block": self.number, "vocabulary": to_bytes(steps_of(hashes[order])), "words": to_bytes(rank[word]), "ids": self.ids, "tokens": np.concatenate(self.lengths).tolist()}
        return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of BLOCK_BYTES of text, within a task."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 24
    block = None
    for batch in steps(batches):
        block = block or _Block(number)
        block.add(batch)
        if block.bytes >= BLOCK_BYTES:
            yield block.close()
            block, number = None, number + 1
    if block:
        yield block.close()


class Tokens:
    """A block's documents and words; with the answers also the words' numbers, training counts and which are heavy."""

    def __init__(self, row: dict):
        pa.default_memory_pool().release_unused()  # what the worker's earlier blocks held
        self.block, self.ids, self.lengths = row["block"], row["ids"], np.array(row["tokens"], np.int64)
        self.vocabulary, self.word = sums_of(from_bytes(row["vocabulary"])), from_bytes(row["words"]).astype(np.int32)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.learn = np.repeat(~is_held(self.ids), self.lengths)

    def buckets(self, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        bucket = (mix(self.vocabulary) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            yield b, order[edges[b] : edges[b + 1]]

    def answered(self, answers: pa.Table, buckets: int) -> Tokens:
        rows = {r["bucket"]: r for r in answers.filter(pc.equal(answers["kind"], WORDS)).select(["bucket", "a", "b", "c"]).to_pylist()}
        self.number, self.count, self.heavy = np.zeros(len(self.vocabulary), np.uint32), np.zeros(len(self.vocabulary), np.int64), np.zeros(len(self.vocabulary), bool)
        for b, own in self.buckets(buckets):
            self.number[own], self.count[own] = from_bytes(rows[b]["a"]), from_bytes(rows[b]["b"])
            self.heavy[own] = np.unpackbits(np.frombuffer(rows[b]["c"], np.uint8), count=len(own)).astype(bool)
        return self

    def history(self) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """The number of each symbol, and of the one, two, three symbols before it (0: nothing) their numbers and weights."""
        end = np.flatnonzero(self.vocabulary == END)
        before, words, heavy = self.word, [], []
        end = end.astype(np.int32)
        place = np.minimum(np.arange(len(self.word)) - np.repeat(self.offsets[:-1], self.lengths), DEPTH).astype(np.int8)
        for back in range(DEPTH):
            before = np.concatenate([end, before[:-1]])
            before[place == back] = end[0]
            words.append(np.where(place >= back, self.number[before], np.uint32(0)))
            heavy.append(self.heavy[before] & (place >= back))
        return self.number[self.word], words, heavy


class Grams:
    """The distinct sequences of a block (context of three, symbol) in the order of their buckets, and within a bucket of
    depth (of the bucket's contexts), last word, symbol, the word before and the one before that."""

    def __init__(self, tokens: Tokens, buckets: int):
        s, (w1, w2, w3), (h1, h2, _) = tokens.history()
        depth = 1 + h1.astype(np.uint32) + (h1 & h2)
        route, wide = w1.astype(np.uint64), np.uint64
        for least, words in ((2, w2), (3, w3)):
            at = np.flatnonzero(depth >= least)
            route[at] = mix(route[at] * wide(3) + wide(least)) + words[at]
        cell = (mix(route) % wide(buckets)).astype(np.uint32) * np.uint32(4) + depth
        keys = (cell.astype(wide) << wide(32)) | w1, (s.astype(wide) << wide(32)) | w2
        del route
        order = np.lexsort((w3, keys[1], keys[0]))
        first = changes(*(k[order] for k in (*keys, w3)))
        del keys
        self.of_token = np.empty(len(order), np.int32)
        self.of_token[order] = np.cumsum(first) - 1
        at = order[first]
        del order, first
        self.w1, self.s, self.w2, self.w3, self.cell = w1[at], s[at], w2[at], w3[at], cell[at]
        self.n = np.bincount(self.of_token[tokens.learn], minlength=len(at))
        self.times = tokens.count[tokens.word[at]]

    def cells(self) -> Iterator[tuple[int, int, slice]]:
        """Bucket, depth and the sequences of each bucket and depth."""
        first = np.flatnonzero(changes(self.cell))
        for lo, hi in zip(first.tolist(), np.append(first[1:], len(self.cell)).tolist()):
            yield int(self.cell[lo]) // 4, int(self.cell[lo]) % 4, slice(lo, hi)


def _send_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Tokens(row)
                trained, held = (np.bincount(tokens.word[x], minlength=len(tokens.vocabulary)) for x in (tokens.learn, ~tokens.learn))
                rows = [(tokens.block, b, to_bytes(steps_of(tokens.vocabulary[own])), to_bytes(trained[own]), to_bytes(held[own])) for b, own in tokens.buckets(buckets)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.binary()] * 3))], names=["block", "bucket", "a", "b", "c"])

    return run


def _answer_words(buckets: int, heavy_from: int):
    def run(table: pa.Table) -> pa.Table:
        hashes, trained, held = ([f(from_bytes(x.as_buffer())) for x in table[c]] for c, f in (("a", sums_of), ("b", np.asarray), ("c", np.asarray)))
        keys, of_word = np.unique(np.concatenate(hashes), return_inverse=True)
        count = np.bincount(of_word, np.concatenate(trained)).astype(np.int64)
        total = count + np.bincount(of_word, np.concatenate(held)).astype(np.int64)
        number, bucket = np.empty(len(keys), np.int64), table["bucket"][0].as_py()
        number[np.lexsort((keys, -total))] = np.arange(len(keys)) * buckets + bucket + 1
        heavy = total >= heavy_from
        # One more row: the bucket's training tokens, distinct ones, those that occur once and twice, heavy words.
        facts = np.array([count.sum(), (count > 0).sum(), (count == 1).sum(), (count == 2).sum(), heavy.sum()], np.int64)
        rows = [(WORDS, b, bucket, to_bytes(number[at]), to_bytes(count[at]), np.packbits(heavy[at]).tobytes()) for b, at in zip(table["block"].to_pylist(), np.split(of_word, np.cumsum([len(h) for h in hashes])[:-1]))]
        rows.append((FACTS, None, bucket, facts.tobytes(), None, None))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3))], names=["kind", "block", "bucket", "a", "b", "c"])

    return run


def heavy_sequences(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (heavy last word, symbol) and (heavy last two words, symbol) of a block: last word, the one before (0
    in the former), symbol, training count, and a token that has it."""
    s, (w1, w2, _), (h1, h2, _) = tokens.history()
    one, two = np.flatnonzero(h1), np.flatnonzero(h1 & h2)
    at = np.concatenate([one, two])
    before = np.concatenate([np.zeros(len(one), np.uint32), w2[two]])
    order = np.lexsort((s[at], before, w1[at]))
    at, before = at[order], before[order]
    first = changes(w1[at], before, s[at])
    n = np.bincount(np.cumsum(first) - 1, tokens.learn[at], minlength=int(first.sum())).astype(np.int64)
    return w1[at][first], before[first], s[at][first], n, at[first]


def _ask_heavy(buckets: int):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(blocks.to_pylist()[0]).answered(answers, buckets)
        w1, w2, s, n, at = heavy_sequences(tokens)
        columns = [np.full(len(n), tokens.block), *(x.astype(np.int64) for x in (w1, w2, s)), n, tokens.count[tokens.word[at]]]
        return pa.table([pa.array(c) for c in columns], schema=_ASKED)

    return run


def _send_grams(buckets: int, gram_buckets: int):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(blocks.to_pylist()[0]).answered(answers, buckets)
        grams = Grams(tokens, gram_buckets)
        heavy = answers.filter(pc.equal(answers["kind"], HEAVY))
        key = lambda w1, w2, s: mix(mix(w1.astype(np.uint64) + np.uint64(7)) + w2.astype(np.uint64)) * np.uint64(5) + s.astype(np.uint64)
        known = key(*(heavy[c].to_numpy() for c in ("w1", "w2", "s")))
        order = np.argsort(known)
        q, p = (heavy[c].to_numpy()[order] for c in "qp")
        rows = []
        for bucket, depth, own in grams.cells():
            row = {"bucket": bucket, "block": tokens.block, "depth": depth, "n": to_bytes(grams.n[own])}
            w1, s = grams.w1[own], grams.s[own]
            pair = changes(w1, s)
            row |= {"w1": to_bytes(steps_of(w1)), "s": to_bytes(np.where(changes(w1), s, steps_of(s))), "w2": to_bytes(grams.w2[own]), "w3": to_bytes(grams.w3[own])}
            if depth == 1:
                row["times"] = to_bytes(grams.times[own][pair])
            else:
                at = np.searchsorted(known[order], key(w1, grams.w2[own] * np.uint32(depth > 2), s))
                row |= {"q": floats(q[at]), "p": floats(p[at])}
            rows.append(row)
        return pa.Table.from_pylist(rows, schema=_GRAMS)

    return run


class Model:
    """What all steps know: the training tokens, distinct words, and the discount."""

    def __init__(self, total: int, distinct: int, once: int, twice: int, divergence: float):
        self.total, self.distinct, self.divergence = total, distinct, divergence
        self.discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def root(self, times):
        """Test (leave-one-out) and final probability of symbols by their training counts."""
        if not self.total:
            return np.ones(len(times)), np.ones(len(times))
        q = (np.maximum(times - 1 - TEST_DISCOUNT, 0) + TEST_DISCOUNT * self.distinct / self.total) / max(self.total - 1, 1)
        return q, np.where(times > 0, (times - self.discount) / self.total, self.discount * self.distinct / self.total)

    def next_level(self, q, p, n, context, real):
        """The probabilities one word deeper. q, p: those of the suffix; n: counts; context: number of each entry's
        context, of which all entries are here; real: whether that is a context at all (not before the text)."""
        size, kinds = np.bincount(context, n), np.bincount(context, n > 0)
        tested = real & (size[context] > 1)
        own = (np.maximum(n - 1 - TEST_DISCOUNT, 0) + TEST_DISCOUNT * kinds[context] * q) / np.maximum(size[context] - 1, 1)
        own = np.where(tested & (n > 0), own, q)
        gain = np.bincount(context, n * np.log(np.maximum(own, 1e-300) / q))
        kept = tested & (gain[context] >= self.divergence)
        return own, np.where(kept, (np.maximum(n - self.discount, 0) + self.discount * kinds[context] * p) / np.maximum(size[context], 1), p)


def _answer_grams(model: Model):
    """Adds up the sequences of a bucket and depth, tests their contexts, and answers each block."""

    def run(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the worker's earlier groups held
        parts, depth = table.to_pylist(), table["depth"][0].as_py()
        columns: dict[str, list] = {c: [] for c in ("front", "back", "n", "q", "p")}
        for part in parts:
            w1, s = sums_of(from_bytes(part["w1"])), from_bytes(part["s"])
            start, coded = np.flatnonzero(changes(w1)), s
            s = sums_of(s)
            s -= np.repeat(s[start] - coded[start], np.diff(np.append(start, len(s))))
            if depth == 1:
                q, p = (x[np.cumsum(changes(w1, s)) - 1] for x in model.root(from_bytes(part["times"]).astype(np.int64)))
            else:
                q, p = (np.frombuffer(part[c], "<f4") for c in "qp")
            values = (w1 << np.uint64(32)) | s, (from_bytes(part["w2"]) << np.uint64(32)) | from_bytes(part["w3"]), from_bytes(part["n"]).astype(np.int32), q.astype(np.float32), p.astype(np.float32)
            for c, x in zip(columns, values):
                columns[c].append(x)
            for c in ("w1", "s", "w2", "w3", "n", "times", "q", "p"):
                part[c] = None
        lengths = [len(x) for x in columns["n"]]
        front, back = (np.concatenate(columns.pop(c)) for c in ("front", "back"))
        order = np.lexsort((back, front))
        front, back = front[order], back[order]
        row = changes(front, back)
        of_row = np.empty(len(order), np.int32)
        of_row[order] = np.cumsum(row) - 1
        n = np.bincount(of_row, np.concatenate(columns.pop("n"))).astype(np.int32)
        at = order[row]
        q, p = (np.concatenate(columns.pop(c))[at].astype(float) for c in "qp")
        front, back = front[row], back[row]
        del order, row, at
        low = np.uint64(0xFFFFFFFF)
        w1, s, w2, w3 = ((front >> np.uint64(32)).astype(np.uint32), (front & low).astype(np.uint32), (back >> np.uint64(32)).astype(np.uint32), (back & low).astype(np.uint32))
        # Entries of each level are runs of rows: (w1, s), (w1, s, w2), (w1, s, w2, w3).
        two = np.unique((w1.astype(np.uint64) << np.uint64(32)) | w2, return_inverse=True)[1].astype(np.int32)
        three = np.unique((two.astype(np.uint64) << np.uint64(32)) | w3, return_inverse=True)[1].astype(np.int32)
        contexts = [(np.cumsum(changes(w1)) - 1).astype(np.int32), two, three]
        entries = [changes(front), changes(front, w2), np.ones(len(n), bool)]
        del front, back, w1, s
        for level in range(depth - 1, DEPTH):
            first = np.flatnonzero(entries[level])
            of_entry = np.cumsum(entries[level]) - 1
            count = np.add.reduceat(n, first)
            real = (w2, w3)[level - 1][first] != 0 if level else np.ones(len(first), bool)
            q, p = (x[of_entry] for x in model.next_level(q[first], p[first], count, contexts[level][first], real))
        score = to_score(p)
        rows = [(SCORES, x["block"], x["bucket"] * 4 + depth, to_bytes(score[at])) for x, at in zip(parts, np.split(of_row, np.cumsum(lengths)[:-1]))]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))], names=["kind", "block", "bucket", "a"])

    return run


def to_score(p: np.ndarray) -> np.ndarray:
    return np.round(-np.log10(np.clip(p, 1e-15, 1)) * SCORE_UNIT).astype(np.int64)


def _score_block(total: int, distinct: int, buckets: int, gram_buckets: int):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(blocks.to_pylist()[0]).answered(answers, buckets)
        grams = Grams(tokens, gram_buckets)
        scores = {r["bucket"]: r["a"] for r in answers.filter(pc.equal(answers["kind"], SCORES)).select(["bucket", "a"]).to_pylist()}
        known = np.zeros(len(grams.n))
        for bucket, depth, own in grams.cells():
            known[own] = -from_bytes(scores[bucket * 4 + depth]).astype(float) / SCORE_UNIT
        base = np.log10(tokens.count + 1) - np.log10(total + distinct + 1)
        add = lambda x: np.add.reduceat(x, tokens.offsets[:-1])
        return pa.table(
            {
                "doc_id": pa.array(tokens.ids, pa.int64()),
                "held_out": pa.array(is_held(tokens.ids)),
                "n_tokens": pa.array(tokens.lengths),
                "n_known": pa.array(add((tokens.count > 0)[tokens.word].astype(np.int64))),
                "train_tokens": pa.array(np.full(len(tokens.ids), total, np.int64)),
                "base_score": pa.array(add(base[tokens.word])),
                "score": pa.array(add(known[grams.of_token])),
            }
        )

    return run


def heavy_contexts(asked: DataFrame, model: Model) -> DataFrame:
    """w1, w2, s, q, p: test and final probability of each symbol after a heavy word (w2 is 0) or two."""
    counts = asked.groupBy("w1", "w2", "s").agg(F.sum("n").alias("n"), F.max("times").alias("times"))
    counts = materialize(counts, "lm-heavy")
    total, distinct, d = float(max(model.total, 1)), float(model.distinct), model.discount
    t = F.col("times")
    q0 = (F.greatest(t - 1 - TEST_DISCOUNT, F.lit(0.0)) + TEST_DISCOUNT * distinct / total) / max(total - 1, 1)
    p0 = F.when(t > 0, (t - d) / total).otherwise(d * distinct / total)
    level = counts.filter("w2 = 0").withColumns({"sq": q0, "sp": p0})
    done = None
    for deeper in (False, True):
        contexts = bounded_broadcast(level.groupBy("w1", "w2").agg(F.sum("n").alias("size"), F.sum((F.col("n") > 0).cast("bigint")).alias("kinds")), 200_000)
        left = (F.greatest(F.col("n") - 1 - TEST_DISCOUNT, F.lit(0.0)) + TEST_DISCOUNT * F.col("kinds") * F.col("sq")) / F.greatest(F.col("size") - 1, F.lit(1))
        tested = level.join(contexts, ["w1", "w2"]).withColumn("q", F.when((F.col("size") > 1) & (F.col("n") > 0), left).otherwise(F.col("sq")))
        gains = bounded_broadcast(tested.groupBy("w1", "w2").agg(F.sum(F.col("n") * F.log(F.greatest("q", F.lit(1e-300)) / F.col("sq"))).alias("gain")), 200_000)
        kept = (F.col("size") > 1) & (F.col("gain") >= model.divergence)
        p = F.when(kept, (F.greatest(F.col("n") - d, F.lit(0.0)) + d * F.col("kinds") * F.col("sp")) / F.col("size")).otherwise(F.col("sp"))
        out = materialize(tested.join(gains, ["w1", "w2"]).select("w1", "w2", "s", "q", p.alias("p")), "lm-heavy")
        if deeper:
            return done.unionByName(out)
        done = out
        level = counts.filter("w2 > 0").join(out.select("w1", "s", F.col("q").alias("sq"), F.col("p").alias("sp")), ["w1", "s"])


def _bucketed(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """df written as a table in the shared folder that is bucketed by a column: grouping by it needs no exchange."""
    spark, name = df.sparkSession, f"lm_blocks_{uuid.uuid4().hex}"
    df.write.option("path", f"{shared_folder(spark)}/{name}").option("compression", "zstd").format("parquet").bucketBy(buckets, by).saveAsTable(name)
    return spark.table(name)


#: Least gain in nats. Of 0, .1, .25, .5, 1, 3 and 6, tried on a sixth of the training rows with a tree of the other
#: training rows, this is the largest that scores them within 0.0002 a token of the best.
DIVERGENCE = 0.1


def score_documents(docs: DataFrame, divergence: float = DIVERGENCE) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    text = no_clash(docs, "doc_id", "text")
    bytes_ = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, gram_buckets = (int(max(8, -(-bytes_ // b))) for b in (WORD_BUCKET_BYTES, GRAM_BUCKET_BYTES))
    parts = max(gram_buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = _bucketed(text.mapInArrow(_read_blocks, BLOCKS), "block", parts)
    sent = blocks.mapInArrow(_send_words(buckets), "block bigint, bucket int, a binary, b binary, c binary")
    answers = materialize(sent.groupBy("bucket").applyInArrow(_answer_words(buckets, HEAVY_FROM), "kind int, block bigint, bucket int, a binary, b binary, c binary"), "lm-words")
    facts = [np.frombuffer(r.a, np.int64) for r in answers.filter(F.col("kind") == FACTS).select("a").toLocalIterator()]
    total, distinct, once, twice, heavy = (int(sum(int(f[i]) for f in facts)) for i in range(5))
    model = Model(total, distinct, once, twice, divergence)
    words = answers.filter(F.col("kind") == WORDS)
    with_blocks = lambda right, function, schema: blocks.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(function, schema)
    known = words.unionByName(words.sparkSession.createDataFrame([], ANSWERS), allowMissingColumns=True)
    if heavy:
        asked = materialize(with_blocks(words, _ask_heavy(buckets), ASKED), "lm-heavy")
        told = asked.select("block", "w1", "w2", "s").join(heavy_contexts(asked, model), ["w1", "w2", "s"]).withColumn("kind", F.lit(HEAVY))
        known = known.unionByName(told, allowMissingColumns=True)
    grams = with_blocks(known, _send_grams(buckets, gram_buckets), GRAMS)
    scores = grams.groupBy("bucket", "depth").applyInArrow(_answer_grams(model), "kind int, block bigint, bucket int, a binary")
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return with_blocks(words.unionByName(scores, allowMissingColumns=True), _score_block(total, distinct, buckets, gram_buckets), schema)
