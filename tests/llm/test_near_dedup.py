"""Sketches against their definition, large buckets, very long texts, and recall against brute force on whole tables."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from roadmetrics.llm import near_dedup
from roadmetrics.llm.common import WORD_BYTE, runs, span_hashes, utf8_bytes
from tests.llm.test_operators import docs, edits, prose, shingles


def roots_of(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_sketch_is_the_two_least_kmers_in_text_order():
    texts = [" ".join(prose(i, 5 + 40 * i)) for i in range(4)]
    data, offsets = utf8_bytes(pa.array(texts))
    starts, ends, of_row = runs(WORD_BYTE[data], offsets)
    labels, where = near_dedup.kmer_labels(span_hashes(data, starts, ends), of_row)
    whole = near_dedup.order_minhash(labels, where, 3, 2)
    for i in range(4):
        alone = labels[where[i] : where[i + 1]]
        assert len(set(alone.tolist())) == len(alone)
        np.testing.assert_array_equal(near_dedup.order_minhash(alone, np.array([0, len(alone)]), 3, 2)[0], whole[i])
        turned = near_dedup.order_minhash(alone[::-1].copy(), np.array([0, len(alone)]), 3, 2)[0]
        assert (turned == whole[i]).all() == (len(alone) == 1)  # the order in the text counts


def test_one_word_more_in_a_very_long_text(spark):
    words = np.array(prose(1, 1000))[np.random.default_rng(1).integers(0, 1000, 1_300_000)]
    one = " ".join(words)
    other = " ".join([*words[:1_200_000], "more", *words[1_200_000:]])
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text_hash": [1, 2], "text": [one, other]})
    rows = [r for b in near_dedup._nodes(20)(iter([batch])) for r in b.to_pylist()]
    assert sum(x == y for x, y in zip(rows[0]["bands"], rows[1]["bands"])) >= 18
    a, b = (np.frombuffer(r["words"], np.uint32) for r in rows)
    of_a, of_b = (near_dedup.kmer_labels(w.astype(np.uint64), np.array([0, len(w)]))[0] for w in (a, b))
    assert near_dedup.aligned(a, b, of_a, of_b, 0.99, 1.0) and near_dedup.aligned(a, b, of_a, of_b, 1.0, 0.999)
    b = b.copy()
    b[::8] = 0  # 12 % of the words
    of_b = near_dedup.kmer_labels(b.astype(np.uint64), np.array([0, len(b)]))[0]
    assert not near_dedup.aligned(a, b, of_a, of_b, 0.8, 0.9) and near_dedup.aligned(a, b, of_a, of_b, 0.8, 0.87)


def test_cost_of_a_gap_is_the_edit_distance():
    r = random.Random(4)
    for n in range(400):
        a, b = ([r.randrange(4) for _ in range(r.randrange(9))] for _ in range(2))
        want, most = edits(a, b), r.randrange(9)
        got = near_dedup.gap_cost(np.array(a, np.uint32), np.array(b, np.uint32), most)
        assert got == want if want <= most else got > most


def test_long_gaps_cost_the_edit_distance():
    r = random.Random(8)
    for n in range(60):
        a, b = ([r.randrange(6) for _ in range(r.randrange(1, 150))] for _ in range(2))
        want, most = edits(a, b), r.randrange(120)
        got = near_dedup.edit_distance(a, b, most)
        assert got == want if want <= most else got > most


def test_a_common_passage_needs_no_alignments(monkeypatch):
    """Texts with one long passage in common and tails of their own: enough pairs of words are common, too few words."""
    r, calls, aligned = random.Random(3), [], near_dedup.aligned
    monkeypatch.setattr(near_dedup, "aligned", lambda *a: calls.append(1) or aligned(*a))
    passage = [r.randrange(1 << 32) for _ in range(300)]
    rows = [np.array(passage + [r.randrange(1 << 32) for _ in range(60 + i % 10)], np.uint32) for i in range(60)]
    rows.append(rows[7].copy())
    rows[-1][::40] = 0
    assert near_dedup.task_links(rows, 0.8, 0.9) == [(7, 60)]
    assert len(calls) < 20


def test_cost_between_kmers_is_near_the_edit_distance():
    """Never below it; equal for scattered changes of texts whose words vary."""
    r, exact = random.Random(6), 0
    for n in range(60):
        a = [r.randrange(60) for _ in range(150)]
        b = list(a)
        for _ in range(r.randrange(1, 14)):
            at = r.randrange(len(b))
            b[at : at + r.choice([0, 1, 1, 2])] = [99] * r.choice([0, 1, 1])
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        of_x, of_y = (near_dedup.kmer_labels(w.astype(np.uint64), np.array([0, len(w)]))[0] for w in (x, y))
        least = edits(a, b)
        for d in range(max(0, least - 1), least + 2):
            if near_dedup.aligned(x, y, of_x, of_y, 1.1, 1 - d / max(len(a), len(b))):
                assert d >= least
                exact += d == least
    assert exact >= 57


@pytest.mark.parametrize("task_rows", [3, 1024])
def test_large_buckets_of_one_and_of_many_classes(spark, task_rows):
    """Many near copies of two texts that share most bands with some others."""
    r, texts = random.Random(2), []
    for k in range(3):
        base = prose(70 + k, 90)
        for _ in range(20):
            changed = list(base)
            changed[r.randrange(90)] = r.choice(prose(5, 30))
            texts.append(changed)
    half = prose(70, 90)
    texts += [half[:70] + prose(300 + i, 22) for i in range(10)]
    sets = [shingles(t) for t in texts]
    same = lambda x, y: sum((x & y).values()) >= 0.8 * sum((x | y).values())
    want = roots_of(len(texts), [(j, i) for i in range(len(texts)) for j in range(i) if same(sets[i], sets[j])])
    got = {x.doc_id: x.class_id for x in near_dedup.near_classes(docs(spark, [" ".join(t) for t in texts]), task_rows=task_rows).collect()}
    assert got == dict(enumerate(want)) and len(set(want)) < 14


def test_recall_on_a_whole_table(spark):
    """All pairs at or above the k-mer similarity and nearly all at or above the edit similarity, found by counting common
    shingles, are in one class, and no class is more than the pairs connect."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in r.text or "")) for r in rows.select("doc_id", "text").collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    holders: dict = {}
    for i, s in sets.items():
        for x, n in s.items():
            holders.setdefault(x, []).append((i, n))
    both: Counter = Counter()
    for own in holders.values():
        for a in range(len(own)):
            for b in range(a):
                both[own[b][0], own[a][0]] += min(own[a][1], own[b][1])
    size = {i: sum(s.values()) for i, s in sets.items()}
    pairs = [p for p, n in both.items() if n >= 0.8 * (size[p[0]] + size[p[1]] - n)]
    longer = {p: max(len(texts[i]) for i in p) for p in both}
    near = [p for p, n in both.items() if n >= longer[p] - 4 - 5 * (longer[p] // 10) and edits(texts[p[0]], texts[p[1]], longer[p] // 10) <= longer[p] // 10]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(rows).collect()}
    assert len(pairs) > 50 and sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)
    assert len(set(near) - set(pairs)) > 50 and sum(got[a] == got[b] for a, b in near) >= 0.97 * len(near)
    ids = sorted(texts)
    at = {d: n for n, d in enumerate(ids)}
    most = dict(zip(ids, roots_of(len(ids), [(at[a], at[b]) for a, b in {*pairs, *near}])))
    short = {d for d in ids if len(texts[d]) < 5}
    assert all(most[d] == at[got[d]] or most[d] == most[got[d]] for d in ids if d not in short)
