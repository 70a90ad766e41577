"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from roadmetrics.llm import ngram_jaccard
from tests.llm.test_operators import ODD, docs, prose


def components(texts, n=4, percent=85):
    import re

    def row(text):
        words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()

    rows = [row(t) for t in texts]
    root = list(range(len(rows)))
    for i, a in enumerate(rows):
        for j in range(i):
            if a and rows[j] and 100 * len(a & rows[j]) >= percent * len(a | rows[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    return [len(r) for r in rows], root


def varied(seed, base, share):
    r, out = random.Random(seed), list(base)
    for _ in range(max(1, int(share * len(base)))):
        at = r.randrange(len(out))
        out[at : at + 1] = r.choice([[], ["other", "words"], ["changed"], [f"w{r.random()}"]])
    return out


def made():
    """Groups of copies with 0 to 5 % of the words changed, a passage that most texts share, short and odd texts."""
    passage, texts = prose(999, 60), []
    for k in range(12):
        base = prose(k, 40 + 12 * k)
        for c in range(1 + k):
            copy = varied(100 * k + c, base, 0.01 * (c % 6) / 2) if c else base
            texts.append(" ".join(passage + copy if k % 3 else copy))
    return [*texts, *texts[5:9], *(" ".join(passage[:55] + prose(5000 + i, 6)) for i in range(30)), "a b", "A  b", "a b c", "a b c d", "a b c d e", " ".join(prose(3, 20_000))]


@pytest.mark.parametrize("task_rows, loose, seeds", [(1024, 64, 2), (4, 0, 1), (8, 2, 0)])
def test_against_all_pairs(spark, task_rows, loose, seeds, monkeypatch):
    """Small tasks cut buckets into chunks; without loose rows chunks of classes meet; without seeds all is left to the second round."""
    find = ngram_jaccard.find_links
    monkeypatch.setattr(ngram_jaccard, "find_links", lambda *a: find(*a, seeds=seeds))
    texts = made()
    sizes, root = components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_classes(docs(spark, texts), task_rows=task_rows, loose=loose).collect()}
    assert got == {i: (n, c) for i, (n, c) in enumerate(zip(sizes, root))}
    assert 20 < len(set(root)) < len(texts) - 40


def test_buckets_of_copies_larger_than_a_task(spark):
    """Near copies that share their rarest columns fill buckets of many chunks, which the first round must deal out as tasks."""
    base = prose(1, 80)
    texts = [" ".join([*base, f"end{i}"]) for i in range(60)] + [" ".join([*base[:40], *prose(2, 80), f"end{i}"]) for i in range(7)]
    sizes, root = components(texts)
    assert len(set(root)) == 2
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_classes(docs(spark, texts), task_rows=8, loose=4).collect()}
    assert got == {i: (n, c) for i, (n, c) in enumerate(zip(sizes, root))}


def test_odd_rows(spark):
    got = sorted(ngram_jaccard.jaccard_classes(docs(spark, ODD)).collect(), key=str)
    assert [r for r in got if r.doc_id == 3] and len(got) == len(ODD)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} >= {(0, 0, 0), (1, 0, 1), (2, 0, 2), (4, 1, 3), (None, 0, None)}
    assert ngram_jaccard.jaccard_classes(docs(spark, [])).count() == 0


def test_product_in_blocks_equals_sets(monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "ROWS", 3)
    monkeypatch.setattr(ngram_jaccard, "COLUMNS", 16)
    r = np.random.default_rng(4)
    rows = [np.unique(r.integers(0, 60, r.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    rows += [np.unique(np.append(x[1:], np.uint64(99))) for x in rows]
    for percent in (50, 85, 100):
        want = {(i, j) for j in range(len(rows)) for i in range(j) if 100 * len(np.intersect1d(rows[i], rows[j])) >= percent * len(np.union1d(rows[i], rows[j]))}
        assert {tuple(sorted(p)) for p in ngram_jaccard.linked_pairs(rows, percent)} == want


def test_signatures_leave_no_linked_pair():
    """Rows of all sizes, among them pairs on both sides of a doubling of the words, at several thresholds."""
    r = np.random.default_rng(7)
    rows = []
    for size in (1, 2, 5, 30, 120, 127, 128, 129, 140, 250, 256, 257, 270, 1000, 1030):
        base = r.integers(0, 1 << 63, size).astype(np.uint64)
        for change in (0, 1, size // 12, size // 6, size // 2):
            rows.append(np.unique(np.concatenate([base[change:], r.integers(0, 1 << 63, r.integers(0, change + 1)).astype(np.uint64)])))
    rows = [x for x in rows if len(x)]
    where = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    words, start = ngram_jaccard.signatures(np.concatenate(rows), where)
    signs = [words[a:b].view(np.uint64) for a, b in zip(start[:-1], start[1:])]
    assert {len(x) for x in signs} == {1, 2, 4, 8, 16}
    for percent in (30, 60, 85, 100):
        like = ngram_jaccard.like_pairs(np.diff(where), signs, percent, cells=64)
        links = [(i, j) for j in range(len(rows)) for i in range(j) if 100 * len(np.intersect1d(rows[i], rows[j])) >= percent * len(np.union1d(rows[i], rows[j]))]
        assert links and all(like[i, j] and like[j, i] for i, j in links) and not like.diagonal().any()
    assert like.sum() < 4 * len(links) + 20


def test_rows_that_are_alike_by_chance_are_not_sent(spark, monkeypatch):
    """Nearly all columns of each text are in some other text, but no two texts share many; only near copies may be sent to
    be verified, each row once or twice, also where all that tasks ask for is too much to broadcast."""
    r = random.Random(5)
    passages = [[f"x{r.randrange(10**6)}" for _ in range(40)] for _ in range(300)]
    texts = [" ".join(w for k in r.sample(range(300), 10) for w in passages[k]) for _ in range(150)]
    texts += [t.replace("x", "y", 1) for t in texts[:5]]
    sizes, root = components(texts)
    sent, write, find = [], ngram_jaccard.materialize, ngram_jaccard.find_links

    def kept(df, name):
        out = write(df, name)
        if name == "jaccard-tasks":
            sent.append(out.count())
        return out

    monkeypatch.setattr(ngram_jaccard, "materialize", kept)
    monkeypatch.setattr(ngram_jaccard, "find_links", lambda *a: find(*a, most_broadcast=0))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_classes(docs(spark, texts)).collect()}
    assert got == {i: (n, c) for i, (n, c) in enumerate(zip(sizes, root))} and len(set(root)) == 150
    assert 10 <= sum(sent) <= 20


def test_map_of_wanted_nodes(spark):
    nodes = [bytes([i, 255 - i, 7 * i % 256, 3 * i % 256]) * 4 for i in range(256)]
    bits = ngram_jaccard.wanted_map(spark.createDataFrame([(bytearray(x),) for x in nodes[::2]], "node binary"))
    slot = ngram_jaccard._slots(nodes)
    assert [bool(bits[s >> 3] & 128 >> (s & 7)) for s in slot.tolist()] == [i % 2 == 0 for i in range(256)]
