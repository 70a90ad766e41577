"""Line dedup against a list of all repeated windows, and winnowing against its definition."""

import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadmetrics.llm import line_dedup
from tests.llm.test_operators import docs, prose


def by_brute_force(texts: list[str], least: int = 50) -> list[str]:
    """Every run of lines of at least 50 words that starts earlier elsewhere goes; runs are compared by their lines with words."""
    seen, out = set(), []
    for text in texts:
        lines = text.split("\n")
        worded, cut = [i for i, x in enumerate(lines) if x.split()], set()
        for a in range(len(worded)):
            own = []
            for b in range(a, len(worded)):
                key = tuple(lines[i].strip() for i in worded[a : b + 1])
                if sum(len(x.split()) for x in key) >= least:
                    own.append(key)
                    if key in seen:
                        cut |= set(range(worded[a], worded[b] + 1))
            seen |= set(own)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in cut))
    return out


def test_random_line_sets_equal_brute_force(spark):
    r = random.Random(3)
    passages = [[" ".join(prose(3000 + 20 * p + i, r.randint(1, 30))) for i in range(r.randint(3, 9))] for p in range(12)]
    texts = []
    for k in range(70):
        lines = [" ".join(prose(9000 + 50 * k + i, r.randint(1, 20))) for i in range(r.randint(0, 6))]
        for _ in range(r.randint(1, 3)):
            passage = r.choice(passages)
            part = passage[r.randint(0, 2) :][: r.randint(2, 9)]
            mixed = [x for line in part for x in ([line, "", " "] if r.random() < 0.2 else [line])]
            at = r.randint(0, len(lines))
            lines[at:at] = mixed
        texts.append("\n".join(lines))
    got = sorted(line_dedup.dedup_lines(docs(spark, texts)).collect(), key=lambda x: x.doc_id)
    assert [x.text for x in got] == by_brute_force(texts)


def test_winnowing_selects_the_minimum_of_each_window():
    r = np.random.default_rng(2)
    for n in (1, 5, 80):
        words = r.integers(1, 15, n)
        hashes = r.integers(0, 7, n).astype(np.uint64)
        lines = line_dedup.Lines(np.arange(n), words, hashes)
        shingle, window = lines.ends(25), lines.ends(50)
        want: dict = {}
        for i in range(n):
            assert shingle[i] == next((j for j in range(i, n) if words[i : j + 1].sum() >= 25), -1)
            if window[i] >= 0:
                inside = [s for s in range(i, n) if 0 <= shingle[s] <= window[i]]
                keys = [int(lines.run_hashes(np.array([s]), shingle[[s]])[0]) for s in inside]
                want.setdefault(inside[len(keys) - 1 - keys[::-1].index(min(keys))], []).append((i, window[i]))
        got = line_dedup.winnow(lines, 25, 50)
        whole = {s: [w[1:] for w in windows if w[2] == window[w[1]]] for s, windows in got.items()}
        assert whole == want
        ends = {w[2]: w[1] for windows in got.values() for w in windows if w[2] != window[w[1]]}
        assert all(words[i : j + 1].sum() >= 50 > words[i + 1 : j + 1].sum() for j, i in ends.items())
    same = line_dedup.Lines(np.arange(6), np.full(6, 9), np.array([4, 5, 6, 4, 5, 6], np.uint64))
    a, b = same.run_hashes(np.array([0, 3]), np.array([2, 5]))
    assert a == b != same.run_hashes(np.array([1]), np.array([3]))[0]


def test_very_long_texts_take_time_in_proportion(spark):
    blank = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text_hash": [1, 2], "text": ["word " * 60 + "\n" * 100_000 + "word " * 60, "\n".join(prose(1, 300_000))]})
    began = time.time()
    rows = sum(b.num_rows for b in line_dedup._fingerprints(25, 50)(iter([blank])))
    assert rows > 3000 and time.time() - began < 30
    line = " ".join(prose(5, 60))
    out = line_dedup.dedup_lines(docs(spark, [line + "\n" * 50_000 + "end", "\n" * 50_000 + line]), counts=True).orderBy("doc_id").collect()
    assert out[0].n_removed == 0 and (out[1].n_lines, out[1].n_removed, out[1].text.strip()) == (50_001, 1, "")


def test_one_passage_in_very_many_documents(spark):
    passage = "\n".join(" ".join(prose(40 + i, 10)) for i in range(9))
    rows = docs(spark, [f"own line {i}\n{passage}" for i in range(400)])
    assert line_dedup.dedup_lines(rows).filter(F.contains("text", F.lit(passage))).count() == 1
