"""Importance resampling against a loop over all n-grams, whole words and buckets."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from roadmetrics.llm import resampling
from tests.llm.test_operators import ODD, docs, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows, target, longest, percent, least_words, buckets):
    def grams(text):
        words = WORD.findall(lower(text))
        return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(bucket(g) for _, text in rows for g in grams(text)[1]), Counter(bucket(g) for text in target for g in grams(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out, able = [], []
    for k, (doc_id, text) in enumerate(rows):
        n_words, g = grams(text)
        weight = sum(gain(bucket(x)) for x in g)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n_words >= least_words:
            able.append(k)
    able.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    for rank, k in enumerate(able[: len(able) * percent // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_against_a_loop(spark, longest):
    r = random.Random(5)
    texts = [" ".join(prose(i, r.randint(1, 90))) for i in range(120)]
    rows = docs(spark, [*ODD, *texts, *[(500, texts[3])] * 3, (None, texts[4]), "ÉCOLE École 12a" * 20, " ".join(prose(7, 30_000))])
    target = spark.createDataFrame([(1, texts[0] + " " + texts[1]), (2, None), (3, "")], "item_id bigint, text string")
    want = expected([(x.doc_id, x.text) for x in rows.collect()], [x.text for x in target.collect()], longest, 25, 20, 50)
    got = resampling.resample(rows, target, percent=25, least_words=20, longest=longest, buckets=50, block_bytes=2_000)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_tables(spark):
    rows, none = docs(spark, ["a b c d"] * 30), docs(spark, [])
    target = none.selectExpr("doc_id AS item_id", "text")
    assert resampling.resample(none, target).count() == 0
    got = resampling.resample(rows, target, percent=50, least_words=4).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 16))
    assert all(r["rank"] is None for r in resampling.resample(rows, target, least_words=5).collect())


def test_the_boundary_score_is_exact(spark):
    r = random.Random(1)
    scores = [r.choice([-(1 << 40), -5, 0, 3, 1 << 13, (1 << 26) + 7, r.randrange(-(10**7), 10**7)]) for _ in range(500)]
    table = spark.createDataFrame([(s,) for s in scores], "score bigint").repartition(4)
    for wanted in (1, 2, 99, 250, 499, 500):
        assert resampling._lowest_drawn(table, wanted) == sorted(scores, reverse=True)[wanted - 1]
