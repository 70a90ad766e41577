"""Occurrences and longest matches of the suffix arrays against a search of every window at every place."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadmetrics.llm import decontaminate
from tests.llm.test_operators import ODD, docs, prose

ITEMS = "item_id string, text string"


def brute_force(text: list[str], items: list[tuple[str, list[str]]], window: int):
    """Words hit, items, and the longest match that starts at an occurrence."""
    hit, found, longest = set(), set(), 0
    for name, words in items:
        n = min(window, len(words))
        for t in range(len(words) - n + 1) if n else ():
            for p in range(len(text) - n + 1):
                if text[p : p + n] == words[t : t + n]:
                    hit |= set(range(p, p + n))
                    found.add(name)
                    for _, other in items:
                        for o in range(len(other)):
                            k = 0
                            while o + k < len(other) and p + k < len(text) and other[o + k] == text[p + k]:
                                k += 1
                            longest = max(longest, k)
    return len(hit), sorted(found), longest


def test_random_texts_equal_brute_force():
    r = random.Random(4)
    for round_ in range(40):
        letters = "abc" if round_ % 2 else "abcdefgh"
        say = lambda n: [r.choice(letters) for _ in range(n)]
        items = [(f"i{k}", say(r.choice([0, 1, 2, 4, 9]))) for k in range(r.randint(1, 5))]
        texts = [say(r.randint(0, 30)) for _ in range(8)] + [x + say(2) + y for (_, x), (_, y) in zip(items, items[1:])]
        window = r.randint(2, 4)
        block = decontaminate.make_block([(n, decontaminate.word_hashes(pa.array([" ".join(w)]))[0]) for n, w in items if w], window)
        words, of_row = decontaminate.word_hashes(pa.array([" ".join(t + ["zz"] * (k % 2)) for k, t in enumerate(texts)]))
        found = decontaminate.occurrences(block, words, of_row)
        for k, text in enumerate(texts):
            own = (found.places >= of_row[k]) & (found.places < of_row[k + 1])
            hit = {x for p, n in zip(found.places[own], found.lengths[own]) for x in range(p, p + n)}
            names = sorted({x for w in np.unique(found.windows[own]) for x in found.items[w]})
            assert (len(hit), names, max(found.longest[own], default=0)) == brute_force(text, items, window)


def test_longest_match_over_items_that_share_a_window(spark):
    w = prose(3, 40)
    items = spark.createDataFrame([("a", " ".join(w[:13] + ["x"])), ("b", " ".join(w)), ("c", " ".join(["y"] + w[5:20]))], ITEMS)
    rows = decontaminate.find_hits(docs(spark, [" ".join(["z", *w]), " ".join(w[5:20]), " ".join(w[2:30])]), items).orderBy("doc_id").collect()
    assert [(r.longest_words, r.longest_item, r.longest_at) for r in rows] == [(40, "b", 1), (15, r_item(rows[1]), 0), (28, "b", 0)]
    assert [r.items for r in rows] == [["a", "b", "c"], ["b", "c"], ["b", "c"]]


def r_item(row):
    assert row.longest_item in ("b", "c")
    return row.longest_item


def test_blocks_of_items_agree_and_rows_stay(spark):
    said = [prose(70 + i, 25) for i in range(6)]
    texts = [" ".join(prose(i, 30) + said[i % 6][: 13 + i % 5] + said[(i + 1) % 6][3:20]) for i in range(12)] + [" ".join(prose(99, 3000) + said[0])] + ODD
    rows = docs(spark, texts)
    rows = rows.unionByName(rows.filter("doc_id < 3"))
    bench = spark.createDataFrame([(f"i{k}", " ".join(x)) for k, x in enumerate(said)], ITEMS)
    whole, parts = (decontaminate.contamination(rows, bench, block_words=n).drop("longest_item", "longest_at") for n in (1000, 40))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    left = [decontaminate.remove_contaminated(rows, bench, block_words=n) for n in (1000, 40)]
    assert left[0].columns == left[1].columns == rows.columns
    kept = [sorted(str(r) for r in x.collect()) for x in left]
    assert kept[0] == kept[1] and len(kept[0]) == 1 + len(ODD)


def test_very_long_texts(spark):
    w = prose(5, 200)
    text = " ".join(prose(6, 400_000) + w + w * 300)
    row = decontaminate.contamination(docs(spark, [text]), spark.createDataFrame([("a", " ".join(w))], ITEMS)).first()
    assert (row.n_words, row.longest_words, row.longest_at) == (460_200, 200, 400_000) and row.n_hit >= 60_200


def test_an_item_without_an_id_hits_but_is_not_listed(spark):
    text = " ".join(prose(77, 30))
    rows = spark.createDataFrame([(1, text), (2, "before " + text[: len(text) // 2])], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, text)], "item_id bigint, text string")
    for more in (items, items.unionByName(spark.createDataFrame([(5, text)], items.schema))):
        got = {r.doc_id: r for r in decontaminate.contamination(rows, more).collect()}
        assert got[1].n_hit == 30 and got[1].contaminated and got[1].n_items == more.count() - 1
        assert decontaminate.remove_contaminated(rows, more).count() == 0
    several = decontaminate.contamination(rows, items, block_words=5).collect()
    assert {r.doc_id: (r.n_hit, r.n_items) for r in several} == {r: (got[r].n_hit, 0) for r in got}
