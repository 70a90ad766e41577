"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from roadmetrics.llm import spelling
from tests.llm.test_operators import ODD, docs


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    return a != b and (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1 or len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b))))


def expected(rows, least_letters=7, least_count=2, ratio=10):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= least_letters and n >= least_count}
    near = {w: [u for u in words if one_apart(w, u)] for w in words}
    best = {w: min(us, key=lambda u: (-words[u], u), default=None) for w, us in near.items()}
    form = {w: u if u and words[u] >= ratio * words[w] else None for w, u in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=str)


def misspelt(r, word):
    i, c = r.randrange(len(word)), r.choice("abcxyzßÀÉ÷é")
    return r.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])


def test_against_all_pairs(spark):
    r = random.Random(8)
    base = ["colourful", "neighbour", "organise", "Élémentaire", "straßenbahn", "aabbccddee", "abababab", "listening", "signaling", "zzzzzzz"]
    texts = []
    for i in range(300):
        words = [r.choice(base) for _ in range(r.randint(0, 60))]
        words += [misspelt(r, r.choice(base)) for _ in range(3)] + [misspelt(r, misspelt(r, base[i % 10]))] * (i % 3)
        texts.append(r.choice([" ", "-", "9"]).join(w.upper() if r.random() < 0.2 else w for w in words))
    rows = docs(spark, [*ODD, *texts, (None, "Colourful colourfull colourfull"), *[(7, texts[3])] * 3, "x" * 5000 + " " + "x" * 5000, "x" * 5001 + " " + "x" * 5001])
    want = expected([(x.doc_id, x.text) for x in rows.collect()])
    got = spelling.group_variants(rows)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(w[2] not in (w[0], w[1]) for w in want) > 0 and sum(w[4] > 1 for w in want) > 50  # chains and several near words


def test_chains_of_any_length(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(19)] + [("a", "w5"), ("b", "w19")], "word string, form string")
    got = {r.word: r.root for r in spelling.follow(forms).collect()}
    assert got == {**{f"w{i}": "w19" for i in range(19)}, "a": "w19", "b": "w19"}


def test_empty_table(spark):
    assert spelling.group_variants(docs(spark, [])).count() == 0
    assert spelling.group_variants(docs(spark, ODD)).count() == 0
