"""Segmentation against all splits of a run, counts and naive Bayes against dictionaries over the urls."""

import math
import random
import re
from collections import Counter
from itertools import combinations

from roadmetrics.llm import url_filter

SEEDS = {*url_filter.BLOCK_WORDS, *url_filter.ALLOW_WORDS}


def all_splits(run):
    for k in range(len(run)):
        for cuts in combinations(range(1, len(run)), k):
            edges = [0, *cuts, len(run)]
            yield [run[a:b] for a, b in zip(edges, edges[1:])]


def test_viterbi_is_the_cheapest_of_all_splits():
    r = random.Random(8)
    for _ in range(60):
        run = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        words = {run[a:b]: r.randint(1, 40) for a in range(len(run)) for b in range(a + 2, len(run) + 1) if r.random() < 0.5}
        places = [(a, b - a, words[run[a:b]]) for a in range(len(run)) for b in range(a + 2, len(run) + 1) if run[a:b] in words]
        cost = lambda split: sum(math.log10(1000 / words[w]) if w in words else 3 + len(w) for w in split)  # noqa: B023, E731
        assert math.isclose(cost(url_filter.viterbi(run, places, 1000, 32)), min(map(cost, all_splits(run))))


def runs_of(text):
    return [w for w in re.findall("[a-z]{2,}", text) if w not in url_filter.PLAIN_LABELS]


def by_dictionaries(urls):
    """(host words, block score) per url."""
    parts = [re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u).groups() for u in urls]
    sites = {(h.lower(), p) for h, p in parts}
    hosts, counts = {h for h, _ in sites}, Counter()
    runs = {w for h in hosts for w in runs_of(h)}
    for word in {(h, w) for h, p in sites for w in runs_of(p.lower()) if w not in runs_of(h)}:
        counts["apart", word[1]] += 1
    for _, w in {(h, w) for h in hosts for w in runs_of(h)}:
        counts["whole", w] += 1
    for w in runs:
        for n in range(2, len(w)):
            counts["inner", w[:n]] += 1
            counts["inner", w[-n:]] += 1
    seed = max(50.0, 1e-3 * sum(counts.values()))
    total = sum(counts.values()) + seed * len(SEEDS)

    def split(run):
        words = []
        for a in range(len(run)):
            for b in range(a + 2, len(run) + 1):
                w = run[a:b]
                n = counts["apart", w] + counts["inner", w]
                if w != run:
                    n += counts["whole", w] - run.startswith(w) - run.endswith(w)
                if n > 0 or w in SEEDS:
                    words.append((a, b - a, n + seed * (w in SEEDS)))
        return url_filter.viterbi(run, words, total, 32)

    words = {h: [w for run in runs_of(h) for w in split(run)] for h in hosts}
    tokens = {s: words[s[0]] + [w for w in re.findall("[a-z0-9]+", s[1].lower()) if w not in url_filter.PLAIN_LABELS] for s in sites}
    seen = {"block": Counter({w: 20 for w in url_filter.BLOCK_WORDS}), "allow": Counter({w: 20 for w in url_filter.ALLOW_WORDS})}
    for s in sites:
        fits = [(len(h + p), say) for say, h, p in url_filter.RULES if (s[0] == h or s[0].endswith("." + h)) and s[1].startswith(p)]
        if fits:
            seen[max(fits)[1]].update(tokens[s])
    vocabulary = {*seen["block"], *seen["allow"]}
    odds = {w: math.log((seen["block"][w] + 0.1) / (sum(seen["block"].values()) + 0.1 * len(vocabulary))) - math.log((seen["allow"][w] + 0.1) / (sum(seen["allow"].values()) + 0.1 * len(vocabulary))) for w in vocabulary}
    return [(" ".join(words[h.lower()]), 1 / (1 + math.exp(-math.log(0.3 / 0.7) - sum(odds.get(w, 0) for w in tokens[h.lower(), p])))) for h, p in parts]


def test_learned_scores_equal_dictionaries(spark):
    r = random.Random(6)
    stems = "ther tion ha wh garden poker shop casino blue".split()
    urls = [f"http://{r.choice(['www.', 'm.', ''])}{''.join(r.sample(stems, r.randint(1, 3)))}.example.{r.choice(['com', 'net', 'org'])}/{r.choice(['es', 'en', 'de', 'fr'])}/{r.randint(1, 30)}{r.choice(['', '.html', '/Shop-blue', '?x=/poker'])}" for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = sorted(url_filter.judge_urls(pages).collect(), key=lambda x: x.page_id)
    want = by_dictionaries(urls)
    assert [x.host_words for x in got] == [w for w, _ in want]
    assert all(math.isclose(x.block_score, s, abs_tol=1e-6) for x, (_, s) in zip(got, want))
    assert len({round(s, 4) for _, s in want}) > 30


def test_very_long_and_clashing(spark):
    urls = ["http://" + "casino" * 800 + ".net/x", "http://a.net/" + "garden/" * 5000, "http://b.net/" + "z" * 20_000]
    pages = spark.createDataFrame([(i, u, "h", "p", "v") for i, u in enumerate(urls)], "page_id bigint, url string, host string, path string, verdict string")
    rows = url_filter.judge_urls(pages).orderBy("page_id").collect()
    assert [r.verdict for r in rows] == ["block", "allow", "allow"] and rows[0].host_words == " ".join(["casino"] * 800)
