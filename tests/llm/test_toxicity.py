"""Composition and best paths against enumeration of all paths; the clause grammar against its definition; held-out rows."""

import itertools
import random

import pyarrow as pa
import pytest

from roadmetrics.llm import toxicity
from roadmetrics.llm.transducer import Transducer, best, compose
from tests.llm.test_operators import ODD, docs


def all_paths(machine, word, state=None):
    """(what is written, weight) of every accepting path."""
    state = machine.start if state is None else state
    if not word:
        if state in machine.final:
            yield (), machine.final[state]
        return
    for write, weight, to in machine.arcs.get(state, {}).get(word[0], ()):
        for rest, more in all_paths(machine, word[1:], to):
            yield (write, *rest), weight + more


def any_machine(r, reads, writes):
    out = Transducer(0, {s: r.randint(-3, 3) for s in range(3) if r.random() < 0.7})
    for _ in range(9):
        out.arc(r.randrange(3), r.choice(reads), r.choice(writes), r.randint(-5, 5), r.randrange(3))
    return out


def test_composition_and_best_path_equal_enumeration():
    r = random.Random(12)
    for _ in range(40):
        a, b = any_machine(r, "xy", "pq"), any_machine(r, "pq", "uv")
        both = compose(a, b)
        for n in range(4):
            for word in itertools.product("xy", repeat=n):
                want = {}
                for between, w in all_paths(a, word):
                    for out, v in all_paths(b, between):
                        want[out] = max(want.get(out, -99), w + v)
                got = {}
                for out, w in all_paths(both, word):
                    got[out] = max(got.get(out, -99), w)
                assert got == want
                assert best(both, [(x,) for x in word]) == max(want.values(), default=None)
        readings = [tuple(r.sample("xy", r.randint(1, 2))) for _ in range(3)]
        ways = [best(both, [(x,) for x in word]) for word in itertools.product(*readings)]
        assert best(both, readings) == max((w for w in ways if w is not None), default=None)


def by_definition(words):
    """A clause's score: insults one by one; threats in the best way."""
    score, kinds = 0.0, [w[0] for w in words]
    for i, word in enumerate(words):
        factor = (0.3 if "negation" in kinds[max(0, i - 3) : i] else 1) * (0.5 if "report" in kinds[:i] else 1)
        if word[0] == "insult":
            score += 0.25 * word[1] * factor * (1.25 if "target" in kinds[max(0, i - 3) : i] else 1)
        if word[0] == "threat" and "target" in kinds:
            score += 1.5 * factor
    return score


def test_clause_scores_equal_definition():
    r = random.Random(9)
    symbols = [("other",), ("threat",), ("target",), ("negation",), ("report",), ("insult", 2), ("insult", 9)]
    for _ in range(400):
        words = [r.choice(symbols) for _ in range(r.randint(0, 12))]
        assert toxicity.clause_score(tuple((w,) for w in words)) == pytest.approx(by_definition(words))
        listed = [(i, w) for i, w in enumerate(words) if w != ("other",)]
        short = toxicity.clause_word([i for i, _ in listed], [(w,) for _, w in listed])
        assert toxicity.clause_score(short) == pytest.approx(by_definition(words))


def test_clauses_not_words_are_scored():
    grammar = toxicity.Grammar({}, {})
    total = lambda text: grammar.features(pa.array([text], pa.string()))[0, 0]
    assert total("You are an idiot.") > total("This idiot.") > total("He said the clerk is an idiot.") > total("You are not an idiot, they said.") > 0
    assert total("I will kill you.") > 0 == total("I will kill time.") == total("I will kill time. You may wait.")
    assert total("You " + "x " * 200_000 + "idiot") == total("idiot") and total(None) == total("") == 0


def test_beats_the_majority_on_held_out_rows(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    rows = toxicity.score_toxicity(read("documents"), read("labels")).join(read("labels"), "doc_id").filter("held_out").select("predicted", "toxic").collect()
    right = lambda some: sum(r.predicted == r.toxic for r in some) / len(some)
    assert right([r for r in rows if r.toxic == 1]) >= 0.7 and right([r for r in rows if r.toxic == 0]) >= 0.95
    assert toxicity.score_toxicity(docs(spark, ODD), read("labels")).count() == len(ODD)
