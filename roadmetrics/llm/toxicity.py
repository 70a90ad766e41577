"""Toxicity by a weighted finite-state pattern grammar.

A clause is read by five transducers in a row (``transducer.py``), composed into one machine:

* the lexicon reads words and writes symbols: insult (of some severity), threat, target, negation, reported speech, any
  other word. A word that is in several lists has several arcs;
* negation marks the insults and threats among the next ``NEGATION_REACH`` words after a negation;
* reported speech marks those after a verb of saying in the clause;
* the target transducer marks insults right after a target;
* the scorer's arcs weigh what they read: an insult by its severity, less if negated or reported, more if marked by a
  target; a threat may be passed over, or weighs if a target stands in its clause, before or after. A path that counts a
  threat and never meets a target does not end in a final state.

A clause's score is the weight of its best path. Only clauses that hold an insult or a threat are run. A logistic unit
turns a document's clause scores into a probability.

Insult words and word beginnings are learned from labelled rows: those much more frequent among toxic documents than
among the others of a bounded sample (``sample_rows`` of at most 64 kB each). The logistic weights are fitted on each
half of it as read with the lexicon of the other half. What is sent to the executors is bounded by the sample.

Edge cases: null text is empty; texts without a match get the base probability; very long clauses are read once, symbol
by symbol, from the first listed word to the last; repeated rows are scored alike; without labelled rows only the seed words count; an empty table gives an
empty result; columns of other names are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER_TO_LOWER, WORD_BYTE, labelled_sample, no_clash, remainder, runs, span_hashes, steps, utf8_bytes
from .transducer import Transducer, best, compose

#: The seed words of the transducers.
INSULTS = "bastard clown coward creep disgusting dumb fool garbage idiot imbecile jerk liar loser moron pathetic pig scum stupid trash ugly vermin worthless".split()
THREATS = "attack beat burn crush destroy die hang harm hurt kill murder punch shoot smash stab strangle".split()
TARGETS = "you your yours yourself u ur they them their he him his she her".split()
NEGATIONS = "not no never isn arent aren don doesn didn won cannot neither nor without".split()
REPORTS = "said says saying told wrote writes called calls quoted quotes quote claimed claims reported reports alleged".split()
OTHER, THREAT, TARGET, NEGATION, REPORT = "other", "threat", "target", "negation", "report"
#: Insults have severities 1 to LEVELS, each of which weighs LEVEL.
LEVEL, LEVELS, SEED_WEIGHT, NEGATION_REACH = 0.25, 10, 1.5, 3
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 0.3, 0.5, 1.25, 1.5
HARM = [THREAT, *(("insult", level) for level in range(1, LEVELS + 1))]
CLAUSE_END = np.zeros(256, bool)
CLAUSE_END[[ord(c) for c in ".!?;:\n"]] = True
PREFIX_BYTES = range(5, 11)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def insult(weight: float) -> tuple[str, int]:
    return "insult", min(LEVELS, max(1, round(weight / LEVEL)))


def reach_machine(trigger: str, write: str, mark: str, symbols: list, marked: list) -> Transducer:
    """Writes write for the trigger and marks the symbols of marked among the next NEGATION_REACH ones."""
    out = Transducer(0, dict.fromkeys(range(NEGATION_REACH + 1), 0.0))
    for left in range(NEGATION_REACH + 1):
        out.arc(left, trigger, write, 0.0, NEGATION_REACH)
        for symbol in symbols:
            out.arc(left, symbol, (*symbol, mark) if left and symbol in marked else symbol, 0.0, max(0, left - 1))
    return out


def negation_machine() -> Transducer:
    plain = [((x,) if isinstance(x, str) else x) for x in HARM]
    return reach_machine((NEGATION,), (OTHER,), NEGATED, [(OTHER,), (TARGET,), (REPORT,), *plain], plain)


def report_machine() -> Transducer:
    out = Transducer(False, {False: 0.0, True: 0.0})
    for said in (False, True):
        out.arc(said, (REPORT,), (OTHER,), 0.0, True)
        for symbol in ((OTHER,), (TARGET,)):
            out.arc(said, symbol, symbol, 0.0, said)
        for symbol in _harm(NEGATED):
            out.arc(said, symbol, (*symbol, REPORTED) if said else symbol, 0.0, said)
    return out


def target_machine() -> Transducer:
    harm = _harm(NEGATED, REPORTED)
    return reach_machine((TARGET,), (TARGET,), TARGETED, [(OTHER,), *harm], [x for x in harm if x[0] == "insult"])


def _harm(*marks: float) -> list[tuple]:
    """The harmful symbols with any of the marks, in their order."""
    out = [((x,) if isinstance(x, str) else x) for x in HARM]
    for mark in marks:
        out += [(*x, mark) for x in out]
    return out


def score_machine() -> Transducer:
    """States: no target yet; no target yet but a threat that needs one; a target was named."""
    out = Transducer("none", {"none": 0.0, "named": 0.0})
    for state in ("none", "pending", "named"):
        out.arc(state, (OTHER,), None, 0.0, state)
        out.arc(state, (TARGET,), None, 0.0, "named")
        for symbol in _harm(NEGATED, REPORTED, TARGETED):
            if symbol[0] == THREAT:
                weight = THREAT_WEIGHT * math.prod(symbol[1:])
                out.arc(state, symbol, None, weight, "named" if state == "named" else "pending")
                out.arc(state, symbol, None, 0.0, state)
            else:
                out.arc(state, symbol, None, LEVEL * symbol[1] * math.prod(symbol[2:]), state)
    return out


@lru_cache(1)
def clause_machine() -> Transducer:
    out = negation_machine()
    for machine in (report_machine(), target_machine(), score_machine()):
        out = compose(out, machine)
    return out


@lru_cache(100_000)
def clause_score(readings: tuple) -> float:
    """The weight of the best path over the symbols that the lexicon writes for a clause's words."""
    return best(clause_machine(), readings) or 0.0


def clause_word(places: list[int], readings: list[tuple]) -> tuple:
    """The machine's word for the listed words of a clause at their places. Of the other words between them as many as
    NEGATION_REACH are read: more would leave each transducer where it is."""
    out, last = [], None
    for place, reading in zip(places, readings):
        if last is not None:
            out += [((OTHER,),)] * min(place - last - 1, NEGATION_REACH)
        out.append(reading)
        last = place
    return tuple(out)


def _words(text: str) -> list[bytes]:
    return WORD.findall(text.encode().translate(UPPER_TO_LOWER.tobytes()))


def learn_insults(sample: list[tuple[str, int]], least_docs: int = 4, least_odds: float = 2.0) -> tuple[dict[bytes, float], dict[bytes, float]]:
    """Words, and beginnings of longer words, whose log odds of standing in a toxic document are high; with weights."""
    words, prefixes, made_of, docs = (Counter(), Counter()), (Counter(), Counter()), {}, [0, 0]
    for text, label in sample:
        docs[label] += 1
        own = set(_words(text))
        words[label].update(own)
        beginnings = set()
        for w in own:
            for k in PREFIX_BYTES:
                if len(w) > k:
                    beginnings.add(w[:k])
                    if label:
                        made_of.setdefault(w[:k], set()).add(w)
        prefixes[label].update(beginnings)

    def chosen(counts):
        out = {}
        for w, n in counts[1].items():
            odds = math.log((n + 0.5) / (docs[1] + 1)) - math.log((counts[0][w] + 0.5) / (docs[0] + 1))
            if n >= least_docs and odds >= least_odds:
                out[w] = min(odds, 5.0) / 2
        return out

    if not docs[1] or not docs[0]:
        return {}, {}
    return chosen(words), {p: w for p, w in chosen(prefixes).items() if len(made_of[p]) >= 4}


class Grammar:
    """The lexicon transducer's arcs (words and beginnings of words by hash) and the features of documents."""

    def __init__(self, words: dict[bytes, float], prefixes: dict[bytes, float]):
        table: dict[int, dict[bytes, set]] = {0: {}}
        for symbol, seeds in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            for w in seeds:
                table[0].setdefault(w.encode(), set()).add((symbol,))
        for w, x in ({w.encode(): SEED_WEIGHT for w in INSULTS} | words).items():
            table[0].setdefault(w, set()).add(insult(x))
        for p, x in prefixes.items():
            table.setdefault(len(p), {})[p] = {insult(x)}
        self.readings: list[tuple] = [((OTHER,),)]
        self.tables = []
        for length, entries in sorted(table.items(), reverse=True):
            data = np.frombuffer(b"".join(entries), np.uint8)
            ends = np.cumsum([len(w) for w in entries])
            hashes = span_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64))
            order = np.argsort(hashes)
            numbers = np.arange(len(self.readings), len(self.readings) + len(entries))
            self.readings += [tuple(sorted(x, key=str)) for x in entries.values()]
            self.tables.append((length, hashes[order], numbers[order]))
        self.insulting = np.array([any(x[0] == "insult" for x in r) for r in self.readings])
        self.harmful = np.array([any(x[0] in ("insult", THREAT) for x in r) for r in self.readings])

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per row: log of the summed clause scores, the largest, log of matched clauses and of matched distinct words, density."""
        data, offsets = utf8_bytes(texts)
        data = UPPER_TO_LOWER[data]
        starts, ends, of_row = runs(WORD_BYTE[data], offsets)
        out = np.zeros((len(offsets) - 1, 5))
        if not len(starts):
            return out
        reading = np.zeros(len(starts), np.int64)
        # Longest beginnings first; a whole word that is listed overrules them.
        for length, hashes, numbers in self.tables:
            if length:
                some = np.flatnonzero((ends - starts > length) & (reading == 0))
                own = span_hashes(data, starts[some], starts[some] + length)
            else:
                some, own = np.arange(len(starts)), span_hashes(data, starts, ends)
            at = np.searchsorted(hashes, own)
            at[at == len(hashes)] = 0
            found = hashes[at] == own
            reading[some[found]] = numbers[at[found]]
        hits = np.flatnonzero(self.harmful[reading])
        if not len(hits):
            return out
        row = np.searchsorted(of_row, np.arange(len(starts)), "right") - 1
        clause = np.cumsum(CLAUSE_END[data])[starts] + row
        said = np.flatnonzero(reading)
        edges = np.searchsorted(clause[said], np.unique(clause[hits]))
        upto = np.searchsorted(clause[said], np.unique(clause[hits]), "right")
        total: dict[int, list] = {}
        for lo, hi in zip(edges, upto):
            own = said[lo:hi]
            score = clause_score(clause_word(own.tolist(), [self.readings[i] for i in reading[own].tolist()]))
            if score > 0:
                t = total.setdefault(int(row[own[0]]), [0.0, 0.0, 0, set()])
                t[0], t[1], t[2] = t[0] + score, max(t[1], score), t[2] + 1
                t[3].update(data[starts[i] : ends[i]].tobytes() for i in own if self.insulting[reading[i]])
        for r, (score, largest, clauses, distinct) in total.items():
            n = of_row[r + 1] - of_row[r]
            out[r] = math.log1p(score), min(largest, 10.0), math.log1p(clauses), math.log1p(len(distinct)), min(1.0, 100 * score / n / 20)
        return out


class ToxicityModel:
    def __init__(self, grammar: Grammar):
        self.grammar, self.coef = grammar, np.array([-4.0, 1.5, 0.5, 0.5, 0.5, 0.5])

    def fit(self, features: np.ndarray, labels: list[int], rounds: int = 30, ridge: float = 0.1) -> ToxicityModel:
        """Newton's method on the logistic loss with a ridge towards zero (not for the constant)."""
        y = np.array(labels, float)
        if not len(y) or y.min() == y.max():
            return self
        x = np.hstack([np.ones((len(y), 1)), features])
        coef, pull = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
        pull[0, 0] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + pull, x.T @ (y - p) - pull @ coef)
            coef = coef + step
            if np.abs(step).max() < 1e-8:
                break
        self.coef = coef
        return self

    def score(self, texts: pa.Array) -> np.ndarray:
        logit = self.coef[0] + self.grammar.features(texts) @ self.coef[1:]
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def fit_sample(sample: list[tuple[str, int]]) -> ToxicityModel:
    """The lexicon comes from the whole sample; the logistic weights from each half read with the other half's lexicon."""
    halves, parts = (sample[::2], sample[1::2]), []
    for own, other in zip(halves, reversed(halves)):
        grammar = Grammar(*learn_insults(other))
        parts += [grammar.features(pa.array([t for t, _ in own[lo : lo + 200]], pa.string())) for lo in range(0, len(own), 200)]
    model = ToxicityModel(Grammar(*learn_insults(sample)))
    return model.fit(np.concatenate([*parts, np.zeros((0, 5))]), [y for half in halves for _, y in half])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 8_000) -> ToxicityModel:
    return fit_sample(labelled_sample(docs, labels, "toxic", sample_rows))


def _score(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in steps(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(model.score(batch.column("text")))})

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 8_000, threshold: float = 0.7) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, sample_rows))
    scored = no_clash(docs, "doc_id", "text").mapInArrow(_score(model), "doc_id bigint, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
