"""Weighted finite-state transducers without epsilon arcs; weights add up along a path and the best path counts."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence
from dataclasses import dataclass, field

State = Hashable
Symbol = Hashable


@dataclass
class Transducer:
    start: State
    final: dict[State, float] = field(default_factory=dict)
    arcs: dict[State, dict[Symbol, list[tuple[Symbol, float, State]]]] = field(default_factory=dict)

    def arc(self, state: State, read: Symbol, write: Symbol, weight: float, to: State) -> None:
        self.arcs.setdefault(state, {}).setdefault(read, []).append((write, weight, to))


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that hands what a writes to b; only states that can be reached are made."""
    out = Transducer((a.start, b.start))
    todo, seen = [out.start], {out.start}
    while todo:
        state = x, y = todo.pop()
        if x in a.final and y in b.final:
            out.final[state] = a.final[x] + b.final[y]
        for read, arcs in a.arcs.get(x, {}).items():
            for between, w, x_to in arcs:
                for write, v, y_to in b.arcs.get(y, {}).get(between, ()):
                    out.arc(state, read, write, w + v, (x_to, y_to))
                    if (x_to, y_to) not in seen:
                        seen.add((x_to, y_to))
                        todo.append((x_to, y_to))
    return out


def best(machine: Transducer, word: Sequence[Iterable[Symbol]]) -> float | None:
    """The weight of the best accepting path over a word, each place of which may be read as any of its symbols; None if
    there is no such path (Viterbi's algorithm)."""
    at = {machine.start: 0.0}
    for readings in word:
        then: dict[State, float] = {}
        for state, weight in at.items():
            arcs = machine.arcs.get(state, {})
            for symbol in readings:
                for _, w, to in arcs.get(symbol, ()):
                    if weight + w > then.get(to, float("-inf")):
                        then[to] = weight + w
        at = then
    return max((w + machine.final[s] for s, w in at.items() if s in machine.final), default=None)
