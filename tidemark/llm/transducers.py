"""Weighted finite-state transducers without empty symbols, and their composition.

Weights add up along a path, and of several paths the heaviest counts. A machine may be
nondeterministic: it guesses what comes later, and paths whose guess was wrong do not end
in a final state.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import product

State = Hashable
Symbol = Hashable
#: What an arc reads and writes, its weight, and the state it leads to.
Arc = tuple[Symbol, Symbol, float, State]


@dataclass(frozen=True)
class Transducer:
    starts: tuple[State, ...]
    arcs: dict[State, tuple[Arc, ...]]
    finals: frozenset[State]

    @classmethod
    def of(
        cls,
        alphabet: Iterable[Symbol],
        starts: Sequence[State],
        step: Callable[[State, Symbol], Iterable[tuple[Symbol, float, State]]],
        final: Callable[[State], bool] = lambda state: True,
    ) -> Transducer:
        """From a rule that tells what a state writes and where it goes at a symbol."""
        letters = list(dict.fromkeys(alphabet))
        return _reached(starts, lambda s: ((a, *rest) for a in letters for rest in step(s, a)), final)

    def writes(self) -> set[Symbol]:
        return {out for arcs in self.arcs.values() for _, out, _, _ in arcs}

    def paths(self, word: Sequence[Symbol]) -> Iterator[tuple[float, tuple[Symbol, ...]]]:
        """Weight and output of every path that reads the whole word; for tests and small words."""
        live = [(0.0, (), s) for s in self.starts]
        for letter in word:
            live = [
                (weight + w, (*out, o), t)
                for weight, out, s in live for read, o, w, t in self.arcs[s] if read == letter
            ]
        yield from ((weight, out) for weight, out, s in live if s in self.finals)


def _reached(starts, arcs_of, final) -> Transducer:
    """The states that a start leads to and that lead to a final state."""
    arcs, todo = {}, list(starts)
    while todo:
        state = todo.pop()
        if state not in arcs:
            arcs[state] = tuple(arcs_of(state))
            todo += [arc[3] for arc in arcs[state]]
    finals = frozenset(s for s in arcs if final(s))
    useful, before = set(finals), set()
    while useful != before:
        before = set(useful)
        useful |= {s for s, out in arcs.items() if any(arc[3] in before for arc in out)}
    return Transducer(
        tuple(s for s in starts if s in useful),
        {s: tuple(arc for arc in out if arc[3] in useful) for s, out in arcs.items() if s in useful},
        finals,
    )


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that reads as ``first`` and writes what ``second`` makes of its output."""

    def arcs_of(state):
        for read, middle, weight, left in first.arcs[state[0]]:
            for taken, out, more, right in second.arcs[state[1]]:
                if taken == middle:
                    yield read, out, weight + more, (left, right)

    return _reached(
        list(product(first.starts, second.starts)), arcs_of,
        lambda state: state[0] in first.finals and state[1] in second.finals,
    )
