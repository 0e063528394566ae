"""Recompression of word sequences: rounds that name runs and pairs of symbols.

A symbol is named by a hash of the names it is made of, so all tasks use the same names
without asking each other. Alongside, every symbol carries its *context*: the words that
decided that it stands there. Wherever these words occur again, so does the symbol.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.llm.words import U64, Words, mix

_FAR = np.int64(1) << np.int64(60)
_NAME = (U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB))
_SIDE = 0x8EBC6AF09C88C6E3


@dataclass
class Symbols:
    """The symbols of some texts in order, with the words ``[low, high)`` that fix each."""

    names: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    low: np.ndarray
    high: np.ndarray
    texts: np.ndarray

    def take(self, at: np.ndarray) -> Symbols:
        return Symbols(*(part[at] for part in vars(self).values()))

    def joined(self) -> np.ndarray:
        """Whether a symbol and the next one belong to the same text."""
        return self.texts[1:] == self.texts[:-1]


def _outer(s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """How far the neighbours' contexts reach; without a neighbour, beyond every window."""
    low, high = np.full(len(s.names), -_FAR), np.full(len(s.names), _FAR)
    same = s.joined()
    low[1:][same] = s.low[:-1][same]
    high[:-1][same] = s.high[1:][same]
    return np.minimum(low, s.low), np.maximum(high, s.high)


def name_runs(s: Symbols) -> Symbols:
    """Replace each maximal run of one symbol; both neighbours decide where it ends."""
    if len(s.names) < 2:
        return s
    repeats = np.concatenate([[False], (s.names[1:] == s.names[:-1]) & s.joined()])
    low, high = _outer(s)
    heads = np.flatnonzero(~repeats)
    lengths = np.diff(np.append(heads, len(repeats)))
    tails = heads + lengths - 1
    names = s.names[heads]
    long = lengths > 1
    names[long] = mix(names[long] * _NAME[0] + mix(lengths[long].astype(U64)))
    return Symbols(names, s.starts[heads], s.ends[tails], low[heads], high[tails], s.texts[heads])


def name_pairs(s: Symbols, round_: int, longest: int) -> Symbols:
    """Replace each left symbol with a right one after it.

    A hash deals names into left and right ones, anew in each round; symbols of over
    ``longest`` words are neither. A pair is fixed by its own two symbols; a left symbol
    that stays alone also needs the next one, a right symbol the one before.
    """
    if len(s.names) < 2:
        return s
    side = mix(s.names ^ U64((round_ + 1) * _SIDE % (1 << 64))) >> U64(63) == 0
    short = s.ends - s.starts <= longest
    left, right = side & short, ~side & short
    pair = left[:-1] & right[1:] & s.joined()
    first, second = np.append(pair, False), np.insert(pair, 0, False)
    low, high = _outer(s)
    s = Symbols(s.names.copy(), s.starts, s.ends.copy(), s.low.copy(), s.high.copy(), s.texts)
    alone = left & ~first
    s.high[alone] = high[alone]
    alone = right & ~second
    s.low[alone] = low[alone]
    at, after = np.flatnonzero(first), np.flatnonzero(second)
    s.names[at] = mix(mix(s.names[at] * _NAME[1]) + s.names[after])
    s.ends[at] = s.ends[after]
    s.low[at] = np.minimum(s.low[at], s.low[after])
    s.high[at] = np.maximum(s.high[at], s.high[after])
    return s.take(np.flatnonzero(~second))


def recompress(words: Words, hashes: np.ndarray, rounds: int, longest: int, run_rounds: tuple[int, ...]) -> Symbols:
    """The symbols of the texts after ``rounds`` rounds, runs named before ``run_rounds``."""
    at = np.arange(len(hashes))
    s = Symbols(hashes, at, at + 1, at, at + 1, words.text_of_words())
    for round_ in range(rounds):
        if round_ in run_rounds:
            s = name_runs(s)
        s = name_pairs(s, round_, longest)
    return s


def covering(begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which positions lie in at least one of the ranges ``[begin, end)``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, np.maximum(begin, 0), 1)
    np.add.at(change, np.minimum(end, size), -1)
    return np.cumsum(change[:-1]) > 0
