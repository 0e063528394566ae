"""Words of many texts at once, as numpy arrays inside a task.

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes are two
independent 64-bit lanes over the bytes of a word; they depend on the word alone, so
every executor gives the same word the same number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], U64)
#: Longer words are hashed one by one.
_LANE_BYTES = 64
_SEEDS = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
_MULTIPLY = U64(0xD6E8FEB86659FD93)
#: Bases of the polynomials over words; 3 or 5 modulo 8, so that powers differ in their low bits.
_BASES = (0x5851F42D4C957F2D, 0x14057B7EF767814B)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole 64-bit number; one to one."""
    x = (x ^ (x >> U64(32))) * _MULTIPLY
    x = (x ^ (x >> U64(29))) * _MULTIPLY
    return x ^ (x >> U64(32))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's LongType holds them."""
    return x.view(np.int64)


def texts_of(column: pa.Array) -> pa.Array:
    """A text column with 64-bit offsets, null as the empty text."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(*texts: pa.Array, most_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text each; a longer row stands alone."""
    sizes = np.cumsum(sum(np.asarray(pc.binary_length(column)) for column in texts), dtype=np.int64)
    begin = 0
    while begin < len(sizes):
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + most_bytes, "right")))
        yield begin, end
        begin = end


@dataclass
class Words:
    """The words of some texts. ``first[d]`` to ``first[d + 1]`` are those of text ``d``."""

    data: np.ndarray  # the bytes of all texts, then eight zeros
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray | None = None  # where the texts begin in ``data``, and the last ends

    @classmethod
    def of(cls, texts: pa.Array, lower: bool = False, apart: np.ndarray = _SPACE) -> Words:
        """From :func:`texts_of`; ``lower`` lower-cases A-Z, ``apart`` tells the bytes between words."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.zeros(int(offsets[-1] - offsets[0]) + 8, np.uint8)
        if raw is not None:
            data[:-8] = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        if lower:
            data = _LOWER[data]
        inside = ~apart[data[:-8]]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[edges] = inside[edges]
        edges = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        stops[edges] = inside[edges]
        starts = np.flatnonzero(begins)
        return cls(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets), offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """One lane of the word hashes."""
        lengths = self.ends - self.starts
        # every eight bytes of the data as one number, at any position
        eights = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        out = lengths.astype(U64) * _SEEDS[lane] + _SEEDS[1 - lane]
        at, step = np.arange(len(out)), 0
        while len(at):
            here = eights[self.starts[at] + step] & _KEEP[np.minimum(lengths[at] - step, 8)]
            out[at] = mix(out[at] ^ here) + _SEEDS[lane]
            step += 8
            at = at[lengths[at] > step]
            if step == _LANE_BYTES:
                for i in at:
                    whole = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), seed=lane)
                    out[i] = U64(whole) ^ _SEEDS[lane]
                break
        return mix(out)

    def runs(self, hashes: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
        """A hash of the ``k`` words from each word on; wrong where a text ends before."""
        out = np.zeros(len(hashes), U64)
        n = len(hashes) - k + 1
        if n <= 0:
            return out
        if k <= 8:
            total = hashes[:n].copy()
            for j in range(1, k):
                total = total * U64(_BASES[lane]) + hashes[j : j + n]
        else:
            base = U64(_BASES[lane])
            powers = np.cumprod(np.concatenate([[U64(1)], np.full(len(hashes), base, U64)]))
            inverse = U64(pow(_BASES[lane], -1, 1 << 64))
            back = np.cumprod(np.concatenate([[U64(1)], np.full(n - 1, inverse, U64)]))
            sums = np.concatenate([[U64(0)], np.cumsum(hashes * powers[:-1])])
            total = (sums[k:] - sums[:-k]) * back
        out[:n] = mix(total ^ U64(k))
        return out

    def full_runs(self, k: int) -> np.ndarray:
        """Whether the ``k`` words from each word on all lie in its text."""
        last = np.repeat(self.first[1:], self.counts())
        return np.arange(len(self.starts)) + k <= last

    def text_of_words(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())
