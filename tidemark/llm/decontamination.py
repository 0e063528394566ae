"""Benchmark passages in training documents: rare n-gram seeds, then Smith-Waterman.

Words are lower-cased (A-Z) and lose ASCII punctuation at both ends. A seed is the
shortest n-gram from a word of an item on that is rare: the product of the corpus
frequencies of its words is small, so it is not met by chance, however often a leaked item
itself is copied. Around the seeds that a document holds, its words are aligned with the
item's; the score is the best local alignment over the score of the item with itself.

Edits spread evenly can break every rare seed. Yet an alignment that lacks a share x of the
item's own score lacks at most 4 x / 3 n of its n - 1 pairs of neighbours: a word lost in it
costs 3 and breaks two pairs, one lost at an end costs 2 and breaks one, and so do two words
put between a pair. The other pairs stand in the passage with one word between them at most.
So places where an item has that many pairs close together, rare or not, are aligned too.

The items go to the tasks in blocks of a bounded number of words, each of which is held
against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U64, Words, mix, signed, slices, texts_of
from tidemark.operators.staging import stored

MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of the shortest and longest seed; shorter items are one seed.
SEED_WORDS = (2, 8)
#: A seed's chance to start at a word of the corpus, if words were independent.
RARE = 1e-8
#: Pairs of a higher chance aren't counted, as far as an item can do without.
COMMON = 1e-4
#: Words of the items that a pass over the documents looks for.
BLOCK_WORDS = 1 << 20

_EDGES = np.zeros(256, bool)
_EDGES[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def bare_words(texts: pa.Array) -> Words:
    """Lower-cased words without punctuation at their ends; words of nothing else go."""
    words = Words.of(texts, lower=True)
    starts, ends = words.starts.copy(), words.ends.copy()
    at = np.arange(len(starts))
    while len(at := at[(starts[at] < ends[at]) & _EDGES[words.data[starts[at]]]]):
        starts[at] += 1
    at = np.arange(len(ends))
    while len(at := at[(starts[at] < ends[at]) & _EDGES[words.data[ends[at] - 1]]]):
        ends[at] -= 1
    keep = starts < ends
    before = np.concatenate([[0], np.cumsum(keep)])
    return Words(words.data, starts[keep], ends[keep], before[words.first])


class Lookup:
    """Sorted numbers, behind a bit table that most absent numbers don't pass."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = np.unique(numbers)
        self.shift = U64(64 - max(16, int(len(self.numbers)).bit_length() + 4))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[(self.numbers >> self.shift).astype(np.int64)] = True

    def find(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``numbers`` of those that are held, and where they are held."""
        likely = np.flatnonzero(self.table[(numbers >> self.shift).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.numbers, numbers[likely]), len(self.numbers) - 1)
        found = self.numbers[at] == numbers[likely] if len(self.numbers) else np.zeros(0, bool)
        return likely[found], at[found]


def _count_words(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How often each wanted word occurs in the task, and all words under the number 0."""
    lookup, total = Lookup(wanted), 0
    counts = np.zeros(len(lookup.numbers), np.int64)
    for batch in batches:
        texts = texts_of(batch.column(0))
        for begin, end in slices(texts):
            words = bare_words(texts[begin:end])
            total += len(words.starts)
            counts += np.bincount(lookup.find(words.hashes())[1], minlength=len(counts))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(signed(lookup.numbers), 0)), pa.array(np.append(counts, total))], ["word", "n"]
    )


def word_pairs(hashes: np.ndarray, apart: int) -> np.ndarray:
    """A hash of each word and the one ``apart`` words on."""
    return mix(hashes[:-apart] * U64(0x5851F42D4C957F2D) + hashes[apart:])


class Items:
    """A block of benchmark items: their words and their seeds."""

    def __init__(self, ids: list, texts: list):
        words = bare_words(texts_of(pa.array(texts, pa.string())))
        self.ids, self.first, self.hashes = ids, words.first, words.hashes()
        self.words = words

    def words_of(self, item: int) -> np.ndarray:
        return self.hashes[self.first[item] : self.first[item + 1]]

    def choose_seeds(self, frequency: dict[int, float], rare: float, least: float) -> None:
        """``seeds``: by number of words, the n-grams and the words of the block they start at;
        ``pairs``: the pairs to count, and their items."""
        chance = np.log(np.array([max(frequency.get(int(h), 0.0), 1e-12) for h in signed(self.hashes)] or [1.0]))
        sums = np.concatenate([[0.0], np.cumsum(chance)])
        shortest, longest = SEED_WORDS
        last = np.repeat(self.first[1:], np.diff(self.first))
        at = np.arange(len(self.hashes))
        open_ = at + shortest <= last
        lengths = np.diff(self.first)
        chosen: dict[int, np.ndarray] = {}
        for n in range(shortest, longest + 1):
            here = at[open_ & (at + n <= last)]
            take = here if n == longest else here[sums[here + n] - sums[here] <= np.log(rare)]
            chosen[n] = take
            open_[take] = False
        # an item that has no seed so far: all of its words
        taken = np.concatenate(list(chosen.values()))
        seeded = np.bincount(np.searchsorted(self.first, taken, "right") - 1, minlength=len(lengths)) > 0
        for item in np.flatnonzero(~seeded & (lengths > 0)):
            n = min(int(lengths[item]), longest)
            chosen[n] = np.append(chosen.get(n, np.zeros(0, np.int64)), self.first[item]).astype(np.int64)
        self.seeds = {}
        for n, starts in chosen.items():
            if len(starts):
                grams = self.words.runs(self.hashes, n)[starts]
                order = np.argsort(grams, kind="stable")
                self.seeds[n] = (Lookup(grams), grams[order], starts[order])
        self._choose_pairs(chance, least)
        self.words = None  # only hashes go to the tasks

    def _choose_pairs(self, chance: np.ndarray, least: float) -> None:
        lengths = np.diff(self.first)
        #: Pairs that a passage of the item has at least, and words it has at most.
        self.need = lengths - 1 - np.floor(4 * lengths * (1 - least) / 3 + 1e-9).astype(np.int64)
        self.span = np.floor(lengths * (3 - 2 * least) + 1e-9).astype(np.int64)
        values, owners = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for item in np.flatnonzero(self.need > 0):
            begin, end = self.first[item], self.first[item + 1]
            pairs = word_pairs(self.hashes[begin:end], 1)
            both = chance[begin : end - 1] + chance[begin + 1 : end]
            common = np.argsort(-both, kind="stable")[: (self.need[item] - 1) // 2]
            common = common[both[common] > np.log(COMMON)]
            self.need[item] -= len(common)
            pairs = np.unique(np.delete(pairs, common))
            values.append(pairs)
            owners.append(np.full(len(pairs), item))
        values, owners = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(values, kind="stable")
        self.pairs = (Lookup(values), values[order], owners[order])

    def crowded(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, item, begin and end of the places that hold as many pairs of an item as needed."""
        lookup, values, owners = self.pairs
        found = [np.zeros((2, 0), np.int64)]
        for apart in (1, 2):
            if len(hashes) <= apart or not len(values):
                continue
            at, number = lookup.find(word_pairs(hashes, apart))
            whole = words.full_runs(apart + 1)[at]
            at, pair = at[whole], lookup.numbers[number[whole]]
            low = np.searchsorted(values, pair, "left")
            times = np.searchsorted(values, pair, "right") - low
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            found.append(np.stack([owners[np.repeat(low, times) + nth], np.repeat(at, times)]))
        item, at = np.concatenate(found, axis=1)
        key = np.unique(item * (len(hashes) + 1) + at)
        item, at = np.divmod(key, len(hashes) + 1)
        text = np.searchsorted(words.first, at, "right") - 1
        last = np.arange(len(at)) + self.need[item] - 1
        inside = last < len(at)
        last = np.minimum(last, max(len(at) - 1, 0))
        close = inside & (item[last] == item) & (text[last] == text) & (at[last] - at < self.span[item])
        text, item, at, last = text[close], item[close], at[close], at[last[close]]
        begin = np.maximum(last - self.span[item] + 1, words.first[text])
        return text, item, begin, np.minimum(at + self.span[item], words.first[text + 1])

    def hits(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all seeds found: the item, the word of the texts, and the item's word there."""
        found = [(np.zeros(0, np.int64),) * 3]
        for n, (lookup, grams, starts) in self.seeds.items():
            at, number = lookup.find(words.runs(hashes, n))
            whole = words.full_runs(n)[at]
            at, gram = at[whole], lookup.numbers[number[whole]]
            # a seed may stand at several words of the block
            low = np.searchsorted(grams, gram, "left")
            times = np.searchsorted(grams, gram, "right") - low
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            start = starts[np.repeat(low, times) + nth]
            item = np.searchsorted(self.first, start, "right") - 1
            found.append((item, np.repeat(at, times), start - self.first[item]))
        return tuple(np.concatenate(x) for x in zip(*found))


def local_alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Score of the best local alignment, and where in the passage it ends."""
    slope = np.arange(len(passage) + 1) * -GAP
    above = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(len(passage) + 1, np.int64)
        row[1:] = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        row = np.maximum(np.maximum(row, above + GAP), 0)
        # gaps along the passage: the best cell before, less the way from there
        above = np.maximum.accumulate(row + slope) - slope
        if (top := int(above.max())) > best:
            best, end = top, int(above.argmax())
    return best, end


def _regions(items: Items, words: Words, hits: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int, int, int]]:
    """``(text, item, begin, end)``: words of a text around the hits of an item, half an
    item wider than it on either side; regions that touch are one."""
    item, at, offset = hits
    lengths = np.diff(items.first)[item]
    text = np.searchsorted(words.first, at, "right") - 1
    begin = np.maximum(at - offset - lengths // 2, words.first[text])
    end = np.minimum(at - offset + lengths + lengths // 2, words.first[text + 1])
    return _joined(text, item, begin, end)


def _joined(
    text: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> Iterator[tuple[int, int, int, int]]:
    order = np.lexsort((begin, item, text))
    held = None
    for here in zip(*(x[order].tolist() for x in (text, item, begin, end))):
        if held and held[:2] == here[:2] and here[2] <= held[3]:
            held = (*held[:3], max(held[3], here[3]))
            continue
        if held:
            yield held
        held = here
    if held:
        yield held


def _passages(items: Items, item: int, passage: np.ndarray, least: float) -> Iterator[tuple[float, int, int]]:
    """Score, begin and end of the alignments of an item that are good enough: the best
    one, then those of what stands before and after it, and so on."""
    whole = items.words_of(item)
    full = MATCH * len(whole)
    parts = [(0, len(passage))]
    while parts:
        begin, end = parts.pop()
        part = passage[begin:end]
        if MATCH * np.isin(part, whole).sum() < least * full:
            continue
        score, stop = local_alignment(whole, part)
        if score < least * full:
            continue
        # the same alignment read backwards ends where this one starts
        start = stop - local_alignment(whole[::-1], part[:stop][::-1])[1]
        yield score / full, begin + start, begin + stop
        parts += [(begin, begin + start), (begin + stop, end)]


def _align(batches: Iterator[pa.RecordBatch], items: Items, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        rows = []
        for first, last in slices(texts):
            words = bare_words(texts[first:last])
            hashes = words.hashes()
            told: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for text, item, begin, end in _regions(items, words, items.hits(words, hashes)):
                here = begin - words.first[text]
                for score, start, stop in _passages(items, item, hashes[begin:end], least):
                    told.setdefault((text, item), []).append((begin, end))
                    rows.append((first + text, items.ids[item], score, here + start, here + stop))
            for text, item, begin, end in _joined(*items.crowded(words, hashes)):
                passage = hashes[begin:end]
                # what a seed has told isn't told again
                for start, stop in told.get((text, item), ()):
                    if passage.base is not None:
                        passage = passage.copy()
                    passage[max(start - begin, 0) : max(stop - begin, 0)] = 0
                here = begin - words.first[text]
                for score, start, stop in _passages(items, item, passage, least):
                    rows.append((first + text, items.ids[item], score, here + start, here + stop))
        if rows:
            at, item_id, score, start, stop = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.array(item_id, pa.int64()),
                    pa.array(score, pa.float64()),
                    pa.array(start, pa.int64()),
                    pa.array(stop, pa.int64()),
                ],
                ["doc_id", "item_id", "score", "start_word", "end_word"],
            )


def benchmark_passages(
    docs: DataFrame, benchmark: DataFrame, least: float = 0.5, rare: float = RARE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``(doc_id, item_id, score, start_word, end_word)``: passages of documents that align
    with a benchmark item at ``least`` of the item's own score, or better.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``. Each
    passage is one row, also where several of one item stand side by side; its words are counted among the bare words of the document (see
    :func:`bare_words`). A match scores 2, another word or a gap -1.

    Null and empty texts, and items without words, match nothing. Null and repeated ids
    are carried as they are: each row of ``docs`` and of ``benchmark`` stands for itself.
    Items of so few words that a passage may have none of their pairs (3 at ``least`` 0.5) are
    found only by a rare n-gram of 2 words, or by all their words.
    """
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    n_words = F.size(F.split("text", r"[\x20\x09-\x0D]+")).cast("long")
    size = items.agg(F.sum(n_words)).first()[0] or 0
    blocks = max(1, -(-size // block_words))
    items = stored(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    schema = "doc_id long, item_id long, score double, start_word long, end_word long"
    found = None
    for block in range(blocks):
        # about block_words words, whatever the size of the benchmark
        rows = items.where(F.col("block") == block).orderBy("item_id", "text").collect()
        held = Items([r.item_id for r in rows], [r.text for r in rows])
        wanted = np.unique(held.hashes)
        counts = dict(
            texts.select("text").mapInArrow(partial(_count_words, wanted=wanted), "word long, n long")
            .groupBy("word").agg(F.sum("n")).collect()
        )
        total = max(counts.pop(0, 0), 1)
        held.choose_seeds({word: n / total for word, n in counts.items()}, rare, least)
        here = texts.mapInArrow(partial(_align, items=held, least=least), schema)
        if blocks > 1:
            here = stored(here, "passages")
        found = here if found is None else found.union(here)
    return found
