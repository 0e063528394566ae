"""Ranked lexical search of query items over all documents, by bag deduplication.

A document is cut down to the terms some item asks for: its *bag* of (term, occurrences).
Together with the length factor ``m`` the bag decides every score, so documents with equal
bags and ``m`` are one class, known by a hash and verified by the bag itself. Each class is
scored once, against all items; the best classes of an item are then expanded to their
members by ascending doc_id.

A class outside an item's first ``top`` classes, by score and least doc_id, has ``top``
documents before its own first one. So the first ``top`` classes hold the whole answer, and
of each class its ``top`` least doc_ids are enough.

The items go to the tasks in blocks of a bounded number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import Words, slices, texts_of
from tidemark.operators.staging import stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words of the items that a pass over the documents looks for.
BLOCK_WORDS = 1 << 18
#: Scores a task holds at once, and (class, term, item) meetings.
_SCORES, _MEETINGS = 1 << 22, 1 << 23
#: Whole numbers up to here are exact in doubles.
_EXACT = 1 << 53

_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_ENTRY = np.dtype([("term", "<u4"), ("times", "<u4")])


def terms_of(texts: pa.Array) -> Words:
    return Words.of(texts, lower=True, apart=_APART)


@dataclass
class Items:
    """A block of items: the terms they ask for, and the items of each term."""

    vocabulary: np.ndarray  # sorted hashes
    first: np.ndarray  # the items of term t are items[first[t] : first[t + 1]]
    items: np.ndarray
    size: int

    @classmethod
    def of(cls, texts: list) -> Items:
        words = terms_of(texts_of(pa.array(texts, pa.string())))
        pairs = np.unique(np.rec.fromarrays([words.hashes(), words.text_of_words()], names="term,item"))
        vocabulary, first = np.unique(pairs["term"], return_index=True)
        return cls(vocabulary, np.append(first, len(pairs)), np.asarray(pairs["item"]), len(texts))


def _bags(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for begin, end in slices(texts):
            words = terms_of(texts[begin:end])
            hashes = words.hashes()
            at = np.searchsorted(vocabulary, hashes)
            held = at < len(vocabulary)
            held[held] = vocabulary[at[held]] == hashes[held]
            keys, times = np.unique(
                words.text_of_words()[held] * (len(vocabulary) + 1) + at[held], return_counts=True
            )
            of, term = np.divmod(keys, len(vocabulary) + 1)
            entries = np.empty(len(keys), _ENTRY)
            entries["term"], entries["times"] = term, times
            bounds = np.searchsorted(of, np.arange(end - begin + 1))
            raw = entries.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[begin:end],
                    pa.array(words.counts().astype(np.int64)),
                    pa.array([raw[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                ],
                ["doc_id", "n", "bag"],
            )


def _entries(bags: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The entries of some bags, and how many each has."""
    lengths = np.asarray([len(b) for b in bags.to_pylist()], np.int64) // 8
    return np.frombuffer(b"".join(bags.to_pylist()), _ENTRY), lengths


def _holders(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[pa.RecordBatch]:
    """How many documents of the task hold each term."""
    counts = np.zeros(terms, np.int64)
    for batch in batches:
        counts += np.bincount(_entries(batch.column(0))[0]["term"], minlength=terms)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(terms)), pa.array(counts)], ["term", "df"])


class Best:
    """The ``top`` best classes of each item, by score, then by least doc_id, null last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.held: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: list, rows: list) -> None:
        """``scores[class, item]``, the least doc_id of each class and what to return of it."""
        for item in np.flatnonzero((scores >= self.least).any(axis=0)).tolist():
            column = scores[:, item]
            at = np.flatnonzero(column >= self.least[item])
            if len(at) > self.top:
                # equal scores at the edge all stay; their ids decide
                edge = np.partition(column[at], len(at) - self.top)[len(at) - self.top]
                at = at[column[at] >= edge]
            found = [(-int(column[i]), ids[i] is None, ids[i] or 0, rows[i]) for i in at.tolist()]
            held = sorted(self.held[item] + found, key=lambda x: x[:3])[: self.top]
            self.held[item] = held
            if len(held) == self.top:
                self.least[item] = -held[-1][0]


def _score(
    batches: Iterator[pa.RecordBatch], items: Items, weights: np.ndarray, top: int
) -> Iterator[pa.RecordBatch]:
    best = Best(items.size, top)
    fan = np.diff(items.first)
    most_terms = int(np.bincount(items.items, minlength=1).max()) if len(items.items) else 0
    exact = int(weights.max(initial=0)) * 1_000_000 * most_terms < _EXACT
    most_rows = max(1, _SCORES // max(items.size, 1))
    for batch in batches:
        entries, lengths = _entries(batch.column("bag"))
        ends = np.cumsum(np.append(0, lengths))
        meetings = np.concatenate([[0], np.cumsum(fan[entries["term"]])])[ends]
        m = np.repeat(np.asarray(batch.column("m")), lengths)
        ids, prints = batch.column("least").to_pylist(), batch.column("print").to_pylist()
        ms, bags = batch.column("m").to_pylist(), batch.column("bag").to_pylist()
        begin = 0
        while begin < len(ids):
            end = int(np.searchsorted(meetings, meetings[begin] + _MEETINGS, "right")) - 1
            end = min(max(end, begin + 1), begin + most_rows, len(ids))
            part = slice(ends[begin], ends[end])
            term, times = entries["term"][part].astype(np.int64), entries["times"][part].astype(np.int64)
            value = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[part]))
            row = np.repeat(np.arange(end - begin), lengths[begin:end])
            n = fan[term]
            place = np.arange(n.sum()) + np.repeat(items.first[term] - np.cumsum(n) + n, n)
            cell = np.repeat(row, n) * items.size + items.items[place]
            value = np.repeat(value, n)
            if exact:
                sums = np.bincount(cell, value, (end - begin) * items.size).astype(np.int64)
            else:
                sums = np.zeros((end - begin) * items.size, np.int64)
                np.add.at(sums, cell, value)
            rows = list(zip(prints[begin:end], ms[begin:end], bags[begin:end]))
            best.add(sums.reshape(end - begin, items.size), ids[begin:end], rows)
            begin = end
    rows = [(item, -x[0], None if x[1] else x[2], *x[3]) for item, held in enumerate(best.held) for x in held]
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(columns, kinds)], ["item", "score", "least", "print", "m", "bag"]
    )


def _search_block(texts: DataFrame, items: list, top: int) -> DataFrame:
    """``(item, rank, doc_id, score)`` with the place of the item in ``items``."""
    held = Items.of([row.text for row in items])
    bags = stored(
        texts.mapInArrow(partial(_bags, vocabulary=held.vocabulary), "doc_id long, n long, bag binary"), "bags"
    )
    totals = bags.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    documents, all_terms = totals[0], totals[1] or 0
    holders = dict(
        bags.select("bag").mapInArrow(partial(_holders, terms=len(held.vocabulary)), "term long, df long")
        .groupBy("term").agg(F.sum("df")).collect()
    )
    df = np.array([holders.get(t) or 0 for t in range(len(held.vocabulary))], np.float64)
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    factor = F.lit(10) + F.expr(f"(90 * n * {documents}L) div {max(all_terms, 1)}L")
    known = bags.where(F.length("bag") > 0).select(
        "doc_id", factor.cast("long").alias("m"), "bag", F.xxhash64("bag").alias("print")
    )
    kind = ["print", "m", "bag"]
    classes = known.groupBy(*kind).agg(F.min("doc_id").alias("least"))
    scored = classes.mapInArrow(
        partial(_score, items=held, weights=weights, top=top),
        "item int, score long, least long, print long, m long, bag binary",
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("least"))
    best = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    best = stored(best.drop("place", "least"), "best")
    order = Window.partitionBy(*kind).orderBy(F.asc_nulls_last("doc_id"))
    members = (
        known.join(best.select("print").distinct(), "print", "left_semi")
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).drop("place")
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        best.join(members, kind)
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    )


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = 10, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of each item.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``. A term is a
    maximal run of letters, digits and characters outside ASCII; A-Z are lower-cased. The
    score of a document is the sum, over the item's different terms, of
    ``w * (1000000000 * tf div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2 * N + 2) /
    (2 * df + 1)))`` and ``m = 10 + 90 * n * N div L``. Documents of score 0 are left out.

    Null and empty texts have no terms: such documents count nowhere, such items find
    nothing. Each row of ``docs`` is a document and each row of ``items`` an item, ids null
    or repeated as they are. Equal scores go by ascending doc_id, rows without one last;
    the order of rows equal in score and doc_id is open, their ranks are not.

    Per block of items the tasks hold its vocabulary; scores of a class go no further than
    the task that makes them, but for the ``top`` best of each item.
    """
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    asked = items.select("item_id", "text").where("text IS NOT NULL")
    size = asked.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")).cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_words))
    # numbered before it is written, so that equal rows part and a retry deals as before
    asked = stored(
        asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text", F.monotonically_increasing_id()), F.lit(blocks))),
        "items",
    )
    found = None
    for block in range(blocks):
        # about block_words words, whatever the number of items
        rows = asked.where(F.col("block") == block).orderBy("item_id", "text").collect()
        here = _search_block(texts, rows, top)
        ids = [row.item_id for row in rows]
        here = here.withColumn(
            "item_id", F.element_at(F.lit(ids).cast("array<long>"), F.col("item") + 1) if ids else F.lit(None).cast("long")
        ).select("item_id", "rank", "doc_id", "score")
        if blocks > 1:
            here = stored(here, "ranked")
        found = here if found is None else found.union(here)
    return found
