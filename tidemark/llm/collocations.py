"""Collocations: phrases whose parts seldom stand apart, by stripes.

A stripe is the counter of the next words of one prefix; the prefix of a single word is
empty. Every task builds the stripes of its texts, and they are merged elementwise, so a
common prefix spreads over all reducers. The merged stripes hold everything that scoring
asks for: an entry is the frequency of a phrase, and of the prefix of longer ones; the
total of the empty prefix is the number of words; and the greatest entry of a phrase's own
stripe, or of those that end in it, tells whether a longer phrase subsumes it.

Entries below the least frequency are of no use, and a phrase is at most as frequent as
its parts. So three narrow passes over hashes come first: words, pairs of frequent words, and
longer phrases of frequent pairs. The outcome of each is a table of bits of a fixed size,
which never misses a frequent phrase; the stripes leave out what the tables rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bits import bit_table, held
from tidemark.llm.words import U64, Words, mix, signed, slices, texts_of
from tidemark.operators.staging import stored

#: Words of the longest phrase.
LONGEST = 4
#: Bytes of text whose stripes a task merges before it sends them.
SLICE_BYTES = 4 << 20

_APART = np.zeros(256, bool)
_APART[[0x20, 0x09, *range(0x0A, 0x0E), *b".,;:!?"]] = True
_ENDS = _APART.copy()
_ENDS[[0x20, 0x09]] = False
_LONE = U64(0x2545F4914F6CDD1D)
_TOP = U64(0xFFFFFFFFFF000000)


class Phrases:
    """The words of some texts, and which neighbours stand in one piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        self.words = Words.of(texts, lower=True, apart=_APART)
        known = pc.dictionary_encode(langs)
        self.langs = known.dictionary
        self.lang = np.asarray(known.indices)[self.words.text_of_words()]
        salts = [xxhash.xxh3_64_intdigest(x.as_py().encode()) for x in self.langs]
        self.salt = np.array(salts, U64)[self.lang] if len(salts) else np.zeros(0, U64)
        ends = np.flatnonzero(_ENDS[self.words.data])
        piece = np.searchsorted(ends, self.words.starts) + self.words.text_of_words()
        self.linked = piece[1:] == piece[:-1]
        self.hashes = self.words.hashes()
        self.found: dict[int, np.ndarray] = {}

    def at(self, size: int) -> np.ndarray:
        """Where a phrase of ``size`` words starts."""
        n = max(len(self.hashes) - size + 1, 0)
        whole = np.ones(n, bool)
        for j in range(size - 1):
            whole &= self.linked[j : j + n]
        return np.flatnonzero(whole)

    def keys(self, size: int, at: np.ndarray, hashes: np.ndarray | None = None, lane: int = 0) -> np.ndarray:
        runs = self.words.runs(self.hashes if hashes is None else hashes, size, lane)
        return mix(runs[at] ^ self.salt[at] ^ _LONE)

    def may(self, size: int, table: np.ndarray) -> np.ndarray:
        """Whether the phrase of ``size`` words from each word on is in the table."""
        if size not in self.found:
            self.found[size] = np.zeros(len(self.hashes), bool)
            at = self.at(size)
            self.found[size][at] = held(table, self.keys(size, at))
        return self.found[size]

    def strings(self, at: np.ndarray) -> pa.Array:
        """The words at the given places."""
        starts, lengths = self.words.starts[at], (self.words.ends - self.words.starts)[at]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths)
        data = self.words.data[places]
        return pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)
        )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Phrases]:
    for batch in batches:
        langs, texts = batch.column(0), texts_of(batch.column(1))
        for begin, end in slices(texts, most_bytes=SLICE_BYTES):
            yield Phrases(texts[begin:end], langs[begin:end])


def _likely(part: Phrases, size: int, tables: list[np.ndarray]) -> np.ndarray:
    """Where phrases of ``size`` words start all of whose parts the tables hold."""
    at = part.at(size)
    if size > 1 and tables:
        at = at[part.may(1, tables[0])[at]]
        at = at[part.may(1, tables[0])[at + size - 1]]
    if size > 2:
        for j in range(size - 1):
            at = at[part.may(2, tables[1])[at + j]]
    return at


def _count_keys(batches: Iterator[pa.RecordBatch], sizes: tuple[int, ...], tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """How often phrases of some numbers of words occur in the task, by 40 bits of their hash."""
    for part in _parts(batches):
        for size in sizes:
            keys, n = np.unique(part.keys(size, _likely(part, size, tables)) & _TOP, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n.astype(np.int64))], ["key", "n"])


def _stripes(batches: Iterator[pa.RecordBatch], tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Entries of the task's stripes: prefix, next word, how often. The empty prefix's total
    is the entry without a next word."""
    names = ["lang", "size", "prefix", "next", "n"]
    for part in _parts(batches):
        totals = np.bincount(part.lang, minlength=len(part.langs))
        none = pa.nulls(len(totals), pa.string())
        yield pa.RecordBatch.from_arrays(
            [part.langs, pa.array(np.zeros(len(totals), np.int32)), none, none, pa.array(totals.astype(np.int64))], names
        )
        second = part.words.hashes(1)
        for size in range(1, LONGEST + 1):
            at = part.at(size)
            at = at[part.may(size, tables[min(size, 3) - 1])[at]]
            keys, check = part.keys(size, at), part.keys(size, at, second, 1)
            order = np.lexsort((check, keys))
            keys, check, at = keys[order], check[order], at[order]
            heads = np.ones(len(at), bool)
            heads[1:] = (keys[1:] != keys[:-1]) | (check[1:] != check[:-1])
            heads = np.flatnonzero(heads)
            n = np.diff(np.append(heads, len(at)))
            at = at[heads]
            prefix = pa.nulls(len(at), pa.large_string())
            if size > 1:
                prefix = pc.binary_join_element_wise(
                    *(part.strings(at + j) for j in range(size - 1)), pa.scalar(" ", pa.large_string())
                )
            yield pa.RecordBatch.from_arrays(
                [
                    part.langs.take(pa.array(part.lang[at])),
                    pa.array(np.full(len(at), size, np.int32)),
                    prefix.cast(pa.string()),
                    part.strings(at + size - 1).cast(pa.string()),
                    pa.array(n.astype(np.int64)),
                ],
                names,
            )


def stripes(docs: DataFrame, least: int) -> DataFrame:
    """``(lang, size, phrase, prefix, next, n)``: all phrases of 1 to 4 words that occur
    ``least`` times or more, and per language the number of words under size 0."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    tables: list[np.ndarray] = []
    for sizes in ((1,), (2,), tuple(range(3, LONGEST + 1))):
        counted = texts.mapInArrow(partial(_count_keys, sizes=sizes, tables=list(tables)), "key long, n long")
        frequent = counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        tables.append(bit_table(frequent, "key"))
    entries = texts.mapInArrow(
        partial(_stripes, tables=tables), "lang string, size int, prefix string, next string, n long"
    )
    return (
        entries.groupBy("lang", "size", "prefix", "next").agg(F.sum("n").alias("n"))
        .where((F.col("n") >= least) | (F.col("size") == 0))
        .withColumn("phrase", F.concat_ws(" ", "prefix", "next"))
    )


def collocations(docs: DataFrame, least: int = 30, subsumed: int = 80, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` collocations of each language.

    ``docs`` needs ``lang`` and ``text``. Texts are cut at ``. , ; : ! ?`` and line ends into
    pieces, these at spaces and tabs into words; A-Z are lower-cased. A candidate is a
    phrase of 2 to 4 words in a piece with ``a``, its frequency, at ``least``. Its score is
    the least ``floor(2000000 * a / (l + r))`` over its cuts into two parts of frequencies
    ``l`` and ``r``, ties to the shorter first part. A candidate goes if ``subsumed`` percent
    of it or more lie in one longer candidate. One more word is enough to look at: a phrase
    in between is as frequent as the longer one, or more so.

    A null lang is ``und``, a null text is empty. Repeated rows count as often as they stand
    there. ``n`` are the words of the language. Languages without candidates have no rows.
    Equal scores go by ``a`` descending, then by the phrase in byte order.
    """
    counted = stored(stripes(docs, least), "stripes")
    frequency = counted.where("size BETWEEN 1 AND 3").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    candidates = counted.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"))

    longer = counted.where("size >= 3").select("lang", "size", "prefix", "phrase", "n")
    after = F.expr("substr(phrase, instr(phrase, ' ') + 1)")
    most = (
        longer.select("lang", F.col("prefix").alias("phrase"), "n")
        .union(longer.select("lang", after.alias("phrase"), "n"))
        .groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    )
    exact = "decimal(38,0)"
    kept = candidates.join(most, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast(exact) * 100 < F.col("a").cast(exact) * subsumed)
    )
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = (
        kept.select("lang", "phrase", "a", cut.alias("k"))
        .withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("rest", F.expr("substr(phrase, length(first) + 2)"))
    )
    score = F.expr(f"cast((cast(a as decimal(27,0)) * 2000000BD) div (cast(l as {exact}) + r) as bigint)")
    scored = (
        cuts.join(frequency.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(frequency.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = (
        scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )
    words = counted.where("size = 0").select("lang", "n")
    return best.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
