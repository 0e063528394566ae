"""Sets of word shingles: their tokens, classes of equal sets, and documents by class.

A set is known by a print of 128 bits, ``high`` and ``low``; a class ``cls`` holds all
documents of one set, the least doc_id of which is its ``rep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bits import bit_table, held
from tidemark.llm.components import components
from tidemark.llm.words import U64, Words, signed, slices, texts_of
from tidemark.operators.staging import stored

SET = ["high", "low"]
#: Bytes of text whose sets a task holds at once.
SLICE_BYTES = 1 << 20


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and their texts, in text order.

    A text of fewer words is one shingle; a text without words has none.
    """
    hashes = words.hashes()
    full = words.full_runs(k)
    marks, of = words.runs(hashes, k)[full], words.text_of_words()[full]
    counts = words.counts()
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            marks = np.append(marks, words.runs(hashes, n)[words.first[short]])
            of = np.append(of, short)
    order = np.argsort(of, kind="stable")
    return marks[order], of[order]


def token_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different shingle hashes of each text in order, where each text's begin, and two
    halves of a print of each set."""
    marks, of = shingles(Words.of(texts, lower=True), k)
    order = np.lexsort((marks, of))
    marks, of = marks[order], of[order]
    new = np.ones(len(marks), bool)
    new[1:] = (marks[1:] != marks[:-1]) | (of[1:] != of[:-1])
    marks, of = marks[new], of[new]
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    raw = marks.tobytes()
    prints = np.frombuffer(
        b"".join(xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for a, b in zip(first[:-1], first[1:])), "<i8"
    )
    return marks, first, prints.reshape(-1, 2)


def classes_of(scanned: DataFrame, *more: str) -> DataFrame:
    """``(high, low, rep, n, cls)`` and one value of each column in ``more``."""
    known = scanned.where("doc_id IS NOT NULL AND n > 0")
    classes = known.groupBy(*SET).agg(F.min("doc_id").alias("rep"), *(F.any_value(c).alias(c) for c in ("n", *more)))
    # numbered before it is written, so that a number never changes
    return stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")


def _wanted_sets(batches: Iterator[pa.RecordBatch], k: int, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sets whose print the table holds."""
    for batch in batches:
        texts = texts_of(batch.column(0))
        for begin, end in slices(texts, most_bytes=SLICE_BYTES):
            marks, first, prints = token_sets(texts[begin:end], k)
            here = held(wanted, np.ascontiguousarray(prints[:, 0]).view(U64))
            sizes = np.where(here, np.diff(first), 0)
            tokens = signed(marks[np.repeat(here, np.diff(first))])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(tokens))
            columns = [pa.array(prints[:, 0]), pa.array(prints[:, 1]), lists]
            yield pa.RecordBatch.from_arrays(columns, ["high", "low", "tokens"]).filter(pa.array(here))


def spare(percent: int) -> Column:
    """How many of its ``n`` tokens a set may lose and still be similar to something."""
    return F.expr(f"(n * {100 - percent}) div 100")


def own_tokens(tokens: DataFrame, holder: str) -> DataFrame:
    """``own``, the number of tokens that only this set has, per ``holder``."""
    return (
        tokens.groupBy("token").agg(F.min(holder).alias(holder), F.max(holder).alias("other"))
        .where(f"{holder} = other").groupBy(holder).agg(F.count("*").alias("own"))
    )


def sets_of(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """``(cls, n, tokens)`` of the classes ``(cls, n, high, low)``."""
    wanted = bit_table(classes, "high")
    sets = (
        docs.select("text").mapInArrow(partial(_wanted_sets, k=k, wanted=wanted), "high long, low long, tokens array<long>")
        .groupBy(*SET).agg(F.any_value("tokens").alias("tokens"))
    )
    return classes.select("cls", "n", *SET).join(sets, SET).select("cls", "n", "tokens")


def without_strangers(sets: DataFrame, percent: int) -> DataFrame:
    """``(cls, n, tokens, own)``: the sets that have few enough tokens of their own."""
    own = own_tokens(sets.select("cls", F.explode("tokens").alias("token")), "cls")
    return (
        sets.join(own, "cls", "left").withColumn("own", F.coalesce("own", F.lit(0).cast("long")))
        .where(F.col("own") <= spare(percent))
    )


def by_document(scanned: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``scanned`` with ``component_id``, the least doc_id that links of classes reach.

    Rows that share a doc_id are one document, in all classes of its rows. Rows without a
    doc_id have no component, documents without shingles are their own.
    """
    names = classes.select("cls", "rep", *SET)
    by_id = (
        links.join(names.select(F.col("cls").alias("u"), F.col("rep").alias("a")), "u")
        .join(names.select(F.col("cls").alias("v"), F.col("rep").alias("b")), "v")
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    held_in = scanned.where("doc_id IS NOT NULL AND n > 0").select("doc_id", *SET).join(names, SET)
    members = held_in.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("most"))
    members = stored(members, "members")
    # the classes of a doc_id with several texts are linked with the least of them
    several = members.where("rep < most").select("doc_id", F.col("rep").alias("u"))
    same = held_in.select("doc_id", F.col("rep").alias("v")).join(several, "doc_id").select("u", "v").distinct()
    reached = components(by_id.union(same)).select(F.col("node").alias("rep"), "component")
    fates = members.join(reached, "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    return (
        scanned.join(fates, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id")).drop("component")
    )
