"""Near-duplicates: fast similarity sketches, banding, exact verification.

A sketch has one coordinate per bin. In each round every shingle is thrown into one bin,
and a bin keeps the least value of the first round that reached it; from round ``bins``
on, round ``bins + b`` throws all shingles into bin ``b``, so every coordinate fills. A
text stops when all of its bins are full. Two sets agree on a coordinate with the
probability of their Jaccard similarity, and the number of agreements is concentrated.

Equal sets are one class. A band lists the classes that share it. What the lists bring
together is verified on full sets, by the rules of :func:`~tidemark.llm.jaccard_join.similar_sets`:
sets with too many shingles that no other candidate has go at once; every set is compared
with one hub of its lists; and of the pairs still apart only those are compared that the
hub's answers leave open. So no link that a band shows is lost, while a group of copies,
near ones or of one template, needs few comparisons for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.jaccard_join import similar_sets
from tidemark.llm.shingle_sets import SLICE_BYTES, by_document, classes_of, sets_of, token_sets, without_strangers
from tidemark.llm.words import U64, mix, signed, slices, texts_of
from tidemark.operators.staging import stored

_EMPTY = U64(0xFFFFFFFFFFFFFFFF)
_ROUND = 0x9FB21C651E98DF25


def sketch(marks: np.ndarray, of: np.ndarray, texts: int, bins: int) -> np.ndarray:
    """Fast similarity sketches ``[texts, bins]``; all ones for a text without shingles."""
    table = np.full((texts, bins), _EMPTY, U64)
    flat = table.reshape(-1)
    for round_ in range(2 * bins):
        if not len(marks):
            break
        thrown = mix(marks ^ U64((round_ + 1) * _ROUND % (1 << 64)))
        if round_ < bins:
            bin_ = (thrown >> U64(32)) * U64(bins) >> U64(32)
        else:
            bin_ = np.full(len(marks), round_ - bins, U64)
        value = (thrown & U64(0xFFFFFFFF)) | U64(round_ << 32)
        np.minimum.at(flat, of * bins + bin_.astype(np.int64), value)
        open_ = (table == _EMPTY).any(axis=1)[of]
        marks, of = marks[open_], of[open_]
    return table


def band_keys(table: np.ndarray, bands: int) -> np.ndarray:
    rows = table.shape[1] // bands
    keys = np.broadcast_to(np.arange(bands, dtype=U64), (len(table), bands)).copy()
    for j in range(rows):
        keys = mix(keys * U64(_ROUND) + table[:, j : bands * rows : rows])
    return keys


def _scan(batches: Iterator[pa.RecordBatch], k: int, bins: int, bands: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for begin, end in slices(texts, most_bytes=SLICE_BYTES):
            n = end - begin
            marks, first, prints = token_sets(texts[begin:end], k)
            of = np.repeat(np.arange(n), np.diff(first))
            keys = signed(band_keys(sketch(marks, of, n, bins), bands)).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[begin:end],
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys)),
                ],
                ["doc_id", "n", "high", "low", "bands"],
            )


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, bins: int = 128, bands: int = 32
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; A-Z are lower-cased. Documents whose sets of
    k-word shingles have ``100 * intersection >= percent * union`` are linked, and
    ``component_id`` is the least doc_id reachable. ``kept`` is ``doc_id = component_id``.

    Null and empty texts have no shingles and are linked with nothing. Rows without a
    doc_id are linked with nothing, have no component and are kept. Rows that share a
    doc_id are one document: they share its component, and a link of one row links all.

    At a similarity of 0.8, a pair shares none of 32 bands of 4 coordinates, and is lost,
    with a probability of 5e-8.
    """
    scanned = docs.select("doc_id", "text").mapInArrow(
        partial(_scan, k=k, bins=bins, bands=bands),
        "doc_id long, n long, high long, low long, bands array<long>",
    )
    scanned = stored(scanned, "sketches")
    classes = classes_of(scanned, "bands")
    banded = classes.select("cls", F.explode("bands").alias("token"))
    # bands of one class each are no use further on
    shared = banded.groupBy("token").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least < most")
    members = stored(banded.join(stored(shared.select("token"), "bands"), "token").distinct(), "in-bands")
    candidates = classes.select("cls", "n", "high", "low").join(members.select("cls").distinct(), "cls", "left_semi")
    candidates = stored(candidates, "candidates")
    sets = stored(without_strangers(stored(sets_of(docs, candidates, k), "candidate-sets"), percent), "sets")
    lists = members.join(sets.select("cls", "n", "own", F.col("own").alias("pos")), "cls")
    links = similar_sets(stored(lists.select("token", "cls", "n", "own", "pos"), "lists"), sets, percent, few_lists=True)
    found = by_document(scanned.drop("bands"), classes, links)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id").withColumn(
        "kept", F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    )
