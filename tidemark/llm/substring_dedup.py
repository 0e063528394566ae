"""Removal of passages that occur more than once, found by recompression.

1. Every task recompresses its texts: some rounds of naming runs and pairs of symbols
   (:mod:`tidemark.llm.recompression`). Equal passages get equal symbols inside, since a
   symbol depends only on the words of its context. Windows that hold no whole context
   are marked by a hash of their own.
2. One shuffle finds the names that occur twice or more in the corpus.
3. Windows all of whose names are shared are candidates. Their words' 96-bit
   fingerprints are compared in a second shuffle; only equal windows count.

Names only choose candidates, and never miss one: a window that occurs twice has the same
names in both places. Names are hashes, not numbers dealt out by a table, so that the
rounds need no join; a clash of two names costs a comparison and changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.exchange import OWNER, PACKED, Sender, bucket_count, shared_spots, with_owner
from tidemark.llm.recompression import covering, recompress
from tidemark.llm.words import U64, Words, signed, slices, texts_of
from tidemark.operators.staging import outlasting, scratch_scope, stored


def _rounds(window: int) -> tuple[int, int]:
    """Rounds, and the words of the longest symbol that is still paired, so that most
    windows hold a whole context."""
    rounds = max(1, int(np.log(max(window, 2) / 6) / np.log(4 / 3))) if window > 8 else 1
    return rounds, max(2, window // 4)


class _Marks:
    """Names and windows of some texts."""

    def __init__(self, texts: pa.Array, window: int):
        self.words = Words.of(texts)
        self.window = window
        self.hashes = self.words.hashes()
        self.full = self.words.full_runs(window)
        rounds, longest = _rounds(window)
        symbols = recompress(self.words, self.hashes, rounds, longest, (0,))
        self.symbols = symbols.take(np.flatnonzero(symbols.high - symbols.low <= window))
        named = covering(self.symbols.high - window, self.symbols.low + 1, len(self.hashes))
        self.bare = np.flatnonzero(self.full & ~named)
        self.windows = self.words.runs(self.hashes, window)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Names and hashes of windows without one, with the text of each."""
        # a symbol that no full window holds says nothing
        held = np.zeros(len(self.hashes) + 1, np.int64)
        held[1:] = np.cumsum(self.full)
        low = np.maximum(self.symbols.high - self.window, 0)
        useful = held[np.minimum(self.symbols.low + 1, len(self.hashes))] > held[low]
        texts = self.words.text_of_words()
        return (
            np.concatenate([self.symbols.names[useful], self.windows[self.bare]]),
            np.concatenate([self.symbols.texts[useful], texts[self.bare]]),
        )

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """First words of the windows all of whose names are ``shared`` (sorted)."""

        def among(names: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(shared, names), len(shared) - 1)
            return shared[at] == names

        rare = self.symbols.take(np.flatnonzero(~among(self.symbols.names)))
        out = covering(rare.high - self.window, rare.low + 1, len(self.hashes))
        out[self.bare[~among(self.windows[self.bare])]] = True
        return np.flatnonzero(self.full & ~out)


def _send_names(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    sender = Sender(buckets)
    for batch in batches:
        owner, check, texts = np.asarray(batch.column(0)), np.asarray(batch.column(1)), texts_of(batch.column(2))
        for begin, end in slices(texts):
            names, of = _Marks(texts[begin:end], window).names()
            yield from sender.add(owner[begin + of], check[begin + of], names)
    yield from sender.flush()


def _send_windows(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    sender = Sender(buckets)
    for batch in batches:
        owner, check, texts = np.asarray(batch.column(0)), np.asarray(batch.column(1)), texts_of(batch.column(2))
        for begin, end in slices(texts):
            spots = batch.column(3)[begin:end]
            shared, whole = np.unique(np.asarray(spots.flatten()).view(U64)), np.asarray(spots.is_null())
            if not len(shared) and not whole.any():
                continue
            marks = _Marks(texts[begin:end], window)
            texts_of_words = marks.words.text_of_words()
            at = np.flatnonzero(marks.full & whole[texts_of_words])
            if len(shared):
                at = np.union1d(at, marks.candidates(shared))
            of = texts_of_words[at]
            second = marks.words.runs(marks.words.hashes(1), window, 1)[at]
            yield from sender.add(
                owner[begin + of],
                check[begin + of],
                marks.windows[at],
                signed(second >> U64(32)).astype(np.uint32).view(np.int32),
                (at - marks.words.first[of]).astype(np.int32),
            )
    yield from sender.flush()


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """``row``, spots, whether all windows repeat and, if the row lacks it, the text."""
    for batch in batches:
        spots, whole = batch.column(1), batch.column(2).to_pylist()
        texts = batch.column(3) if batch.num_columns > 3 else pc.struct_field(batch.column(0), "text")
        n_words, n_removed, kept, digests = [], [], [], []
        for i in range(len(texts)):
            words = (texts[i].as_py() or "").encode().split()
            n_words.append(len(words))
            if whole[i] and len(words) >= window:
                words = []
            elif len(found := spots[i].values or ()):
                begin = np.asarray(found)
                gone = covering(begin, begin + window, len(words))
                words = [word for word, cut in zip(words, gone.tolist()) if not cut]
            n_removed.append(n_words[-1] - len(words))
            text = b" ".join(words)
            kept.append(text if n_removed[-1] else None)
            digests.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(digests),
            ],
            ["row", "n_words", "n_removed", "kept_text", "kept_sha256"],
        )


def repeated_windows(docs: DataFrame, repeated: DataFrame, window: int = 35) -> DataFrame:
    """``(owner, check, spots)``: first words of the windows of each document that occur
    anywhere else, in the same document or another one.

    ``repeated`` are the owners of two rows or more, of which every window does. All of
    their rows take part in the first exchange, one of each in the second.
    """
    keyed = with_owner(docs.where("text IS NOT NULL"), F.col("text"))
    buckets = bucket_count(docs)
    sent = keyed.mapInArrow(partial(_send_names, window=window, buckets=buckets), PACKED)
    with scratch_scope(docs.sparkSession):
        names = stored(shared_spots(sent, buckets, repeated), "names").withColumnRenamed("spots", "names")
        one_each = keyed.join(repeated, OWNER, "left_semi").dropDuplicates(OWNER)
        likely = (
            keyed.join(names, OWNER).select(*OWNER, "text", "names")
            .union(one_each.select(*OWNER, "text", F.lit(None).cast("array<long>")))
        )
        sent = likely.mapInArrow(partial(_send_windows, window=window, buckets=buckets), PACKED)
        return outlasting(shared_spots(sent, buckets, repeated), "windows")


def remove_repeats(docs: DataFrame, window: int = 35, row: list[str] | None = None) -> DataFrame:
    """Take out every word that a repeated window of ``window`` words covers.

    ``docs`` needs ``doc_id`` and ``text``; the result has ``row`` (a struct of the columns
    named, default all), ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by
    one space; null if nothing was removed) and ``kept_sha256`` of the kept words joined.

    Every copy of a repeated passage goes, the first one too. Null and empty texts have no
    words. Texts shorter than the window keep all. Identical rows, ids included, count as
    documents of their own: their windows repeat each other, so all words of a text as long
    as a window go, and no task gathers what the rows of one such text have found. A null doc_id is an id like any other.
    """
    owners = with_owner(docs.where("text IS NOT NULL")).groupBy(*OWNER).agg(F.count("*").alias("rows"))
    repeated = stored(owners.where("rows > 1").select(*OWNER), "repeated")
    spots = repeated_windows(docs, repeated, window)
    kept = row or docs.columns
    # the text moves once, as a part of the row if it is one
    text = [] if "text" in kept else ["text"]
    keyed = with_owner(docs, F.struct(*kept).alias("row"), *map(F.col, text))
    return (
        keyed.join(spots, OWNER, "left")
        .join(repeated.withColumn("whole", F.lit(True)), OWNER, "left")
        .select("row", "spots", F.coalesce("whole", F.lit(False)).alias("whole"), *text)
        .mapInArrow(
            partial(_cut, window=window),
            keyed.select("row").schema.add("n_words", "long").add("n_removed", "long")
            .add("kept_text", "string").add("kept_sha256", "string"),
        )
    )
