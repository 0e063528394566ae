"""Quality classifier: averaged subword embeddings, softmax, stochastic gradient descent.

A text is the average of learned vectors of its words and of the character n-grams of its
words, hashed into a fixed number of buckets; a softmax over two classes stands on top. A
word that repeats the one before it also counts as the bigram of a word with itself, which
has one vector for all words.
One task trains on a bounded sample; all tasks score. With two classes the score of an
average is the average of one number per bucket, so scoring looks up one number a feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.training import fold, labelled_sample
from tidemark.llm.words import U64, Words, slices, texts_of

#: Characters of the n-grams; a space stands at both ends of a word.
GRAMS = (3, 5)
_STEP = U64(0x9E3779B97F4A7C15)
_SPREAD = U64(0xD6E8FEB86659FD93)


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams of some texts, and the text each belongs to."""
    shift = U64(64 - bits)
    words = Words.of(texts)
    hashes, text = words.hashes(), words.text_of_words()
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1]))
    buckets = [(hashes >> shift).astype(np.int32), np.full(len(again), int(_SPREAD >> shift), np.int32)]
    of = [text, text[again]]
    each = [f" {text} ".encode("utf-32-le") for text in texts.to_pylist()]
    chars = np.frombuffer(b"".join(each), "<u4")
    ends = np.cumsum([len(x) // 4 for x in each])
    space = (chars == 0x20) | ((chars >= 0x09) & (chars <= 0x0D))
    # the next space after each character, or the end
    spaces = np.append(np.flatnonzero(space), len(chars))
    following = spaces[np.searchsorted(spaces, np.arange(len(chars)), "right")] if len(chars) else spaces[:0]
    room = following - np.arange(len(chars)) + 1
    codes = np.where(space, U64(0x20), chars.astype(U64)) * _STEP
    grams, n = codes, 1
    while n < GRAMS[1]:
        grams = grams[:-1] * _SPREAD + codes[n:]
        n += 1
        if n >= GRAMS[0]:
            at = np.flatnonzero(room[: len(grams)] >= n) if len(grams) else np.zeros(0, np.int64)
            own = grams[at]
            buckets.append((((own ^ (own >> U64(29))) * _SPREAD) >> shift).astype(np.int32))
            of.append(np.searchsorted(ends, at, "right"))
    return np.concatenate(buckets), np.concatenate(of)


def train(
    texts: list, labels: np.ndarray, bits: int, size: int, epochs: int, least_steps: int, rate: float, seed: int
) -> bytes:
    """The log-odds of class 1 per bucket, then the bias, as float32."""
    bags = []
    for text in texts:
        buckets, counts = np.unique(features(texts_of(pa.array([text], pa.string())), bits)[0], return_counts=True)
        bags.append((buckets, (counts / max(counts.sum(), 1)).astype(np.float32)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / size, 1 / size, (1 << bits, size)).astype(np.float32)
    out, bias = np.zeros((2, size), np.float32), np.zeros(2, np.float32)
    epochs = max(epochs, -(-least_steps // max(len(bags), 1)))
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for i in random.permutation(len(bags)):
            buckets, share = bags[i]
            mean = share @ vectors[buckets]
            odds = out @ mean + bias
            odds = np.exp(odds - odds.max())
            gradient = (odds / odds.sum()).astype(np.float32)
            gradient[int(labels[i])] -= 1
            gradient *= rate * (1 - done / steps)
            back = gradient @ out
            out -= np.outer(gradient, mean)
            bias -= gradient
            vectors[buckets] -= share[:, None] * back
            done += 1
    return np.append(vectors @ (out[1] - out[0]), bias[1] - bias[0]).astype("<f4").tobytes()


def _train(batches: Iterator[pa.RecordBatch], **settings) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in batch.to_pylist()]
    rows.sort(key=lambda row: row["doc_id"])
    model = train([row["text"] for row in rows], np.array([row["label"] for row in rows]), **settings)
    yield pa.RecordBatch.from_arrays([pa.array([model])], ["model"])


def _score(batches: Iterator[pa.RecordBatch], model: bytes, bits: int) -> Iterator[pa.RecordBatch]:
    table = np.frombuffer(model, "<f4").astype(np.float64)
    bias, table = table[-1], table[:-1]
    for batch in batches:
        texts = texts_of(batch.column(1))
        scores = [np.zeros(0)]
        for begin, end in slices(texts):
            buckets, of = features(texts[begin:end], bits)
            sums = np.bincount(of, table[buckets], end - begin)
            counts = np.bincount(of, minlength=end - begin)
            scores.append(1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + bias))))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], ["row", "score"])


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 3,
    held_out: int = 1,
    most: int = 8000,
    bits: int = 18,
    size: int = 16,
    epochs: int = 5,
    least_steps: int = 20000,
    rate: float = 0.5,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Learns ``label`` (0 or 1) from at most ``most`` rows of ``labels`` outside the fold
    ``held_out`` of ``folds``; ``score`` is the probability of 1, for the whole text.
    ``2 ** bits`` buckets of ``size`` numbers; ``rate`` falls to 0 over ``epochs``, of
    which a small sample gets more, until ``least_steps`` rows have been seen.

    Null and empty texts get the score of no features, from the bias alone. Without any
    labelled row every score is 0.5. Null and repeated ids are scored row by row.
    """
    sample = labelled_sample(docs, labels, label, folds, held_out, most)
    # one task, since gradient descent is sequential; bounded by ``most`` documents
    settings = {"bits": bits, "size": size, "epochs": epochs, "least_steps": least_steps, "rate": rate, "seed": 7}
    trained = sample.repartition(1).mapInArrow(
        partial(_train, **settings), "model binary"
    ).first()
    model = bytes(trained[0]) if trained else train([], np.zeros(0), **settings)
    scored = docs.select(F.struct("doc_id", (fold(folds) == held_out).alias("held_out")).alias("row"), "text").mapInArrow(
        partial(_score, model=model, bits=bits), "row struct<doc_id: long, held_out: boolean>, score double"
    )
    return scored.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
