"""Token sequences of a fixed length: bounded-space online best-fit.

Pieces arrive in the order of a hash. A packer keeps a fixed number of open bins in
stacks by free space, and one integer whose bits tell which stacks hold a bin, so the
tightest bin that still fits is one shift and one bit trick away. A piece that fits
nowhere opens a bin; if that is one too many, the fullest open bin closes first. A full
piece closes none, as its own bin never stays open.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.words import slices, texts_of
from tidemark.operators.staging import stored

#: Pieces a packing task gets; leaves it at most ``open_bins`` bins that are not full.
PIECES_PER_TASK = 1 << 15


@lru_cache(maxsize=2)
def encoding(ranks: str, end_text: str, end_id: int) -> tiktoken.Encoding:
    """The byte-level BPE of a ranks file; the special text is a token, as in the JSON form."""
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={end_text: end_id}
    )


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def token_ids(text: str, ranks: str, named: str) -> list[int]:
    """The ids of a text: by the ranks, which is faster, or, where a very long run of one
    character is too much for them, by the tokenizer of the same vocabulary itself."""
    try:
        return encoding(ranks, "<|endoftext|>", 50256).encode(text, allowed_special="all")
    except ValueError:
        return tokenizer(named).encode(text, add_special_tokens=False).ids


def piece_bounds(length: int, most: int) -> list[tuple[int, int]]:
    """``(start, end)`` of the pieces of a document; all but the first are full."""
    first = length % most or most
    return [(0, first), *((a, a + most) for a in range(first, length, most))] if length > most else [(0, length)]


def _tokenize(
    batches: Iterator[pa.RecordBatch], ranks: str, named: str, most: int, close: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for begin, end in slices(texts):
            rows = []
            for i, text in enumerate(texts[begin:end].to_pylist(), begin):
                ids = np.array([*token_ids(text, ranks, named), close], "<u4")
                rows += [
                    (i, number, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    for number, (a, b) in enumerate(piece_bounds(len(ids), most))
                ]
            at, number, start, length, crc = map(np.array, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )


class BestFit:
    """Gives each piece its bin and its place there."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.stacks: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = 0
        self.opened = self.open = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open == self.open_bins and length < self.size:
                self._take((self.bits & -self.bits).bit_length() - 1)
            bin_, free = self.opened, self.size
            self.opened += 1
        if free > length:
            self.stacks[free - length].append(bin_)
            self.bits |= 1 << (free - length)
            self.open += 1
        return bin_, self.size - free

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        bin_ = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return bin_


def _pack(batches: Iterator[pa.RecordBatch], most: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    packer, task = BestFit(most, open_bins), None
    for batch in batches:
        bins, offsets = [], []
        tasks = batch.column("task").to_pylist()
        for here, length in zip(tasks, batch.column("length").to_pylist()):
            if here != task:
                packer, task = BestFit(most, open_bins), here
            bin_, offset = packer.place(length)
            bins.append((here << 40) + bin_)
            offsets.append(offset)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())],
            [*names, "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    most: int = 2048,
    open_bins: int = 4096,
    close: int = 0,
    ranks: str | None = None,
    named: str | None = None,
) -> DataFrame:
    """Cut the tokens of all documents into sequences of at most ``most``.

    ``docs`` needs ``doc_id`` and ``text``. A document is its token ids, then ``close``;
    one longer than ``most`` is cut into full pieces, the first of which may be shorter.
    ``named`` is the tokenizer and ``ranks`` the same vocabulary as a tiktoken file
    (default: the public 50k byte-level BPE).
    Returns per piece ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are the one token ``close``. Rows with a null or repeated doc_id
    are documents of their own. Pieces of a full sequence need no packing but pass it.

    Tasks pack pieces dealt out by a hash, about ``PIECES_PER_TASK`` each, whatever the
    size of the corpus; each leaves at most ``open_bins`` sequences that are not full.
    """
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    named = named or public_tokenizers.path("byte_bpe_50k.json")
    pieces = docs.select("doc_id", "text").mapInArrow(
        partial(_tokenize, ranks=ranks, named=named, most=most, close=close),
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )
    # numbered before they are written, so that equal rows part and a retry deals as before
    pieces = stored(pieces.withColumn("turn", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    tasks = max(1, round(pieces.count() / PIECES_PER_TASK))
    return (
        pieces.withColumn("task", F.pmod("turn", F.lit(tasks)))
        .repartition(tasks, "task")
        .sortWithinPartitions("task", "turn")
        .mapInArrow(
            partial(_pack, most=most, open_bins=open_bins),
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )
