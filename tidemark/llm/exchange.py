"""Which marks (hashes) of a corpus occur more than once: one packed shuffle.

Owners are rows of the corpus, known by two hashes of their content: ``owner`` (64 bits)
and ``check`` (32 bits). Each mark has 64 bits, or 96 with ``second``, and tells a *spot*:
a number of the caller's, or the mark itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U64, mix, signed

#: Marks a task holds before it sends them on.
HELD = 1 << 21
#: Bytes of text whose marks share a bucket; a reducer holds one bucket at a time.
BUCKET_BYTES = 32 << 20

_PLAIN, _WITNESS, _KNOWN = 0, 1, 2
PACKED = (
    "bucket int, kind int, owner array<long>, check array<int>, length array<int>, "
    "mark array<long>, second array<int>, spot array<int>"
)
OWNER = ["owner", "check"]


def with_owner(docs: DataFrame, *keep: Column) -> DataFrame:
    """``owner`` and ``check`` of each row's doc_id and text, beside ``keep``."""
    return docs.select(
        F.xxhash64("doc_id", "text").alias("owner"), F.hash("text", "doc_id").alias("check"), *keep
    )


def bucket_count(docs: DataFrame, column: str = "text") -> int:
    size = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(2 * docs.sparkSession.sparkContext.defaultParallelism, size // BUCKET_BYTES)


def groups(*sorted_by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows: which are the first of their kind, and which are not alone."""
    head = np.ones(len(sorted_by[0]), bool)
    head[1:] = np.any([x[1:] != x[:-1] for x in sorted_by], axis=0)
    return head, ~(head & np.append(head[1:], True))


class Sender:
    """Collects the marks of one task.

    A mark that the task holds twice is shared, whatever other tasks have: its rows go on
    as known, dealt by owner, and one witness is compared with other tasks. So a task
    sends a mark once, however many of its rows have it.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, owner, check, mark, second=None, spot=None) -> Iterator[pa.RecordBatch]:
        """``owner`` and ``check`` per mark; ``second`` and ``spot`` always or never."""
        self.parts.append((owner, check, mark) if second is None else (owner, check, mark, second, spot))
        self.size += len(mark)
        if self.size >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        columns = [np.concatenate(x) for x in zip(*self.parts)]
        self.parts, self.size = [], 0
        order = np.lexsort(columns[3:1:-1])
        columns = [x[order] for x in columns]
        head, shared = groups(*columns[2:4])
        bucket = self._bucket(columns[2])
        yield self._packed(_PLAIN, bucket[~shared], *(x[~shared] for x in columns))
        if shared.any():
            witness = head & shared
            yield self._packed(_WITNESS, bucket[witness], *(x[witness] for x in columns))
            columns = [x[shared] for x in columns]
            yield self._packed(_KNOWN, self._bucket(mix(columns[0].view(U64))), *columns)

    def _bucket(self, mark: np.ndarray) -> np.ndarray:
        return ((mark >> U64(32)) * U64(self.buckets) >> U64(32)).astype(np.int32)

    @staticmethod
    def _packed(kind: int, bucket, owner, check, mark, second=None, spot=None) -> pa.RecordBatch:
        order = np.lexsort((owner, bucket))
        bucket, owner, check, mark = bucket[order], owner[order], check[order], mark[order]
        rows = np.flatnonzero(groups(bucket)[0]) if len(bucket) else np.zeros(0, np.int64)
        ends = np.append(rows, len(bucket))
        runs = np.flatnonzero(groups(bucket, owner, check)[0]) if len(bucket) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(runs, len(bucket))).astype(np.int32)

        def lists(bounds: np.ndarray, values: np.ndarray | None, dtype) -> pa.Array:
            if values is None:
                bounds, values = np.zeros(len(ends)), np.zeros(0)
            values = signed(values) if values.dtype == U64 else values
            return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(dtype, copy=False)))

        of_runs = np.searchsorted(runs, ends)
        if kind == _WITNESS:
            of_runs, owner, check, lengths = np.zeros(len(ends)), owner[:0], check[:0], lengths[:0]
            runs, spot = runs[:0], None
        if kind == _KNOWN:
            second = None
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[rows]),
                pa.array(np.full(len(rows), kind, np.int32)),
                lists(of_runs, owner[runs], np.int64),
                lists(of_runs, check[runs], np.int32),
                lists(of_runs, lengths, np.int32),
                lists(ends, None if kind == _KNOWN and spot is not None else mark, np.int64),
                lists(ends, None if second is None else second[order], np.int32),
                lists(ends, None if spot is None else spot[order], np.int32),
            ],
            ["bucket", "kind", "owner", "check", "length", "mark", "second", "spot"],
        )


def _by_owner(owner: np.ndarray, check: np.ndarray, spot: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((spot, check, owner))
    owner, check, spot = owner[order], check[order], spot[order]
    heads = np.flatnonzero(groups(owner, check)[0]) if len(owner) else np.zeros(0, np.int64)
    bounds = pa.array(np.append(heads, len(owner)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(owner[heads]), pa.array(check[heads]), pa.ListArray.from_arrays(bounds, pa.array(spot))],
        ["owner", "check", "spots"],
    )


def _shared(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    kind, owner, check, mark, second, spot = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((second, mark))
    kind, owner, check, mark, second, spot = (x[order] for x in (kind, owner, check, mark, second, spot))
    found = groups(mark, second)[1] & (kind == _PLAIN)
    return _by_owner(owner[found], check[found], spot[found])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket stand together; tells the spots whose mark is not alone."""
    held: list[tuple[np.ndarray, ...]] = []
    bucket = None
    for batch in batches:
        parts = [np.asarray(batch.column(i).flatten()) for i in range(2, 8)]
        ends = [np.cumsum(np.append(0, np.asarray(batch.column(i).value_lengths()))) for i in range(2, 8)]
        kinds = batch.column(1).to_pylist()
        for row, here in enumerate(batch.column(0).to_pylist()):
            owner, check, length, mark, second, spot = (x[e[row] : e[row + 1]] for x, e in zip(parts, ends))
            owner, check = np.repeat(owner, length), np.repeat(check, length)
            if kinds[row] == _KNOWN:
                yield _by_owner(owner, check, spot.astype(np.int64) if len(spot) else mark)
                continue
            if here != bucket and held:
                yield _shared(held)
                held = []
            bucket, n = here, len(mark)
            held.append(
                (
                    np.full(n, kinds[row]),
                    owner if len(owner) else np.zeros(n, np.int64),
                    check if len(check) else np.zeros(n, np.int32),
                    mark,
                    second if len(second) else np.zeros(n, np.int32),
                    spot.astype(np.int64) if len(spot) else mark,
                )
            )
    if held:
        yield _shared(held)


def shared_spots(packed: DataFrame, buckets: int, repeated: DataFrame) -> DataFrame:
    """``(owner, check, spots)``: the spots of each owner whose mark occurs anywhere else
    too, one row per owner. ``packed`` comes from :class:`Sender`.

    The owners in ``repeated`` stand for any number of rows; they are told no spots.
    """
    return (
        packed.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_compare, "owner long, check int, spots array<long>")
        .join(repeated, OWNER, "left_anti")
        .groupBy(*OWNER)
        .agg(F.flatten(F.collect_list("spots")).alias("spots"))
    )
