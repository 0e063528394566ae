"""Intermediate results written once and read many times."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SHED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes that a join's right side may take in the driver, and those a row takes beside its columns.
MOST_BROADCAST, ROW_OVERHEAD = 16 << 20, 48
#: Of all files the lake writes: about a quarter smaller than Spark's default, snappy.
COMPRESSION = "zstd"
#: Folders written inside each scratch scope, the innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without one; it takes a folder in its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-scratch/{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid4().hex}"


def shed_shuffles(spark: SparkSession) -> None:
    """Have Spark delete a query's shuffle files when the query ends.

    Otherwise they stay until the driver happens to collect its garbage, and a job of many
    steps fills the disks with files that nobody reads again. A query run once more on the
    same frame makes them anew.
    """
    if spark.conf.get(_SHED, "false") != "true":
        spark.conf.set(_SHED, "true")


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the scratch folder and return a scan of it.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation, and
    row identities assigned before the write cannot change afterwards.
    """
    shed_shuffles(df.sparkSession)
    path = scratch_path(df.sparkSession, label)
    if scopes := _scopes.get():
        scopes[-1].append(path)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def right_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as the right side of a join, marked to be shuffled if it is large in memory.

    Spark takes a scan for as large as its files, but keys and times that compress well are
    twenty and more times as large when they are broadcast, and a broadcast is built in the
    driver's memory. So the number of ``rows`` decides, or one that they cannot exceed; without
    one they are counted, which reads only the footers of files. Small sides are left to Spark.

    The mark passes through projections, filters and aggregates to the next join above.
    """
    rows = df.count() if rows is None else rows
    return df.hint("merge") if rows * (ROW_OVERHEAD + _width(df.schema)) > MOST_BROADCAST else df


def _width(kind: T.DataType) -> int:
    """About the bytes of a value in memory; texts and lists at 20, as Spark estimates texts."""
    if isinstance(kind, T.StructType):
        return sum(_width(field.dataType) for field in kind)
    return 20 if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) else 8


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what :func:`stored` writes inside, in this thread and in those that
    :func:`~tidemark.plans.together.together` starts.

    For work whose outcome is written elsewhere by then, or by :func:`outlasting`.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            discard(spark, path)


def outlasting(df: DataFrame, label: str = "result") -> DataFrame:
    """:func:`stored`, but in the scope around the innermost one."""
    token = _scopes.set(_scopes.get()[:-1])
    try:
        return stored(df, label)
    finally:
        _scopes.reset(token)
