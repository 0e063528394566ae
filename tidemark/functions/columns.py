"""Column expressions and bulk column operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAR_FUTURE = "9999-12-31 00:00:00"


def instant(value: str | datetime) -> Column:
    """A time zone free timestamp literal, whatever the session's settings are."""
    return F.lit(str(value)).cast("timestamp_ntz")


def fingerprint(*columns: str, separator: str | None = None) -> Column:
    """md5 over the text of ``columns``.

    By default NULL and '' differ and values cannot run into each other. A given
    ``separator`` joins the values plainly and skips NULLs (``""`` is the loosest
    form: ('ab', 'c') and ('a', 'bc') then agree). No column: one constant.
    """
    if not columns:
        return F.md5(F.lit("1"))
    if separator is not None:
        return F.md5(F.concat_ws(separator, *columns))
    # Each value carries its length, so no content can imitate a boundary.
    marked = []
    for name in columns:
        text = F.col(name).cast("string")
        marked.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("\x1f", *marked))


def with_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Every column renamed to ``name + suffix``."""
    return df.toDF(*[name + suffix for name in df.columns])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Undo :func:`with_suffix`; names without the suffix stay as they are."""
    return df.toDF(*[name.removesuffix(suffix) for name in df.columns])


def proper_name(column: str) -> Column:
    return F.initcap(F.trim(F.col(column)))


def or_label(column: str, label: str) -> Column:
    """The column as text, with ``label`` in place of NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(label))


def line_total(quantity: str = "quantity", price: str = "list_price", discount: str = "discount") -> Column:
    return F.col(quantity) * F.col(price) * (F.lit(1) - F.col(discount))


def with_calendar(df: DataFrame, column: str, quarter: bool = True) -> DataFrame:
    """Add year, (quarter,) month and day of ``column``."""
    at = F.col(column)
    parts = {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)}
    if quarter:
        parts = {"year": parts["year"], "quarter": F.quarter(at), "month": parts["month"], "day": parts["day"]}
    return df.withColumns(parts)


def conform(df: DataFrame, schema: T.StructType, table: str = "table") -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``.

    A missing or an unknown column fails here, with its name, rather than as a torn
    append or as lost data later.
    """
    missing = [name for name in schema.names if name not in df.columns]
    unknown = [name for name in df.columns if name not in schema.names]
    if missing:
        raise ValueError(f"{table}: columns missing from the source: {', '.join(missing)}")
    if unknown:
        raise ValueError(f"{table}: columns of the source that are not registered: {', '.join(unknown)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
