"""One run of the whole lake."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import SparkSession

from tidemark.lake import Lake
from tidemark.operators.staging import scratch_scope
from tidemark.plans import bronze, gold, marts, silver
from tidemark.plans.together import together


def run_lake(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, object],
    as_of: str | datetime,
    batch_kinds: Mapping[str, str] | None = None,
) -> None:
    """Extract, refine and publish, all stamped with the one instant ``as_of``.

    ``sources`` maps a system name (``mysql``, ``postgres``) to its source.
    ``batch_kinds`` names the history tables to take whole (``"snapshot"``), so that
    keys gone from the source close; the others send their changes only. A run that
    broke off is continued by the next one: every step picks up from what the tables
    hold. Dimensions and facts are built side by side; what a
    run keeps between its steps is deleted at its end.
    """
    whole = [name for name, kind in (batch_kinds or {}).items() if kind == "snapshot"]
    with scratch_scope(spark):
        bronze.load_all(spark, lake, sources, as_of, whole)
        silver.refine_all(spark, lake, as_of, batch_kinds)
        # reads the index of orders that the sales bring up to date
        marts.build_marts(spark, lake)
        together(
            [
                lambda: gold.publish_dimensions(spark, lake),
                lambda: gold.load_sales(spark, lake, as_of),
                lambda: gold.load_stocks(spark, lake, as_of),
            ]
        )
