"""Names and folders of the lake's tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemark.versions import VersionStore

_PREFIX = {"bronze": "raw_", "silver": "silver_", "gold": ""}


@dataclass(frozen=True)
class Lake:
    """``root/{bronze,silver,gold}/table``, catalogued in one database."""

    root: str
    database: str = "dwh"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database}.{_PREFIX[layer]}{name}"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def history(self, spark: SparkSession, layer: str, name: str) -> VersionStore:
        """A history table: ``dim_<name>`` in gold."""
        if layer == "gold":
            name = f"dim_{name}"
        return VersionStore(spark, self.table(layer, name), self.path(layer, name))
