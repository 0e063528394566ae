"""Histories stored in parts: the open versions, and one folder per run of those it closed.

A history ``h`` is a table ``h_parts``, partitioned by ``part``, and a view ``h`` over the
parts that count. A run writes a new open part and a folder of the versions it closed, and
then points the view at them, which is one change of the catalog: readers see the history
before or after, and closed versions are never written again. Parts of a run that broke off
are in no view; the next write drops them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.staging import COMPRESSION, discard

PART = "part"
_RUN, _HIGHEST = "tidemark.run", "tidemark.highest"


def _stamp(as_of: str | datetime) -> str:
    return datetime.fromisoformat(str(as_of)).strftime("%Y%m%d%H%M%S%f")


class VersionStore:
    """The history called ``view`` with its parts under ``path``."""

    def __init__(self, spark: SparkSession, view: str, path: str):
        self.spark, self.view, self.path = spark, view, path
        self.table = f"{view}_parts"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.view)

    def _property(self, name: str) -> str | None:
        if not self.exists():
            return None
        row = self.spark.sql(f"SHOW TBLPROPERTIES {self.view}").where(F.col("key") == name).first()
        return row["value"] if row else None

    @property
    def run(self) -> datetime | None:
        """The last run that changed the history."""
        run = self._property(_RUN)
        return datetime.strptime(run.split("-")[0], "%Y%m%d%H%M%S%f") if run else None

    @property
    def highest(self) -> int:
        """The largest surrogate key given so far."""
        return int(self._property(_HIGHEST) or 0)

    def _registered(self) -> list[str]:
        if not self.spark.catalog.tableExists(self.table):
            return []
        return [row["partition"].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]

    def parts(self) -> list[str]:
        """The parts in the view: the open one and the closed ones so far."""
        run = self._property(_RUN)
        return [p for p in self._registered() if run and (p == f"open-{run}" or "closed-" <= p <= f"closed-{run}")]

    def _frame(self, parts: Sequence[str]) -> DataFrame:
        return self.spark.table(self.table).where(F.col(PART).isin(list(parts))).drop(PART)

    def open(self) -> DataFrame:
        return self._frame([p for p in self.parts() if p.startswith("open-")])

    def closed(self) -> DataFrame:
        return self._frame([p for p in self.parts() if p.startswith("closed-")])

    def since(self, mark: datetime) -> DataFrame:
        """The open versions and those closed by runs after ``mark``: all that may have
        changed since. Older folders are not read."""
        after = f"closed-{_stamp(mark)}-~"
        return self._frame([p for p in self.parts() if p.startswith("open-") or p > after])

    def replace_open(self, versions: DataFrame, as_of: str | datetime, highest: int) -> None:
        """Make ``versions`` the open part and, as far as their flag says they ended, a part
        of their own. ``versions`` may read the history."""
        last, stamp = self._property(_RUN), _stamp(as_of)
        again = int(last.split("-")[1]) + 1 if last and last.startswith(stamp) else 0
        run = f"{stamp}-{again:04d}"
        part = F.when(F.col("current_flag"), f"open-{run}").otherwise(f"closed-{run}")
        self._write(versions.withColumn(PART, part), run, highest)

    def take_over(self, other: VersionStore) -> None:
        """Become a copy of ``other``: parts held already are left as they are."""
        here = set(self.parts())
        missing = [p for p in other.parts() if p not in here]
        rows = self.spark.table(other.table).where(F.col(PART).isin(missing))
        self._write(rows, other._property(_RUN), other.highest)

    def _write(self, rows: DataFrame, run: str, highest: int) -> None:
        counted = set(self.parts())
        for part in self._registered():
            if part not in counted:
                self._drop(part)
        if not self.spark.catalog.tableExists(self.table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
            self.spark.sql(f"CREATE TABLE {self.table} ({columns}) USING parquet PARTITIONED BY ({PART}) LOCATION '{self.path}'")
        # only folders that are written are replaced: those of a broken attempt of this run
        columns = self.spark.table(self.table).columns
        writer = rows.select(columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
        writer.partitionBy(PART).parquet(self.path)
        self.spark.sql(f"MSCK REPAIR TABLE {self.table}")
        self.spark.catalog.refreshTable(self.table)
        if f"open-{run}" not in self._registered():
            self.spark.sql(f"ALTER TABLE {self.table} ADD PARTITION ({PART}='open-{run}')")
        selected = ", ".join(f"`{c}`" for c in columns if c != PART)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.view} TBLPROPERTIES ('{_RUN}'='{run}', '{_HIGHEST}'='{highest}') AS "
            f"SELECT {selected} FROM {self.table} "
            f"WHERE {PART} = 'open-{run}' OR ({PART} >= 'closed-' AND {PART} <= 'closed-{run}')"
        )

    def _drop(self, part: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({PART}='{part}')")
        discard(self.spark, f"{self.path}/{PART}={part}")
