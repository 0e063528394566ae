"""Operational databases over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.registry import Table

DRIVERS = {"mysql": "com.mysql.cj.jdbc.Driver", "postgres": "org.postgresql.Driver"}


@dataclass(frozen=True)
class JdbcDatabase:
    """One database; tables are read in parallel ranges of a key column."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str
    connections: int = 8
    fetch_size: int = 10_000

    def _login(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}

    def bounds_options(self, table: Table) -> dict[str, str]:
        """Options that read the smallest and largest key, an index lookup at the source."""
        key = table.split_column
        return {**self._login(), "query": f"SELECT min({key}) AS low, max({key}) AS high FROM {table.name}"}

    def table_options(self, table: Table, bounds: tuple | None) -> dict[str, str]:
        options = {**self._login(), "dbtable": table.name, "fetchsize": str(self.fetch_size)}
        # Source times carry no zone; read as such they compare to marks without a cast,
        # which would keep the comparison from being sent to the database.
        options["preferTimestampNTZ"] = "true"
        if bounds and bounds[0] is not None:
            # Rows outside the bounds are still read, by the first and last range.
            options |= {
                "partitionColumn": table.split_column,
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1] + 1),
                "numPartitions": str(self.connections),
            }
        return options

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        """The table, lazily: filters put on the frame are sent to the database."""
        bounds = spark.read.format("jdbc").options(**self.bounds_options(table)).load().first()
        return spark.read.format("jdbc").options(**self.table_options(table, tuple(bounds))).load()
