"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small sides are broadcast by their measured size only; no code forces one.
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    # Results read twice are written, so the shuffle files of a query can go at its end.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    hive: bool = False,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the defaults above; ``settings`` wins over them.

    ``hive`` turns on the metastore the cluster is configured with, so that the
    catalog outlives the session. ``spark.sql.shuffle.partitions`` is left to the
    cluster: a good start is two to three times its cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
