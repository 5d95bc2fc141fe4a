"""SparkSession defaults: adaptive execution, UTC, ANSI."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Column functions don't look up their callers: far fewer calls to the JVM while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app: str = "panelforge", master: str | None = None, **more: str) -> SparkSession:
    """A session with the defaults; keyword names use _ for the dots of setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **{k.replace("_", "."): v for k, v in more.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
