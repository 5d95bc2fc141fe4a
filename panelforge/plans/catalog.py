"""Tables of a lake by name, however they were written: as a folder of parts, partitioned or not, or as one file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.plans.ingest import read_or_none


def find(spark: SparkSession, lake: str, name: str, prefixes: tuple[str, ...] = ("", "bronze_", "gold_")) -> DataFrame | None:
    """The table, under its name alone or with a layer's prefix; None if there is none. Folder and file of one name are one table."""
    for prefix in prefixes:
        parts = [df for path in (f"{lake}/{prefix}{name}", f"{lake}/{prefix}{name}.parquet") if (df := read_or_none(spark, path)) is not None]
        if parts:
            return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return None


def load(spark: SparkSession, lake: str, required: tuple[str, ...] = (), optional: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """All required tables, and the optional ones that are there; fails with the names of all that are missing."""
    found = {n: df for n in (*required, *optional) if (df := find(spark, lake, n)) is not None}
    if missing := [n for n in required if n not in found]:
        raise FileNotFoundError(f"{lake} lacks the tables {missing}")
    return found
