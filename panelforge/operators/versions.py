"""Latest versions, content-hash skipping and keep-first selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key; the order should end in a unique column."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the given columns."""
    return first_of(df, keys, [F.desc_nulls_last(c) for c in order])


def unseen(files: DataFrame, history: DataFrame, keys: tuple[str, ...] = ("source_file_id", "file_hash")) -> DataFrame:
    """Files whose key and content were not loaded before; history holds loaded versions."""
    return files.join(history.select(*keys).distinct(), list(keys), "left_anti")


def manifest_snapshot(history: DataFrame) -> DataFrame:
    """The manifest's last entry for each file."""
    return latest(history, ["source_file_id"], ["ingested_at", "file_hash"])
