"""A corpus pipeline over documents: toxicity, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next one's docs. All but the last return the columns of
documents. The toxicity model is fitted in its stage, on the bounded sample of
labelled rows that panelforge.llm.toxicity documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import decontamination, near, packing, substrings, toxicity
from panelforge.llm.common import dropped, shared_dir, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies, on shingles of five words."""
    return near.keep_one(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    return substrings.rewrite(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("substring_dedup", drop_passages), ("decontamination", drop_leaks), ("packing", pack)]

#: None of the stages can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's table goes once the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = shared_dir(spark)
        docs = written(stage(spark, docs, sf_dir), path)
        if before:
            dropped(before, spark)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
