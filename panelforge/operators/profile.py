"""Frames behind charts: long forms, histograms, missing rates, complete cases; privacy scans; expectations."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def long_form(df: DataFrame, ids: list[str], values: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """bin (from 1), its lower edge and the number of values; one pass for the range, one for the counts."""
    c = F.col(column).cast("double")
    span = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    at = df.select(c.alias("x")).filter("x is not null").join(F.broadcast(span))  # one row
    inside = F.when(F.col("hi") > F.col("lo"), F.least(F.width_bucket("x", "lo", "hi", F.lit(bins)), F.lit(bins))).otherwise(1)
    edge = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") - 1) / bins
    return at.withColumn("bin", inside.cast("int")).withColumn("edge", edge).groupBy("bin", "edge").agg(F.count("*").alias("n"))


def flows(df: DataFrame, source: str, target: str, value: str | None = None) -> DataFrame:
    """source, target and their summed value, or number of rows: what an arc chart draws."""
    total = F.count("*") if value is None else F.sum(value)
    return df.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(total.alias("value"))


def missing_rates(df: DataFrame, pattern: str = ".*") -> DataFrame:
    """The share of nulls in each column whose name fits, in one aggregation."""
    names = [c for c in df.columns if re.search(pattern, c)]
    one = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in names])
    return one.unpivot([], names, "column_name", "missing_rate") if names else df.sparkSession.createDataFrame([], "column_name string, missing_rate double")


def complete_share(df: DataFrame, columns: list[str]) -> DataFrame:
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.agg(F.avg(full.cast("int")).alias("complete_share"), F.count("*").alias("n"))


# Lone runs of 12 digits, e-mail addresses, telling file names, and the files whose text is read.
NUMBER = r"(?<![0-9A-Za-z.])[0-9]{12}(?![0-9A-Za-z.])"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ROSTER = r"(?i)(?:learner|student|child).*(?:master|roster)"
TEXT_FILES = r"(?i)\.(csv|json|jsonl|txt)$"
LONGEST_FILE = 2_000_000


def pii_scan(df: DataFrame, id_: str, text: str) -> DataFrame:
    """Rows with likely personal data: how many numbers and addresses their text holds."""
    n = lambda p: F.regexp_count(F.col(text), F.lit(p)).cast("long")
    return df.select(F.col(id_).alias("row_id"), n(NUMBER).alias("numbers"), n(EMAIL).alias("emails")).filter("numbers > 0 or emails > 0")


def scan_files(spark: SparkSession, root: str, skip: tuple[str, ...] = ("tests",), longest: int = LONGEST_FILE) -> DataFrame:
    """path and finding of files below root with telling names or likely personal data; folders named in skip are left out.

    Names come from the listing alone; text files of over longest bytes are not opened, which is a finding too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    parts = F.split(F.col("path"), "/")
    files = files.filter(~F.arrays_overlap(F.slice(parts, len(root.rstrip("/").split("://")[-1].strip("/").split("/")) + 1, F.size(parts)), F.array(*[F.lit(x) for x in skip])) if skip else F.lit(True))
    named = files.select("path").filter(F.substring_index("path", "/", -1).rlike(ROSTER)).withColumn("finding", F.lit("file name"))
    long = files.filter((F.col("length") > longest) & F.col("path").rlike(TEXT_FILES)).select("path").withColumn("finding", F.lit("too long to be read"))
    texts = files.filter((F.col("length") <= longest) & F.col("path").rlike(TEXT_FILES)).select("path", F.col("content").cast("string").alias("text"))
    held = F.array_compact(F.array(F.when(F.col("text").rlike(NUMBER), "number of 12 digits"), F.when(F.col("text").rlike(EMAIL), "e-mail address")))
    return named.unionByName(long).unionByName(texts.select("path", F.explode(held).alias("finding")))


def violations(df: DataFrame, table: str, not_null: tuple[str, ...] = (), unique: tuple[str, ...] = (), accepted: dict[str, tuple] | None = None, between: dict[str, tuple] | None = None, refers: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """table, check, column and number of rows that break it; all row checks are one aggregation."""
    rows = {("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null}
    rows |= {("accepted", c): F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in (accepted or {}).items()}
    rows |= {("between", c): F.count_if(~F.col(c).between(*v)) for c, v in (between or {}).items()}
    rows |= {("unique", c): F.count(F.col(c)) - F.countDistinct(F.col(c)) for c in unique}
    one = df.agg(*[x.alias(f"{k}:{c}") for (k, c), x in rows.items()]) if rows else None
    parts = []
    if one is not None:
        parts.append(one.unpivot([], one.columns, "k", "n").select(F.lit(table).alias("table_name"), F.substring_index("k", ":", 1).alias("check_name"), F.substring_index("k", ":", -1).alias("column_name"), F.col("n").cast("long").alias("n")))
    for c, (other, key) in (refers or {}).items():
        lost = df.filter(F.col(c).isNotNull()).join(other.select(F.col(key).alias("_k")).distinct(), F.col(c) == F.col("_k"), "left_anti").agg(F.count("*").alias("n"))
        parts.append(lost.select(F.lit(table).alias("table_name"), F.lit("refers").alias("check_name"), F.lit(c).alias("column_name"), "n"))
    return reduce(DataFrame.unionByName, parts)
