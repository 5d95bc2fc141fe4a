"""Header lists against the registry: mappings, drift and votes for a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.config import DATASETS
from panelforge.functions.text import fold_header


def registry(spark: SparkSession, datasets=DATASETS) -> DataFrame:
    """A row per known folded header: dataset, its precedence, header, field, canonical column."""
    rows = [(d.name, i, h, f, d.canonical(f)) for i, d in enumerate(datasets) for h, f in d.headers().items()]
    return spark.createDataFrame(rows, "dataset string, precedence int, header string, field string, canonical string")


def mapped(files: DataFrame, datasets=DATASETS) -> DataFrame:
    """files (source_file_id, dataset, headers) to a row per header: its place, field and canonical column.

    The first header of a field claims it; later ones, and unknown ones, are null.
    """
    known = registry(files.sparkSession, datasets).select(F.col("dataset").alias("_d"), F.col("header").alias("_h"), "field", "canonical")
    each = files.select("source_file_id", "dataset", F.posexplode("headers").alias("pos", "header_raw")).withColumn("folded", fold_header(F.col("header_raw")))
    df = each.join(F.broadcast(known), (F.col("dataset") == F.col("_d")) & (F.col("folded") == F.col("_h")), "left")  # a few hundred rows
    nth = F.row_number().over(Window.partitionBy("source_file_id", "dataset", "field").orderBy("pos"))
    df = df.withColumn("claims", F.col("field").isNotNull() & (nth == 1))
    keep = lambda c: F.when(F.col("claims"), F.col(c)).alias(c)
    return df.select("source_file_id", "dataset", "pos", "header_raw", keep("field"), keep("canonical"))


def drift(files: DataFrame, datasets=DATASETS) -> DataFrame:
    """Unmapped headers and missing fields of each file, once each."""
    spark = files.sparkSession
    m = mapped(files, datasets)
    wanted = []
    for d in datasets:
        optional = [f for f in d.fields if f not in d.required]
        wanted += [(d.name, f, d.canonical(f), kind) for kind, fields in (("missing_required", d.required), ("missing_optional", optional), ("missing_viable", d.viable)) for f in fields]
    need = spark.createDataFrame(wanted, "dataset string, field string, canonical string, drift_type string")
    have = m.filter("field is not null").select("source_file_id", "field").distinct()
    gone = files.select("source_file_id", "dataset").distinct().join(F.broadcast(need), "dataset").join(have, ["source_file_id", "field"], "left_anti")
    strange = m.filter("field is null").select("source_file_id", "dataset", F.lit("unmapped").alias("drift_type"), F.col("header_raw").alias("column_name_raw"), F.lit(None).cast("string").alias("mapped_to"))
    lost = gone.select("source_file_id", "dataset", "drift_type", F.col("field").alias("column_name_raw"), F.col("canonical").alias("mapped_to"))
    return strange.unionByName(lost).dropDuplicates(["source_file_id", "column_name_raw", "drift_type"])


def vote(files: DataFrame, datasets=DATASETS) -> DataFrame:
    """The dataset of each file by its headers: the viable one with most known headers; the first one wins ties."""
    spark = files.sparkSession
    heads = files.select("source_file_id", F.explode("headers").alias("h")).select("source_file_id", fold_header(F.col("h")).alias("header")).distinct()
    met = heads.join(F.broadcast(registry(spark, datasets)), "header").groupBy("source_file_id", "dataset", "precedence").agg(F.countDistinct("header").alias("score"), F.collect_set("field").alias("fields"))
    viable = spark.createDataFrame([(d.name, list(d.viable)) for d in datasets], "dataset string, viable array<string>")
    met = met.join(F.broadcast(viable), "dataset").filter(F.size(F.array_except("viable", "fields")) == 0)
    return met.groupBy("source_file_id").agg(F.max_by("dataset", F.struct("score", -F.col("precedence"))).alias("dataset"))
