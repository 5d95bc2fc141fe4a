"""Files to bronze tables: only new contents are parsed, a bad replacement leaves the last good version.

Bronze parts lie in partitions of (source_file_id, file_hash); which of them is
current follows from the manifest, which is only ever appended to and is written
last. So a run that breaks off is repeated by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from panelforge.config import DATASETS, VALUES, Settings
from panelforge.functions.dates import parse_date
from panelforge.functions.ids import stable_id
from panelforge.functions.text import lookup
from panelforge.operators.versions import latest, manifest_snapshot, unseen
from panelforge.sources import files as sources
from panelforge.sources import headers, sheets

TABLES = {"school_submission": "bronze_school_submissions", "enrollment_snapshot": "bronze_enrollment_snapshots", "program_allocation": "bronze_program_allocations", "school_masterlist": "bronze_school_masterlist"}
MANIFEST = "source_file_id string, source_file_path string, file_hash string, dataset string, status string, row_count long, period_guess string, school_id_guess string, modified_at timestamp_ntz, ingested_at timestamp_ntz, run_id string"
DATES = {"birthday_str": "birth_years", "measurement_date": None}


@dataclass(frozen=True)
class Result:
    """Counts of a run."""

    discovered: int
    ingested: int
    skipped: int
    failed: int
    superseded: int
    rows: int


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of the lake, or None if nothing was written yet."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # ids of digits stay texts
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException:
        return None
    finally:
        spark.conf.set(key, before)


def _history(spark: SparkSession, lake: str) -> DataFrame:
    found = read_or_none(spark, f"{lake}/manifest")
    return found if found is not None else spark.createDataFrame([], MANIFEST)


def _canonical(parsed: DataFrame, dataset, settings: Settings, run_id: str, at: Column) -> DataFrame:
    """Rows of one dataset with its canonical columns, date companions, payload and metadata."""
    known = dataset.headers()
    place = lambda f: F.get(F.filter(F.transform(F.sequence(F.lit(1), F.size("headers")), lambda i: F.when(F.element_at("folded", i).isin(*[h for h, x in known.items() if x == f]), i)), lambda x: x.isNotNull()), F.lit(0))
    df = parsed.withColumn("folded", F.transform("headers", headers.fold_header))
    columns = {}
    for f, (canonical, _) in dataset.fields.items():
        cell = F.nullif(F.trim(F.get("cells", place(f) - 1)), F.lit(""))
        columns[canonical] = lookup(cell, VALUES[canonical]) if canonical in VALUES else cell
    df = df.withColumns(columns)
    for c, window in DATES.items():
        if c in columns:
            p = parse_date(F.col(c), years=getattr(settings, window) if window else (1900, 2100))
            df = df.withColumn("_p", p).withColumns({f"{c}_parsed": F.col("_p.date").cast("timestamp_ntz"), f"{c}_parse_rule": F.col("_p.rule"), f"{c}_parse_confidence": F.col("_p.confidence"), f"{c}_issue_flag": F.col("_p.flag")}).drop("_p")
    payload = F.to_json(F.map_from_arrays("headers", "cells"))
    df = df.withColumns({"raw_payload_json": payload, "run_id": F.lit(run_id), "ingested_at": at, "record_id": stable_id(F.col("source_file_id"), F.col("source_row_number"))})
    return df.drop("folded", "headers", "cells", "error")


def run(spark: SparkSession, raw: str, lake: str, settings: Settings | None = None, run_id: str = "run", force: bool = False, discovered: DataFrame | None = None) -> Result:
    """Loads what is new below raw into the tables below lake."""
    s = settings or Settings()
    at = F.current_timestamp().cast("timestamp_ntz")
    found = discovered if discovered is not None else sources.discover(spark, raw)
    history = _history(spark, lake)
    good = history.filter("status = 'ingested'")
    new = found if force else unseen(found, good)
    facts = new.drop("content")
    datasets = s.datasets()
    parsed = sheets.rows(new, datasets).persist()  # parsed once, used by each dataset and the logs
    try:
        heads = parsed.filter("headers is not null").select("source_file_id", "source_sheet_name", "headers").distinct()
        sheet_id = F.concat_ws("\x00", "source_file_id", F.coalesce("source_sheet_name", F.lit("")))
        voted = headers.vote(heads.select(sheet_id.alias("source_file_id"), "headers"), datasets).withColumnRenamed("source_file_id", "sheet_id")
        sheet = heads.withColumn("sheet_id", sheet_id).join(voted, "sheet_id", "left").join(facts.select("source_file_id", "dataset_guess"), "source_file_id")
        sheet = sheet.withColumn("dataset", F.coalesce("dataset_guess", "dataset")).drop("dataset_guess")
        gone = headers.drift(sheet.filter("dataset is not null").select(F.col("sheet_id").alias("source_file_id"), "dataset", "headers"), datasets)
        gone = gone.withColumnRenamed("source_file_id", "sheet_id").withColumn("source_file_id", F.substring_index("sheet_id", "\x00", 1)).persist()
        unfit = gone.filter("drift_type = 'missing_viable'").select("sheet_id").distinct()
        fit = sheet.filter("dataset is not null").join(unfit, "sheet_id", "left_anti")
        rows = parsed.filter("source_row_number > 0").withColumn("sheet_id", sheet_id).join(fit.select("sheet_id", "dataset"), "sheet_id").drop("sheet_id")
        rows = rows.join(facts.select("source_file_id", "source_file_path", "file_hash", "period_guess", "school_id_guess"), "source_file_id")
        for d in datasets:
            part = _canonical(rows.filter(F.col("dataset") == d.name), d, s, run_id, at)
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("source_file_id", "file_hash").parquet(f"{lake}/{TABLES[d.name]}")
        counts = rows.groupBy("source_file_id").agg(F.count("*").alias("n"), F.min("dataset").alias("dataset"))
        entry = facts.join(counts, "source_file_id", "left").select(
            "source_file_id", "source_file_path", "file_hash", F.coalesce("dataset", "dataset_guess").alias("dataset"), F.when(F.col("n") > 0, "ingested").otherwise("failed").alias("status"),
            F.coalesce("n", F.lit(0)).alias("row_count"), "period_guess", "school_id_guess", "modified_at", at.alias("ingested_at"), F.lit(run_id).alias("run_id"),
        )
        before = good.select("source_file_id").distinct()
        tally = entry.join(before.withColumn("had", F.lit(1)), "source_file_id", "left").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "ingested").alias("ok"), F.sum("row_count").alias("rows"), F.count_if((F.col("status") == "ingested") & (F.col("had") == 1)).alias("again")).collect()[0]
        total = found.count()
        gone.drop("sheet_id").withColumns({"run_id": F.lit(run_id), "detected_at": at}).dropDuplicates(["source_file_id", "column_name_raw", "drift_type"]).write.mode("append").parquet(f"{lake}/schema_drift")
        damaged = parsed.filter("error is not null").select("source_file_id", F.col("error").alias("message")).unionByName(unfit.select(F.substring_index("sheet_id", "\x00", 1).alias("source_file_id"), F.lit("sheet isn't viable").alias("message")))
        damaged.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(f"{lake}/ingestion_errors")
        entry.unionByName(_skipped(found.drop("content"), new.select("source_file_id"), good, at, run_id)).write.mode("append").parquet(f"{lake}/manifest")
        gone.unpersist()
        return Result(total, tally["ok"], total - tally["n"], tally["n"] - tally["ok"], tally["again"], tally["rows"] or 0)
    finally:
        parsed.unpersist()


def _skipped(found: DataFrame, new: DataFrame, good: DataFrame, at: Column, run_id: str) -> DataFrame:
    """Manifest rows of files that were loaded before, with the dataset and the count of that load of the same bytes."""
    key = ["source_file_id", "file_hash"]
    known = latest(good, key, ["ingested_at", "run_id"]).select(*key, "dataset", "row_count")
    old = found.join(new, "source_file_id", "left_anti").join(known, key)
    return old.select(
        "source_file_id", "source_file_path", "file_hash", "dataset", F.lit("skipped").alias("status"), "row_count", "period_guess", "school_id_guess",
        "modified_at", at.alias("ingested_at"), F.lit(run_id).alias("run_id"),
    )


def current(spark: SparkSession, lake: str, dataset: str) -> DataFrame | None:
    """The rows of the last good version of each file."""
    rows = read_or_none(spark, f"{lake}/{TABLES[dataset]}")
    if rows is None:
        return None
    last = manifest_snapshot(_history(spark, lake).filter("status = 'ingested'")).select("source_file_id", "file_hash")
    return rows.join(last, ["source_file_id", "file_hash"], "left_semi")


def manifest(spark: SparkSession, lake: str) -> DataFrame:
    return manifest_snapshot(_history(spark, lake))


def tables(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """Everything in bronze that exists."""
    out = {d.name: current(spark, lake, d.name) for d in DATASETS}
    return {k: v for k, v in out.items() if v is not None}
