"""Submission files: discovery, content hashes, and what their paths tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.ids import stable_id

#: Folders below the raw root, and the dataset of their files; the period of two of them is known.
FOLDERS = {"baseline": "school_submission", "endline": "school_submission", "enrollment": "enrollment_snapshot", "allocation": "program_allocation", "reference": "school_masterlist"}
#: Words in file names, for files elsewhere.
KEYWORDS = (("masterlist", "school_masterlist"), ("enrollment", "enrollment_snapshot"), ("enrolment", "enrollment_snapshot"), ("allocation", "program_allocation"), ("baseline", "school_submission"), ("endline", "school_submission"))


def path_dataset(relative: Column) -> Column:
    """The dataset by folder, else by a word in the name, else null."""
    folder, name = F.lower(F.substring_index(relative, "/", 1)), F.lower(F.substring_index(relative, "/", -1))
    out = F.when(F.lit(False), "")
    for k, d in FOLDERS.items():
        out = out.when((folder == k) & relative.contains("/"), d)
    for k, d in KEYWORDS:
        out = out.when(name.contains(k), d)
    return out


def path_period(relative: Column) -> Column:
    folder, name = F.lower(F.substring_index(relative, "/", 1)), F.lower(F.substring_index(relative, "/", -1))
    out = F.when(F.lit(False), "")
    for p in ("baseline", "endline"):
        out = out.when(folder == p, p)
    for p in ("baseline", "endline"):
        out = out.when(name.contains(p), p)
    return out


def path_school(relative: Column) -> Column:
    """SCH_0001 and the like, or a code of capitals and digits, in the file's name."""
    name = F.regexp_replace(F.substring_index(relative, "/", -1), r"\.[^.]*$", "")
    first = F.upper(F.regexp_extract(name, r"(?i)(?<![A-Za-z0-9])(SCH[-_]?\d+)(?!\d)", 1))
    second = F.regexp_extract(name, r"(?<![A-Za-z0-9])([A-Z]{2,}[-_]\d{2,})(?!\d)", 1)
    return F.replace(F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit(""))), F.lit("-"), F.lit("_"))


def relative_to(root: str) -> Column:
    """The path below root of a row's path, however the scheme is written."""
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    return F.regexp_replace(F.regexp_replace(F.col("path"), r"^[a-z]+:/*", ""), f"^\\Q{base}\\E/+", "")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """A row per file below root: id, relative path, hash, sizes, guesses and the bytes. Hidden and lock files are left out."""
    return described(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,xlsx,CSV,XLSX}").load(root), root)


def described(files: DataFrame, root: str) -> DataFrame:
    """The same of files that are already read (path, modificationTime, length, content)."""
    relative = relative_to(root)
    name = F.substring_index(relative, "/", -1)
    rows = files.withColumn("source_file_path", relative).filter(~name.startswith("~$") & ~name.startswith("."))
    rows = rows.filter(~F.col("source_file_path").contains("/") | F.lower(F.substring_index("source_file_path", "/", 1)).isin(*FOLDERS))
    return rows.select(
        stable_id(F.col("source_file_path")).alias("source_file_id"),
        "source_file_path",
        F.sha2("content", 256).alias("file_hash"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"),
        path_dataset(F.col("source_file_path")).alias("dataset_guess"),
        path_period(F.col("source_file_path")).alias("period_guess"),
        path_school(F.col("source_file_path")).alias("school_id_guess"),
        "content",
    )
