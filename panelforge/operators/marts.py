"""Standardised tables and published marts, as functions of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.config import FORBIDDEN, Settings
from panelforge.functions.ids import md5_key
from panelforge.functions.measures import body_mass, delivery_flag, effective, measurement_flag, ratio, years_between
from panelforge.functions.text import collapse, digits, first_letter
from panelforge.operators.versions import latest


def _text(c: str):
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def name_key(c: str):
    return F.lower(collapse(F.col(c).cast("string")))


def schools(bronze: DataFrame) -> DataFrame:
    """The latest row of each school."""
    rows = bronze.withColumn("school_id", _text("school_id")).filter("school_id is not null")
    rows = latest(rows, ["school_id"], ["ingested_at", "source_row_number"])
    return rows.select("school_id", F.trim("school_name").alias("school_name"), *[_text(c).alias(c) for c in ("division", "municipality", "barangay", "urban_rural")], F.col("treatment_status").try_cast("bigint").alias("treatment_status"), _text("matched_pair_id").alias("matched_pair_id"))


def child_records(bronze: DataFrame, schools_: DataFrame) -> DataFrame:
    """Submissions of a known school and wave; the school is named, guessed from the path, or found by its name."""
    known = schools_.select(F.col("school_id").alias("_found"), name_key("school_name").alias("_key"))
    rows = bronze.join(known, name_key("school_name") == F.col("_key"), "left")
    sex = F.lower(F.trim("sex"))
    out = rows.select(
        F.col("record_id").cast("string").alias("child_record_id"),
        F.coalesce(_text("school_id"), _text("school_id_guess"), "_found").alias("school_id"),
        F.lower(F.trim("period_guess")).alias("period"),
        digits(F.col("lrn_clean")).alias("lrn_clean"),
        F.nullif(F.upper(collapse(F.col("student_name_clean"))), F.lit("")).alias("student_name_clean"),
        first_letter(F.col("student_name_clean")).alias("first_letter_name"),
        F.date_format("birthday_str_parsed", "yyyy-MM-dd").alias("birthday_str"),
        F.when(sex == "male", "Male").when(sex == "female", "Female").alias("sex"),
        _text("grade").alias("grade"),
        "run_id", "source_file_id", "source_file_path", "source_sheet_name", F.col("source_row_number").cast("bigint").alias("source_row_number"), "file_hash", "ingested_at", "raw_payload_json",
    )
    return out.filter(F.col("school_id").isNotNull() & F.col("period").isin("baseline", "endline"))


def measurements(bronze: DataFrame, children: DataFrame, settings: Settings | None = None) -> DataFrame:
    s = settings or Settings()
    rows = bronze.join(children.select("child_record_id", F.col("school_id").alias("_school"), "period"), F.col("record_id") == F.col("child_record_id"))
    at, born = F.col("measurement_date_parsed"), F.col("birthday_str_parsed")
    h, w = F.col("height_cm").try_cast("double"), F.col("weight_kg").try_cast("double")
    issue = F.col("measurement_date_issue_flag").isNotNull() | F.col("birthday_str_issue_flag").isNotNull()
    return rows.select(
        md5_key(F.col("child_record_id"), F.col("period")).alias("measurement_id"),
        "child_record_id",
        F.col("_school").alias("school_id"),
        "period",
        at.cast("timestamp_ntz").alias("measurement_date"),
        years_between(born.cast("date"), at.cast("date")).alias("age_years"),
        h.alias("height_cm"),
        w.alias("weight_kg"),
        body_mass(h, w).alias("bmi"),
        measurement_flag(issue, h, w, s.height_cm, s.weight_kg).alias("measurement_quality_flag"),
    )


def allocations(bronze: DataFrame, enrollment: DataFrame, schools_: DataFrame, settings: Settings | None = None) -> DataFrame:
    s = settings or Settings()
    year = F.trim(F.col("school_year").cast("string")).alias("school_year")
    number = lambda c: F.col(c).try_cast("double").alias(c)
    a = bronze.select(name_key("school_name").alias("k"), year, number("allocated_children"), number("delivery_tranche_count"))
    e = enrollment.select(name_key("school_name").alias("k"), year, number("current_enrollment"))
    share = ratio(F.col("allocated_children"), F.col("current_enrollment"))
    return a.join(schools_.select("school_id", name_key("school_name").alias("k")), "k").join(e, ["k", "school_year"], "left").select(
        "school_id", "school_year", "allocated_children", "current_enrollment",
        F.lit(s.nominal_rice_kg).alias("nominal_rice_kg_per_child"),
        effective(s.nominal_rice_kg, share).alias("effective_rice_kg_per_child"),
        share.alias("dilution_ratio"), "delivery_tranche_count", delivery_flag(F.col("delivery_tranche_count")).alias("delivery_timing_flag"),
    )


# Marts


def command_center(issues: DataFrame) -> DataFrame:
    """Findings and affected records by school, wave, rule, severity and status."""
    return issues.groupBy(F.coalesce("school_id", F.lit("UNASSIGNED")).alias("school_id"), F.coalesce("period", F.lit("all")).alias("period"), "rule_id", "severity", "resolved_status").agg(
        F.count("*").alias("issue_count"), F.countDistinct("record_id").alias("affected_record_count"), F.max("detected_at").alias("last_detected_at")
    )


def evaluation_panel(links: DataFrame, children: DataFrame, measured: DataFrame, schools_: DataFrame, issues: DataFrame) -> DataFrame:
    """Accepted links with both records' measurements, and whether either end has an open critical finding."""
    critical = issues.filter("severity = 'CRITICAL' and resolved_status = 'unresolved' and record_id is not null").select("record_id").distinct()
    record = lambda x: children.select(F.col("child_record_id").alias(f"{x}_id"), F.col("school_id").alias(f"{x}_school"), F.col("sex").alias(f"{x}_sex"), F.col("grade").alias(f"{x}_grade"))
    taken = lambda x: measured.select(F.col("child_record_id").alias(f"{x}_id"), *[F.col(c).alias(f"{x}_{c}") for c in ("height_cm", "weight_kg", "bmi", "measurement_date")])
    bad = lambda x: critical.select(F.col("record_id").alias(f"{x}_id"), F.lit(True).alias(f"{x}_bad"))
    df = links.filter("decision = 'accepted'").withColumnsRenamed({"baseline_record_id": "b_id", "endline_record_id": "e_id"}).drop("school_id")
    df = df.join(record("b"), "b_id").join(record("e"), "e_id").join(schools_.select(F.col("school_id").alias("b_school"), "treatment_status"), "b_school")
    for x in "be":
        df = df.join(taken(x), f"{x}_id", "left").join(bad(x), f"{x}_id", "left")
    wave = [F.col(f"{x}_{c}").alias(f"{c}_{name}") for c in ("grade", "height_cm", "weight_kg", "bmi") for x, name in (("b", "baseline"), ("e", "endline"))]
    return df.select(
        F.col("link_id").cast("string").alias("panel_child_id"), F.col("b_school").alias("school_id"), "treatment_status", F.coalesce("b_sex", "e_sex").alias("sex"), *wave,
        F.datediff(F.col("e_measurement_date").cast("date"), F.col("b_measurement_date").cast("date")).cast("double").alias("elapsed_days"),
        F.col("method").alias("link_method"), F.col("match_probability").cast("double").alias("link_probability"),
        (F.coalesce("b_bad", F.lit(False)) | F.coalesce("e_bad", F.lit(False))).alias("has_critical_issue"),
    )


def monitoring(schools_: DataFrame, children: DataFrame, issues: DataFrame, links: DataFrame, allocations_: DataFrame) -> DataFrame:
    """A row per school (and school year): each side is summed up before it is joined."""
    n = lambda cond: F.count_if(F.expr(cond))
    c = children.groupBy("school_id").agg(n("period = 'baseline'").alias("baseline_records"), n("period = 'endline'").alias("endline_records"))
    i = issues.filter("school_id is not null").groupBy("school_id").agg(F.count("*").alias("dqa_issue_count"), n("severity = 'CRITICAL'").alias("critical_issue_count"))
    k = links.filter("school_id is not null").groupBy("school_id").agg(n("decision = 'accepted'").alias("accepted_link_count"))
    a = allocations_.select("school_id", "dilution_ratio", "effective_rice_kg_per_child", "delivery_timing_flag")
    df = schools_.select("school_id", "school_name", "division", "municipality", "urban_rural", "treatment_status")
    for other in (c, k, i):
        df = df.join(other, "school_id", "left")
    counts = ["baseline_records", "endline_records", "accepted_link_count", "dqa_issue_count", "critical_issue_count"]
    return df.na.fill(0, counts).join(a, "school_id", "left")


def exposure(allocations_: DataFrame, schools_: DataFrame) -> DataFrame:
    df = allocations_.join(schools_.select("school_id", "school_name", "treatment_status"), "school_id")
    return df.withColumn("allocation_shortfall_flag", F.col("allocated_children") < F.col("current_enrollment"))


def review(links: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Decided pairs with the number of candidates of their baseline record; without candidates, links have it as candidate_count."""
    keep = ["link_id", "baseline_record_id", "endline_record_id", "school_id", "method", "match_probability", "decision", "review_reason", "transferred_flag"]
    if candidates is None:
        return links.select(*keep, "candidate_count").na.fill(0, ["candidate_count"])
    n = candidates.groupBy("baseline_record_id").agg(F.count("*").alias("candidate_count"))
    return links.select(*keep).join(n, "baseline_record_id", "left").na.fill(0, ["candidate_count"])


def public_metrics(monitoring_: DataFrame) -> DataFrame:
    total = lambda c, name: F.sum(c).alias(name)
    return monitoring_.groupBy("treatment_status").agg(
        F.count("*").alias("school_count"), total("baseline_records", "baseline_record_count"), total("endline_records", "endline_record_count"),
        total("accepted_link_count", "accepted_link_count"), total("dqa_issue_count", "dqa_issue_count"), total("critical_issue_count", "critical_issue_count"),
        F.avg("dilution_ratio").alias("mean_dilution_ratio"), F.avg("effective_rice_kg_per_child").alias("mean_effective_rice_kg_per_child"),
    )


def check_public(df: DataFrame, name: str = "table") -> DataFrame:
    """df, if it has none of the forbidden columns."""
    bad = sorted(set(FORBIDDEN) & {c.lower() for c in df.columns})
    if bad:
        raise ValueError(f"{name} has forbidden columns: {bad}")
    return df


def dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """A row per column of each table."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, f.name, f.dataType.simpleString(), f.nullable, i) for t, df in tables.items() for i, f in enumerate(df.schema, 1)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, is_nullable boolean, ordinal_position int")
