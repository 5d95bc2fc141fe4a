"""Data quality rules: a registry of functions from frames to findings.

A rule is lazy and returns one row per finding with the columns of FINDING; the
engine adds severity and scope from the policy and numbers the rows. A rule
whose frames are missing is skipped. Windows never see null keys.

Rules that judge one row at a time say so, and the engine runs all of them that
share a frame in one scan.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.config import DATASET, RULES, Settings, action
from panelforge.functions.dates import first_cell, raw_cells, raw_or_canonical, strip, with_date_shape
from panelforge.functions.ids import stable_id
from panelforge.functions.text import blank, present, twelve_digits

Frames = dict[str, DataFrame]
Rule = Callable[[Frames, Settings], DataFrame]
REGISTRY: dict[str, tuple[Rule, tuple[str, ...]]] = {}

FINDING = ("record_id", "school_id", "period", "source_file_id", "field_name", "observed_value", "message")


def rule(rule_id: str, *frames: str) -> Callable[[Rule], Rule]:
    """Registers a rule and the frames that it needs."""

    def put(f: Rule) -> Rule:
        if rule_id in REGISTRY:
            raise ValueError(f"{rule_id} is registered twice")
        REGISTRY[rule_id] = (f, frames)
        return f

    return put


def findings(df: DataFrame, *, message: str | Column, record: str | None = "child_record_id", school: str | None = "school_id", period: str | Column | None = "period", file: str | None = "source_file_id", field: str | Column | None = None, observed: Column | None = None) -> DataFrame:
    """The rows as findings; names of columns that df lacks give null."""

    def col(c) -> Column:
        if isinstance(c, Column):
            return c.cast("string")
        return F.col(c).cast("string") if c is not None and c in df.columns else F.lit(None).cast("string")

    text = message if isinstance(message, Column) else F.lit(message)
    name = field if isinstance(field, Column) else F.lit(field).cast("string")
    seen = F.lit(None).cast("string") if observed is None else observed.cast("string")
    return df.select(col(record).alias("record_id"), col(school).alias("school_id"), col(period).alias("period"), col(file).alias("source_file_id"), name.alias("field_name"), seen.alias("observed_value"), text.alias("message"))


#: Rules on single rows: frame, condition, field, observed value and message, each a function of the settings.
ROWS: dict[str, tuple[str, Callable[[Settings], tuple[Column, Column, Column, Column]]]] = {}


def row_rule(rule_id: str, frame: str, *needs: str):
    """Registers a rule that is a condition on the rows of a frame."""

    def put(f: Callable[[Settings], tuple[Column, Column, Column, Column]]):
        ROWS[rule_id] = (frame, f)

        def run(frames: Frames, s: Settings) -> DataFrame:
            # not as a filter, which would be pushed below the projections that compute its parts, and repeat them
            return _in_one_scan(_rows_of(frames, frame), [(rule_id, "", "", f(s))]).select(*FINDING)

        rule(rule_id, *(needs or (frame,)))(run)
        return f

    return put


def _rows_of(frames: Frames, name: str) -> DataFrame:
    return {"shapes": shapes, "waves": both_waves}[name](frames) if name in ("shapes", "waves") else frames[name]


def _in_one_scan(df: DataFrame, found: list[tuple[str, str, str, tuple[Column, Column, Column, Column]]]) -> DataFrame:
    """The findings of several row rules on one frame."""
    col = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    hits = [
        F.when(cond, F.struct(F.lit(r).alias("rule_id"), F.lit(sev).alias("severity"), F.lit(scope).alias("scope"), field.cast("string").alias("field_name"), seen.cast("string").alias("observed_value"), said.alias("message")))
        for r, sev, scope, (cond, field, seen, said) in found
    ]
    rows = df.select(col("child_record_id").alias("record_id"), col("school_id").alias("school_id"), col("period").alias("period"), col("source_file_id").alias("source_file_id"), F.explode(F.array_compact(F.array(*hits))).alias("x"))
    return rows.select("x.rule_id", "x.severity", "x.scope", "record_id", "school_id", "period", "source_file_id", "x.field_name", "x.observed_value", "x.message")


# Completeness and validity


@rule("DQA_SCHEMA_REQUIRED_COLUMN_MISSING", "schema_drift")
def required_column(f: Frames, s: Settings) -> DataFrame:
    d = f["schema_drift"].filter(F.col("drift_type") == "missing_required")
    return findings(d, record=None, field=F.col("mapped_to"), observed=F.col("column_name_raw"), message="required column not found")


def _nothing() -> Column:
    return F.lit(None).cast("string")


def _missing(column: str, what: str, text: bool = True):
    return lambda s: (blank(F.col(column)) if text else F.col(column).isNull(), F.lit(column), _nothing(), F.lit(f"{what} is missing"))


row_rule("DQA_COMPLETENESS_MISSING_LRN", "child_records")(_missing("lrn_clean", "reference number"))
row_rule("DQA_COMPLETENESS_MISSING_BIRTH_DATE", "child_records")(_missing("birthday_str", "birth date"))
row_rule("DQA_COMPLETENESS_MISSING_HEIGHT", "measurements")(_missing("height_cm", "height", False))
row_rule("DQA_COMPLETENESS_MISSING_WEIGHT", "measurements")(_missing("weight_kg", "weight", False))


@row_rule("DQA_VALIDITY_MALFORMED_LRN", "child_records")
def malformed(s: Settings):
    c = F.col("lrn_clean")
    return present(c) & ~twelve_digits(c), F.lit("lrn_clean"), c, F.lit("reference number isn't of 12 digits")


@row_rule("DQA_COMPLETENESS_MISSING_SEX", "child_records")
def missing_sex(s: Settings):
    c = F.col("sex")
    return blank(c) | ~F.coalesce(c.isin("Male", "Female"), F.lit(False)), F.lit("sex"), c, F.lit("sex is missing or unknown")


def _range(column: str):
    def run(s: Settings):
        lo, hi = getattr(s, column)
        c = F.col(column)
        return (c < lo) | (c > hi), F.lit(column), c, F.concat(F.format_string("%.1f", c.cast("double")), F.lit(f" is outside {lo:.0f} to {hi:.0f}"))

    return run


row_rule("DQA_RANGE_IMPLAUSIBLE_HEIGHT", "measurements")(_range("height_cm"))
row_rule("DQA_RANGE_IMPLAUSIBLE_WEIGHT", "measurements")(_range("weight_kg"))


# Dates, on the raw cells


def shapes(f: Frames) -> DataFrame:
    """One row per record and date field, with the raw cell's shape. Both fields come from one pass over the records."""
    if "shapes" in f:
        return f["shapes"]
    heads = DATASET["school_submission"].headers()
    known = lambda field: tuple(h for h, name in heads.items() if name == field)
    c = f["child_records"]
    at = f["measurements"].select(F.col("child_record_id").alias("_id"), F.date_format("measurement_date", "yyyy-MM-dd").alias("_measured")) if "measurements" in f else None
    both = c.join(at, c["child_record_id"] == at["_id"], "left") if at is not None else c.withColumn("_measured", F.lit(None).cast("string"))
    payload = F.col("raw_payload_json") if "raw_payload_json" in c.columns else F.lit(None).cast("string")
    both, cells = both.withColumn("_cells", raw_cells(payload)), F.col("_cells")
    each = F.array(
        F.struct(F.lit("birthday_str").alias("field"), first_cell(cells, known("birth_date"), F.col("birthday_str")).alias("cell")),
        F.struct(F.lit("measurement_date").alias("field"), first_cell(cells, known("measurement_date"), F.col("_measured")).alias("cell")),
    )
    rows = both.select("child_record_id", "school_id", "period", "source_file_id", F.explode(each).alias("x"))
    return rows.select("child_record_id", "school_id", "period", "source_file_id", "x.field", "x.cell").transform(with_date_shape, "cell", "shape")


@row_rule("DQA_DATE_AMBIGUOUS_FORMAT", "shapes", "child_records")
def ambiguous(s: Settings):
    return F.col("shape.ambiguous"), F.col("field"), F.col("cell"), F.lit("day and month may be swapped")


@row_rule("DQA_DATE_EXCEL_SERIAL", "shapes", "child_records")
def serials(s: Settings):
    return F.col("shape.serial") | F.col("shape.clock"), F.col("field"), F.col("cell"), F.when(F.col("shape.serial"), "serial number for a date").otherwise("date with a time of day")


@row_rule("DQA_DATE_IMPOSSIBLE", "shapes", "child_records")
def impossible(s: Settings):
    d = F.col("shape.date")
    lo, hi = F.date_sub(F.lit(s.baseline[0]).cast("date"), s.slack_days), F.date_add(F.lit(s.endline[1]).cast("date"), s.slack_days)
    beyond = F.when(F.col("field") == "birthday_str", ~F.year(d).between(*s.birth_years)).otherwise(~d.between(lo, hi))
    return ~F.col("shape.blank") & (d.isNull() | beyond), F.col("field"), F.col("cell"), F.lit("no such date, or outside its window")


# Duplicates


@rule("DQA_DUPLICATE_EXACT_ROW", "child_records")
def exact_rows(f: Frames, s: Settings) -> DataFrame:
    same = ["source_file_id", "school_id", "period", "lrn_clean", "student_name_clean", "birthday_str", "sex", "grade", "raw_payload_json"]
    c = f["child_records"]
    key = F.xxhash64(*[x for x in same if x in c.columns])
    w = Window.partitionBy(key, *[x for x in same if x in c.columns]).orderBy(F.asc_nulls_last("source_row_number"), "child_record_id")
    return findings(c.withColumn("_n", F.row_number().over(w)).filter("_n > 1"), message="row repeats an earlier one of its file")


@rule("DQA_DUPLICATE_LRN_WITHIN_SCHOOL_PERIOD", "child_records")
def name_variants(f: Frames, s: Settings) -> DataFrame:
    c = f["child_records"].filter(twelve_digits(F.col("lrn_clean")))
    whole = Window.partitionBy("school_id", "period", "lrn_clean")
    name = F.upper(strip(F.col("student_name_clean")))
    c = c.withColumn("_lo", F.min(name).over(whole)).withColumn("_hi", F.max(name).over(whole)).withColumn("_n", F.row_number().over(whole.orderBy(F.asc_nulls_last("source_row_number"), "child_record_id")))
    return findings(c.filter("_lo <> _hi and _n > 1"), field="lrn_clean", observed=F.col("student_name_clean"), message="reference number with another name in its school and wave")


# Across waves


def pair_waves(child_records: DataFrame) -> DataFrame:
    """lrn_clean with the columns of its baseline and endline record (b_, e_), where each wave has it once.

    One aggregation: the records of a wave are counted, and one is kept, before the shuffle.
    """
    c = child_records.filter(twelve_digits(F.col("lrn_clean")))
    columns = [k for k in c.columns if k not in ("lrn_clean", "period")]
    record = F.struct(*[F.col(f"`{k}`") for k in columns])
    waves = {"b": F.col("period") == "baseline", "e": F.col("period") == "endline"}
    each = [x for w, here in waves.items() for x in (F.count_if(here).alias(f"n_{w}"), F.first(F.when(here, record), ignorenulls=True).alias(w))]
    once = c.groupBy("lrn_clean").agg(*each).filter("n_b = 1 and n_e = 1")
    return once.select("lrn_clean", *[F.col(f"{w}.`{k}`").alias(f"{w}_{k}") for w in waves for k in columns])


def both_waves(f: Frames) -> DataFrame:
    """The endline record of each pair of waves, with sex, height and raw birth date of both; one scan for all rules across waves."""
    c = f["child_records"].withColumn("cell", _birth_cell(f["child_records"])).select("child_record_id", "school_id", "period", "lrn_clean", "source_file_id", "sex", "cell")
    h = F.lit(None).cast("double")
    if "measurements" in f:
        of = f["measurements"].filter("height_cm is not null").groupBy("child_record_id").agg(F.min_by("height_cm", "measurement_id").alias("h"))
        c, h = c.join(of, "child_record_id", "left"), F.col("h")
    p = pair_waves(c.withColumn("h", h))
    p = p.select(
        F.col("e_child_record_id").alias("child_record_id"), F.col("e_school_id").alias("school_id"), F.lit("endline").alias("period"), F.col("e_source_file_id").alias("source_file_id"),
        "b_sex", "e_sex", "b_h", "e_h", "b_cell", "e_cell",
    )
    return p.transform(with_date_shape, "b_cell", "b_shape").transform(with_date_shape, "e_cell", "e_shape")


def _birth_cell(c: DataFrame) -> Column:
    known = tuple(h for h, name in DATASET["school_submission"].headers().items() if name == "birth_date")
    payload = F.col("raw_payload_json") if "raw_payload_json" in c.columns else F.lit(None).cast("string")
    return raw_or_canonical(payload, known, F.col("birthday_str"))


@row_rule("DQA_CONSISTENCY_HEIGHT_DECREASE", "waves", "child_records", "measurements")
def shrunk(s: Settings):
    return F.col("b_h") - F.col("e_h") > s.height_tolerance, F.lit("height_cm"), F.col("e_h"), F.lit("height is below the first wave's")


@row_rule("DQA_CONSISTENCY_SEX_ACROSS_WAVES", "waves", "child_records")
def sex_changed(s: Settings):
    return F.col("b_sex") != F.col("e_sex"), F.lit("sex"), F.col("e_sex"), F.lit("sex differs between waves")


@row_rule("DQA_CONSISTENCY_BIRTHDATE_ACROSS_WAVES", "waves", "child_records")
def birth_changed(s: Settings):
    read = (F.size("b_shape.readings") > 0) & (F.size("e_shape.readings") > 0)
    differs = F.when(read, ~F.arrays_overlap("b_shape.readings", "e_shape.readings")).otherwise(strip(F.col("b_cell")) != strip(F.col("e_cell")))
    there = ~F.col("b_shape.blank") & ~F.col("e_shape.blank")
    return there & differs, F.lit("birthday_str"), F.col("e_cell"), F.lit("no common reading of the two waves' birth dates")


# Aggregates


def heaping(measurements: DataFrame, keys: tuple[str, ...] = ("school_id", "period"), fields: tuple[str, ...] = ("height_cm", "weight_kg")) -> DataFrame:
    """Values and share of last digits 0 and 5 for each key and field, in one aggregation."""
    fives = lambda c: F.avg((F.pmod(F.rint(c), F.lit(5)) == 0).cast("int"))
    g = measurements.groupBy(*keys).agg(*[x for c in fields for x in (F.count(c).alias(f"{c}_n"), fives(c).alias(f"{c}_s"))])
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"{c}_n").alias("n"), F.col(f"{c}_s").alias("share")) for c in fields])
    return g.select(*keys, F.explode(each).alias("x")).select(*keys, "x.field", "x.n", "x.share")


@rule("DQA_MEASUREMENT_DIGIT_HEAPING", "measurements")
def heaped(f: Frames, s: Settings) -> DataFrame:
    h = heaping(f["measurements"]).filter((F.col("n") >= s.heaping_least) & (F.col("share") > s.heaping_share))
    return findings(h, record=None, file=None, field=F.col("field"), observed=F.round("share", 3), message=F.format_string("%.0f%% of the values end in 0 or 5", F.col("share") * 100))


@rule("DQA_REFERENCE_SCHOOL_NAME_DRIFT", "child_records", "schools")
def name_drift(f: Frames, s: Settings) -> DataFrame:
    known = tuple(h for h, n in DATASET["school_submission"].headers().items() if n == "school_name")
    c = f["child_records"].withColumn("_name", raw_or_canonical(F.col("raw_payload_json"), known, F.lit(None).cast("string")))
    usual = c.filter(present(F.col("_name"))).groupBy("source_file_id", "school_id").agg(F.mode("_name", True).alias("_name"), F.min("period").alias("period"))
    listed = f["schools"].select("school_id", F.col("school_name").alias("_listed"))
    return findings(usual.join(listed, "school_id").filter("_name <> _listed"), record=None, field="school_name", observed=F.col("_name"), message="school name isn't the listed one")


@rule("DQA_TIMELINESS_LATE_SUBMISSION", "file_manifest")
def late(f: Frames, s: Settings) -> DataFrame:
    files = f["file_manifest"]
    if "child_records" in f:
        n = f["child_records"].groupBy("source_file_id", "period").agg(F.count("*").alias("n"))
        usual = n.groupBy("source_file_id").agg(F.min_by("period", F.struct(-F.col("n"), "period")).alias("_usual"), F.min("source_file_id").alias("_x")).drop("_x")
        files = files.join(usual, "source_file_id", "left")
    else:
        files = files.withColumn("_usual", F.lit(None).cast("string"))
    period = F.coalesce("_usual", "period_guess")
    closes = F.when(period == "baseline", s.baseline[1]).when(period == "endline", s.endline[1]).cast("date")
    days = F.datediff(F.col("modified_at").cast("date"), closes)
    return findings(files.withColumn("_p", period).withColumn("_d", days).filter(F.col("_d") > s.grace_days), record=None, school="school_id_guess", period="_p", observed=F.col("modified_at").cast("date"), message=F.format_string("submitted %d days after the window", F.col("_d")))


@rule("DQA_PROGRAM_ENROLLMENT_EXCEEDS_ALLOCATION", "allocations")
def exceeds(f: Frames, s: Settings) -> DataFrame:
    a, e = F.col("allocated_children"), F.col("current_enrollment")
    return findings(f["allocations"].filter((a > 0) & (e > a)), record=None, period=None, file=None, field="current_enrollment", observed=e, message=F.format_string("enrolment is %.2f times the allocation", e / a))


# Engine


def check_policy(rules=RULES) -> None:
    """Every rule of the policy is registered, and none more."""
    named = {r[0] for r in rules}
    if named != set(REGISTRY):
        raise ValueError(f"rules and policy differ: {sorted(named ^ set(REGISTRY))}")


def evaluate(frames: Frames, settings: Settings | None = None, run_id: str = "run", detected_at: Column | None = None, rules=None) -> DataFrame:
    """All findings of all rules whose frames are there, with severity, scope, a suggested action and a stable issue_id."""
    settings = settings or Settings()
    rules = rules or settings.rules
    check_policy(rules)
    frames = dict(frames)
    if "child_records" in frames:
        frames["shapes"] = shapes(frames)
    parts, shared = [], {}
    for rule_id, severity, scope, _ in rules:
        f, needs = REGISTRY[rule_id]
        if not all(x in frames for x in needs):
            continue
        if rule_id in ROWS:
            name, row = ROWS[rule_id]
            shared.setdefault(name, []).append((rule_id, severity, scope, row(settings)))
        else:
            parts.append(f(frames, settings).select(F.lit(rule_id).alias("rule_id"), F.lit(severity).alias("severity"), F.lit(scope).alias("scope"), *FINDING))
    parts += [_in_one_scan(_rows_of(frames, name), found) for name, found in shared.items()]
    out = reduce(DataFrame.unionByName, parts)
    same = ["rule_id", "record_id", "source_file_id", "school_id", "period", "field_name"]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("observed_value", "message"))
    at = detected_at if detected_at is not None else F.current_timestamp().cast("timestamp_ntz")
    out = out.withColumn("_nth", nth).withColumn("run_id", F.lit(run_id)).withColumn("detected_at", at).withColumn("resolved_status", F.lit("unresolved"))
    actions = F.create_map(*[F.lit(x) for r in rules for x in (r[0], action(r[0]))])
    out = out.withColumn("suggested_action", F.element_at(actions, F.col("rule_id")))
    return out.withColumn("issue_id", stable_id(F.col("run_id"), *[F.col(c) for c in same], F.col("_nth"))).drop("_nth")
