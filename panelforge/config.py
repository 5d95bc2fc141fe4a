"""Policy: headers, values, rules, thresholds and linkage settings."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from pathlib import Path

from panelforge.functions.text import fold_header_text


@dataclass(frozen=True)
class Dataset:
    name: str
    required: tuple[str, ...]
    viable: tuple[str, ...]
    #: field: (canonical column, headers)
    fields: dict[str, tuple[str, tuple[str, ...]]]

    def headers(self) -> dict[str, str]:
        """Folded headers to fields; the first field that claims a header keeps it."""
        out: dict[str, str] = {}
        for name, (canonical, known) in self.fields.items():
            for h in (*known, name, canonical):
                out.setdefault(fold_header_text(h), name)
        return out

    def canonical(self, name: str) -> str:
        return self.fields[name][0]


# Datasets in order of precedence, and the headers known for each field.
DATASETS = (
    Dataset(
        "school_submission",
        ("school_name", "student_name", "birth_date", "sex"),
        ("school_name", "student_name"),
        {
            "school_name": ("school_name", ("School", "SCHOOL NAME", "Name of School", "school_name", "SchoolName", "Paaralan")),
            "school_id": ("school_id", ("School ID", "SCHOOL_ID", "school id", "Sch ID", "School Code")),
            "lrn": ("lrn_clean", ("LRN", "Learner Reference Number", "learner_ref_no", "LRN No.", "lrn")),
            "student_name": ("student_name_clean", ("Name", "NAME OF LEARNER", "Learner Name", "Student Name", "Pangalan", "name_of_pupil")),
            "birth_date": ("birthday_str", ("Date of Birth", "BIRTH_DATE", "DOB", "Birthdate", "Birth Date", "Kaarawan", "date_of_birth")),
            "sex": ("sex", ("Sex", "SEX", "Gender", "M/F", "kasarian")),
            "grade": ("grade", ("Grade", "GRADE LEVEL", "Grade Level", "Yr Level", "grade_level")),
            "height_cm": ("height_cm", ("Height", "Height (cm)", "HEIGHT_CM", "Ht", "height_cm", "Taas")),
            "weight_kg": ("weight_kg", ("Weight", "Weight (kg)", "WEIGHT_KG", "Wt", "weight_kg", "Timbang")),
            "measurement_date": ("measurement_date", ("Date Measured", "MEASUREMENT_DATE", "Date of Weighing", "Weighing Date", "date_measured")),
        },
    ),
    Dataset(
        "enrollment_snapshot",
        ("school_name", "school_year", "current_enrollment"),
        ("school_name",),
        {
            "school_name": ("school_name", ("School", "SCHOOL NAME", "Name of School")),
            "school_year": ("school_year", ("SY", "School Year", "SCHOOL_YEAR")),
            "current_enrollment": ("current_enrollment", ("Enrollment", "Total Enrolment", "Current Enrollment", "ENROLLMENT", "No. of Learners")),
        },
    ),
    Dataset(
        "program_allocation",
        ("school_name", "school_year", "allocated_children"),
        ("school_name",),
        {
            "school_name": ("school_name", ("School", "SCHOOL NAME", "Name of School")),
            "school_year": ("school_year", ("SY", "School Year", "SCHOOL_YEAR")),
            "allocated_children": ("allocated_children", ("Allocation", "Allocated Beneficiaries", "No. of Beneficiaries", "ALLOCATED")),
            "delivery_tranche_count": ("delivery_tranche_count", ("Tranches", "No. of Tranches", "Deliveries")),
        },
    ),
    Dataset(
        "school_masterlist",
        ("school_id", "school_name", "division", "municipality", "treatment_status"),
        ("school_id", "school_name"),
        {
            "school_id": ("school_id", ("School ID", "SCHOOL_ID", "School Code")),
            "school_name": ("school_name", ("School", "SCHOOL NAME", "Name of School")),
            "division": ("division", ("Division", "DIVISION", "Schools Division")),
            "municipality": ("municipality", ("Municipality", "MUNICIPALITY", "City/Municipality")),
            "barangay": ("barangay", ("Barangay", "BARANGAY", "Brgy")),
            "urban_rural": ("urban_rural", ("Urban/Rural", "URBAN_RURAL", "Classification")),
            "treatment_status": ("treatment_status", ("Treatment", "SBFP", "TREATMENT_STATUS", "Is SBFP")),
            "matched_pair_id": ("matched_pair_id", ("Pair", "Matched Pair", "MATCHED_PAIR_ID")),
        },
    ),
)
DATASET = {d.name: d for d in DATASETS}

# Spellings of the values of two columns.
VALUES = {
    "sex": {"M": "Male", "MALE": "Male", "1": "Male", "Lalaki": "Male", "BOY": "Male", "F": "Female", "FEMALE": "Female", "2": "Female", "Babae": "Female", "GIRL": "Female"},
    "treatment_status": {"SBFP": "1", "Treatment": "1", "Yes": "1", "Y": "1", "1": "1", "TRUE": "1", "Control": "0", "Non-SBFP": "0", "No": "0", "N": "0", "0": "0", "FALSE": "0"},
}

# Rule, severity, scope, and the injected defects that it should find.
RULES = (
    ("DQA_SCHEMA_REQUIRED_COLUMN_MISSING", "CRITICAL", "file", ()),
    ("DQA_COMPLETENESS_MISSING_LRN", "HIGH", "record", ("missing_lrn",)),
    ("DQA_VALIDITY_MALFORMED_LRN", "HIGH", "record", ("malformed_lrn",)),
    ("DQA_COMPLETENESS_MISSING_BIRTH_DATE", "HIGH", "record", ("missing_birth_date",)),
    ("DQA_COMPLETENESS_MISSING_SEX", "MEDIUM", "record", ("missing_sex",)),
    ("DQA_DATE_AMBIGUOUS_FORMAT", "MEDIUM", "record", ("date_format_ambiguity",)),
    ("DQA_DATE_EXCEL_SERIAL", "LOW", "record", ("excel_serial_date", "timestamp_suffixed_date")),
    ("DQA_DATE_IMPOSSIBLE", "CRITICAL", "record", ("impossible_date",)),
    ("DQA_DUPLICATE_EXACT_ROW", "HIGH", "record", ("duplicate_exact_row",)),
    ("DQA_DUPLICATE_LRN_WITHIN_SCHOOL_PERIOD", "HIGH", "record", ("duplicate_lrn_name_variant",)),
    ("DQA_RANGE_IMPLAUSIBLE_HEIGHT", "CRITICAL", "record", ("implausible_height",)),
    ("DQA_RANGE_IMPLAUSIBLE_WEIGHT", "CRITICAL", "record", ("implausible_weight",)),
    ("DQA_COMPLETENESS_MISSING_HEIGHT", "HIGH", "record", ("missing_height",)),
    ("DQA_COMPLETENESS_MISSING_WEIGHT", "HIGH", "record", ("missing_weight",)),
    ("DQA_CONSISTENCY_HEIGHT_DECREASE", "HIGH", "child", ("height_decrease",)),
    ("DQA_CONSISTENCY_SEX_ACROSS_WAVES", "HIGH", "child", ("sex_inconsistent_across_waves",)),
    ("DQA_CONSISTENCY_BIRTHDATE_ACROSS_WAVES", "HIGH", "child", ("birthdate_inconsistent_across_waves",)),
    ("DQA_MEASUREMENT_DIGIT_HEAPING", "MEDIUM", "school_period", ("digit_heaping",)),
    ("DQA_REFERENCE_SCHOOL_NAME_DRIFT", "LOW", "file", ("school_name_drift",)),
    ("DQA_TIMELINESS_LATE_SUBMISSION", "MEDIUM", "file", ("late_submission",)),
    ("DQA_PROGRAM_ENROLLMENT_EXCEEDS_ALLOCATION", "MEDIUM", "school", ()),
)


# Exact passes, in order: name, keys, keys that must not be blank.
EXACT_PASSES = (
    ("DET_EXACT_LRN", ("school_id", "lrn_clean"), ("lrn_clean",)),
    ("DET_NAME_DOB_SEX", ("school_id", "student_name_clean", "birthday_str", "sex"), ("student_name_clean", "birthday_str", "sex")),
    ("DET_NAME_DOB_SEX_CROSS_SCHOOL", ("student_name_clean", "birthday_str", "sex"), ("student_name_clean", "birthday_str", "sex")),
)
# Blocking and training rules as lists of SQL expressions that must agree.
BLOCKING = (
    ("lrn_clean",),
    ("student_name_clean",),
    ("birthday_str",),
    ("school_id", "first_letter_name"),
    ("school_id", "substr(birthday_str, 1, 4)", "sex"),
)
TRAINING = (("lrn_clean",), ("birthday_str", "sex"), ("student_name_clean", "sex"))
# Similarities from which names agree, from the closest level down.
NAME_LEVELS = (0.95, 0.90, 0.82, 0.70)
@dataclass(frozen=True)
class Settings:
    """Thresholds, windows, rules and linkage settings; the defaults, which are fixed values, are the policy's.

    headers: more headers by dataset and field, beside the known ones.
    """

    height_cm: tuple[float, float] = (80.0, 200.0)
    weight_kg: tuple[float, float] = (10.0, 100.0)
    height_tolerance: float = 1.0
    heaping_share: float = 0.35
    heaping_least: int = 20
    grace_days: int = 14
    birth_years: tuple[int, int] = (2010, 2021)
    baseline: tuple[str, str] = ("2024-08-01", "2024-09-30")
    endline: tuple[str, str] = ("2025-03-01", "2025-04-30")
    slack_days: int = 365
    nominal_rice_kg: float = 0.09
    accept: float = 0.10
    floor: float = 0.10
    margin: float = 1.0
    sweep: tuple[float, ...] = (0.10, 0.15, 0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.90)
    seed: int = 42
    sample_pairs: int = 200_000
    rules: tuple = RULES
    passes: tuple = EXACT_PASSES
    blocking: tuple = BLOCKING
    training: tuple = TRAINING
    headers: dict[str, dict[str, list[str]]] = field(default_factory=dict)

    def datasets(self) -> tuple[Dataset, ...]:
        """The datasets with the additional headers."""
        strange = [f"{d}.{f}" for d, fields in self.headers.items() for f in fields if d not in DATASET or f not in DATASET[d].fields]
        if strange:
            raise ValueError(f"headers for unknown fields: {strange}")
        more = lambda d: {f: (c, (*known, *self.headers.get(d.name, {}).get(f, ()))) for f, (c, known) in d.fields.items()}
        return tuple(dataclasses.replace(d, fields=more(d)) for d in DATASETS)

    def threshold(self, name: str):
        """A value by its name; unknown names fail and tell the known ones."""
        known = {f.name: getattr(self, f.name) for f in dataclasses.fields(self)}
        if name not in known:
            raise KeyError(f"no threshold {name!r}; there are {sorted(known)}")
        return known[name]


def load_settings(path: str) -> Settings:
    """Settings from a file of JSON, TOML or YAML, which the driver reads; what it doesn't name keeps its default.

    rules names severities and scopes to change: {rule_id: {severity: ..., scope: ...}}.
    Unknown names fail.
    """
    text, kind = Path(path).read_text(encoding="utf-8"), Path(path).suffix.lower()
    if kind == ".toml":
        import tomllib

        told = tomllib.loads(text)
    elif kind in (".yml", ".yaml"):
        try:
            import yaml
        except ModuleNotFoundError as e:
            raise ValueError("settings in YAML need the package yaml; JSON and TOML need none") from e
        told = yaml.safe_load(text) or {}
    else:
        told = json.loads(text)
    fields = {f.name for f in dataclasses.fields(Settings)}
    if strange := sorted(set(told) - fields):
        raise ValueError(f"unknown settings {strange}; there are {sorted(fields)}")
    fixed = lambda x: tuple(map(fixed, x)) if isinstance(x, list) else x
    out = {k: v if k == "headers" else fixed(v) for k, v in told.items()}
    if isinstance(told.get("rules"), dict):
        changes = told["rules"]
        if strange := sorted(set(changes) - {r[0] for r in RULES}):
            raise ValueError(f"unknown rules {strange}")
        out["rules"] = tuple((r, changes.get(r, {}).get("severity", severity), changes.get(r, {}).get("scope", scope), d) for r, severity, scope, d in RULES)
    found = Settings(**out)
    if bad := sorted({r[1] for r in found.rules} - set(SEVERITIES)) or sorted({r[2] for r in found.rules} - set(SCOPES)):
        raise ValueError(f"unknown severities or scopes {bad}")
    found.datasets()
    return found




# No gold table or export may have one of these columns.
FORBIDDEN = ("student_name_clean", "child_name_raw", "true_name", "true_lrn", "lrn_clean", "raw_payload_json")


def ambiguous_headers(datasets: tuple[Dataset, ...] = DATASETS) -> list[str]:
    """Headers that two fields of a dataset claim, after folding; the first field would get them."""
    out = []
    for d in datasets:
        claims: dict[str, set[str]] = {}
        for name, (canonical, known) in d.fields.items():
            for h in (*known, name, canonical):
                claims.setdefault(fold_header_text(h), set()).add(name)
        out += [f"{d.name}: {h!r} for {sorted(names)}" for h, names in sorted(claims.items()) if len(names) > 1]
    return out


def unmapped_defects(rules=RULES) -> list[str]:
    """Defects that more than one rule claims."""
    seen: dict[str, int] = {}
    for _, _, _, defects in rules:
        for d in defects:
            seen[d] = seen.get(d, 0) + 1
    return sorted(d for d, n in seen.items() if n != 1)


# What columns of the tables may hold.
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
SCOPES = ("record", "child", "school", "school_period", "file")
PERIODS = ("baseline", "endline")
DECISIONS = ("accepted", "review", "rejected")
#: What to do about a finding, by the middle part of its rule's name, or by its whole name where that says more.
ACTIONS = {
    "SCHEMA": "Ask the school for a file with all required columns, or add the header to the known ones.",
    "COMPLETENESS": "Ask the school to fill in the missing value.",
    "VALIDITY": "Check the reference number against the school register.",
    "DATE": "Compare with the paper form and send the date as year-month-day.",
    "DUPLICATE": "Confirm which row is right and remove the other from the next submission.",
    "RANGE": "Measure again, or correct the unit or the decimal point.",
    "CONSISTENCY": "Compare both waves with the register and correct the wrong one.",
    "MEASUREMENT": "Visit the school with calibrated equipment and train those who measure.",
    "REFERENCE": "Use the name of the school as it is listed.",
    "TIMELINESS": "Note the reason for the delay and agree on a date with the school.",
    "PROGRAM": "Review the allocation against the present enrolment.",
    "DQA_CONSISTENCY_HEIGHT_DECREASE": "Measure the child again; check that both records belong to the same child.",
}


def action(rule_id: str) -> str:
    return ACTIONS.get(rule_id) or ACTIONS[rule_id.split("_")[1]]
