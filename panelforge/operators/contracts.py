"""What the tables of the lake promise, and the rows that break it."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.config import DECISIONS, PERIODS, SCOPES, SEVERITIES
from panelforge.operators.profile import violations


@dataclass(frozen=True)
class Contract:
    """Columns without nulls, unique columns, accepted values, ranges, and columns that refer to (table, column)."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    between: dict[str, tuple] = field(default_factory=dict)
    refers: dict[str, tuple[str, str]] = field(default_factory=dict)


_SHARE = (0.0, 1.0)
CONTRACTS = {
    "schools": Contract(("school_id", "school_name"), ("school_id",), {"treatment_status": (0, 1)}),
    "child_records": Contract(("child_record_id", "school_id", "period", "source_file_id"), ("child_record_id",), {"period": PERIODS, "sex": ("Male", "Female")}),
    "measurements": Contract(
        ("measurement_id", "child_record_id", "school_id", "period", "measurement_quality_flag"),
        ("measurement_id", "child_record_id"),
        {"period": PERIODS, "measurement_quality_flag": ("valid", "missing_measurement", "implausible", "date_issue")},
        refers={"child_record_id": ("child_records", "child_record_id")},
    ),
    "allocations": Contract(("school_id", "school_year"), refers={"school_id": ("schools", "school_id")}),
    "dqa_issues": Contract(
        ("issue_id", "rule_id", "severity", "scope", "message", "suggested_action", "run_id", "detected_at"), ("issue_id",), {"severity": SEVERITIES, "scope": SCOPES, "resolved_status": ("unresolved", "resolved", "accepted")}
    ),
    "linkage_candidates": Contract(("candidate_id", "baseline_record_id", "endline_record_id", "method"), ("candidate_id",), {"method": ("deterministic", "probabilistic")}, {"match_probability": _SHARE}),
    "linkage_results": Contract(
        ("link_id", "baseline_record_id", "endline_record_id", "decision"),
        ("link_id",),
        {"decision": DECISIONS},
        {"match_probability": _SHARE},
        {"baseline_record_id": ("child_records", "child_record_id"), "endline_record_id": ("child_records", "child_record_id")},
    ),
    "gold_evaluation_child_panel": Contract(("panel_child_id", "school_id", "has_critical_issue"), ("panel_child_id",), {"sex": ("Male", "Female")}, {"link_probability": _SHARE}, {"school_id": ("schools", "school_id")}),
    "gold_school_monitoring_mart": Contract(("school_id", "baseline_records", "endline_records", "dqa_issue_count"), refers={"school_id": ("schools", "school_id")}),
    "gold_dqa_command_center": Contract(("school_id", "period", "rule_id", "issue_count")),
}


def check(tables: dict[str, DataFrame], contracts: dict[str, Contract] | None = None) -> DataFrame:
    """table_name, check_name, column_name and the number n of rows that break it, for all promises about tables that are there.

    A promise about a column that a table lacks is broken by all of its rows, by one at least.
    """
    spark = next(iter(tables.values())).sparkSession
    parts = [spark.createDataFrame([], "table_name string, check_name string, column_name string, n long")]
    for name, c in (contracts or CONTRACTS).items():
        if name not in tables:
            continue
        df = tables[name]
        here = set(df.columns)
        lost = sorted({*c.not_null, *c.unique, *c.accepted, *c.between, *c.refers} - here)
        if lost:
            n = df.agg(F.greatest(F.count("*"), F.lit(1)).alias("n"))
            parts += [n.select(F.lit(name).alias("table_name"), F.lit("exists").alias("check_name"), F.lit(x).alias("column_name"), "n") for x in lost]
        kept = lambda d: {k: v for k, v in d.items() if k in here}  # noqa: B023,E731
        refers = {k: (tables[t], x) for k, (t, x) in kept(c.refers).items() if t in tables}
        checks = (tuple(x for x in c.not_null if x in here), tuple(x for x in c.unique if x in here), kept(c.accepted), kept(c.between), refers)
        if any(checks):
            parts.append(violations(df, name, *checks))
    return reduce(DataFrame.unionByName, parts)


def reconcile(children: DataFrame, measurements: DataFrame) -> DataFrame:
    """Children with no measurement or more than one; it must be empty."""
    n = measurements.groupBy("child_record_id").agg(F.count("*").alias("n"))
    return children.select("child_record_id").join(n, "child_record_id", "left").select("child_record_id", F.coalesce("n", F.lit(0)).alias("n")).filter("n <> 1")
