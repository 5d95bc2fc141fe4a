"""Bronze to silver, findings, links, marts, exports and scores: each step reads and writes tables of a lake."""

from __future__ import annotations

import html
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.config import Settings
from panelforge.operators import contracts, linkage, marts, resolver, rules, scorecards
from panelforge.plans import catalog, ingest

MARTS = ("evaluation_child_panel", "school_monitoring_mart", "dqa_command_center", "linkage_review_mart", "program_exposure_mart", "public_dashboard_metrics")


def save(df: DataFrame, lake: str, name: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{lake}/{name}")
    return df.sparkSession.read.parquet(f"{lake}/{name}")


def read(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{lake}/{name}")


def build_silver(spark: SparkSession, lake: str, settings: Settings | None = None) -> dict[str, DataFrame]:
    b = ingest.tables(spark, lake)
    schools = save(marts.schools(b["school_masterlist"]), lake, "schools")
    children = save(marts.child_records(b["school_submission"], schools), lake, "child_records")
    return {
        "schools": schools,
        "child_records": children,
        "measurements": save(marts.measurements(b["school_submission"], children, settings), lake, "measurements"),
        "allocations": save(marts.allocations(b["program_allocation"], b["enrollment_snapshot"], schools, settings), lake, "allocations"),
    }


def run_dqa(spark: SparkSession, lake: str, settings: Settings | None = None, run_id: str = "run") -> DataFrame:
    frames = catalog.load(spark, lake, ("child_records",), ("schools", "measurements", "allocations", "schema_drift"))
    frames["file_manifest"] = ingest.manifest(spark, lake)
    return save(rules.evaluate(frames, settings, run_id), lake, "dqa_issues")


def run_linkage(spark: SparkSession, lake: str, settings: Settings | None = None, model: dict | None = None) -> DataFrame:
    """Candidates of both methods; only the probabilistic ones are resolved, the exact ones stay as a benchmark.

    model: as linkage.load() gives it; without one, a model is trained and saved as linkage_model.
    """
    s = settings or Settings()
    baseline, endline = linkage.waves(read(spark, lake, "child_records"))
    linkage.check_settings(s)
    if model is None:
        model = linkage.train(baseline, endline, s)
        linkage.save(spark, model, f"{lake}/linkage_model")
    probable = linkage.probabilistic_candidates(baseline, endline, model, s.blocking)
    candidates = save(probable.unionByName(linkage.exact_candidates(baseline, endline, s.passes)), lake, "linkage_candidates")
    links = resolver.resolve(candidates.filter("method = 'probabilistic'"), s.accept, s.floor, s.margin)
    links = save(links, lake, "linkage_results")
    if resolver.conflicts(links).limit(1).count():
        raise ValueError("a record has two accepted links")
    save(resolver.review_queue(links), lake, "review_queue")
    return links


def build_gold(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    t = {n: read(spark, lake, n) for n in ("schools", "child_records", "measurements", "allocations", "dqa_issues", "linkage_results", "linkage_candidates")}
    monitoring = marts.monitoring(t["schools"], t["child_records"], t["dqa_issues"], t["linkage_results"], t["allocations"])
    out = {
        "evaluation_child_panel": marts.evaluation_panel(t["linkage_results"], t["child_records"], t["measurements"], t["schools"], t["dqa_issues"]),
        "school_monitoring_mart": monitoring,
        "dqa_command_center": marts.command_center(t["dqa_issues"]),
        "linkage_review_mart": marts.review(t["linkage_results"], t["linkage_candidates"]),
        "program_exposure_mart": marts.exposure(t["allocations"], t["schools"]),
        "public_dashboard_metrics": marts.public_metrics(monitoring),
    }
    return {n: save(marts.check_public(df, n), lake, f"gold_{n}") for n, df in out.items()}


def verify(spark: SparkSession, lake: str) -> DataFrame:
    """Counts of all broken promises as the table contract_violations; raises if there are any."""
    tables = {n: df for n in contracts.CONTRACTS if (df := ingest.read_or_none(spark, f"{lake}/{n}")) is not None}
    out = save(contracts.check(tables), lake, "contract_violations")
    broken = [f"{r.table_name}.{r.column_name}: {r.check_name} ({r.n})" for r in out.filter("n > 0").orderBy("table_name", "column_name", "check_name").collect()]
    if "child_records" in tables and "measurements" in tables and (n := contracts.reconcile(tables["child_records"], tables["measurements"]).count()):
        broken.append(f"measurements: {n} children without exactly one")
    if broken:
        raise ValueError("broken contracts: " + "; ".join(broken))
    return out


def export(spark: SparkSession, lake: str, to: str) -> None:
    """All marts as CSV with a header and as Parquet, and a data dictionary. What was written is read again and checked."""
    tables = {n: marts.check_public(read(spark, lake, f"gold_{n}"), n) for n in MARTS}
    for n, df in tables.items():
        df.write.mode("overwrite").option("header", "true").csv(f"{to}/csv/{n}")
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{to}/parquet/{n}")
        marts.check_public(spark.read.option("header", "true").csv(f"{to}/csv/{n}"), f"csv/{n}")
        marts.check_public(spark.read.parquet(f"{to}/parquet/{n}"), f"parquet/{n}")
    marts.dictionary(tables).write.mode("overwrite").option("header", "true").csv(f"{to}/csv/data_dictionary")


def score(spark: SparkSession, lake: str, truth: str, settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """Both scorecards; the only step that reads the answer key."""
    children, links, defects = (spark.read.parquet(f"{truth}/{n}") for n in ("truth_children", "truth_links", "truth_defects"))
    dqa = save(scorecards.rule_scorecard(defects, read(spark, lake, "dqa_issues"), (settings or Settings()).rules), lake, "dqa_scorecard")
    link = save(scorecards.link_scorecard(read(spark, lake, "linkage_candidates"), links, children.count(), settings), lake, "linkage_scorecard")
    return dqa, link


def _html(title: str, sections: list[tuple[str, list[str], list[tuple]]], notes: tuple[str, ...] = ()) -> str:
    cell = lambda tag, x: f"<{tag}>{html.escape('' if x is None else f'{x:.4f}' if isinstance(x, float) else str(x))}</{tag}>"
    parts = [f"<!DOCTYPE html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>", *[f"<p>{html.escape(x)}</p>" for x in notes]]
    for name, columns, rows in sections:
        head = "".join(cell("th", c) for c in columns)
        body = "".join("<tr>" + "".join(cell("td", x) for x in r) + "</tr>" for r in rows)
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    return "".join(parts)


def _section(name: str, df: DataFrame, most: int | None = None) -> tuple[str, list[str], list[tuple]]:
    rows = [tuple(r) for r in (df if most is None else df.limit(most + 1)).collect()]
    cut = most is not None and len(rows) > most
    return f"{name} (the first {most} rows)" if cut else name, df.columns, rows[:most] if cut else rows


def report(df: DataFrame, title: str, most: int = 200) -> str:
    """A table as HTML; the heading says so if it is cut."""
    return _html(title, [_section("Rows", df, most)])


def reports(spark: SparkSession, lake: str) -> dict[str, str]:
    """Three reports from the scorecards, whose rows are those of the policy and of the sweep, so a few dozen."""
    dqa, link = read(spark, lake, "dqa_scorecard"), read(spark, lake, "linkage_scorecard")
    total = scorecards.rule_totals(dqa)
    best = link.filter("method = 'probabilistic'").orderBy(F.desc("f1"), "threshold").limit(1)
    at = link.filter(F.col("threshold") == link.agg(F.min("threshold").alias("t")).collect()[0]["t"]).orderBy("method")
    weak = dqa.filter("injected > 0 and sensitivity < 0.9").orderBy("sensitivity", "rule_id")
    queue = read(spark, lake, "review_queue").groupBy("review_reason").agg(F.count("*").alias("pairs")).orderBy("review_reason")
    first = total.collect()[0]
    say = f"{first.detected} of {first.injected} injected defects were found; {first.false_positives} findings belong to none."
    return {
        "dqa_scorecard": _html("Data quality scorecard", [_section("All rules", total), _section("By rule", dqa.orderBy("rule_id"))], (say,)),
        "linkage_scorecard": _html("Linkage scorecard", [_section("Best threshold", best), _section("By method and threshold", link.orderBy("method", "threshold"))]),
        "summary": _html("Summary", [_section("Rules", total), _section("Rules that miss defects", weak), _section("Linkage at the lowest threshold", at), _section("Pairs to look at", queue)], (say,)),
    }


def write_reports(spark: SparkSession, lake: str, to: str) -> None:
    """The reports as one text file each below to, in any file system that Spark writes to."""
    for name, text in reports(spark, lake).items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{to}/reports/{name}.html")


#: Steps by name, in order, and the ones that each needs.
STEPS: dict[str, tuple[str, ...]] = {
    "ingest": (),
    "build-silver": ("ingest",),
    "run-dqa": ("build-silver",),
    "run-linkage": ("build-silver",),
    "build-gold": ("run-dqa", "run-linkage"),
    "verify": ("build-gold",),
    "score": ("run-dqa", "run-linkage"),
    "export": ("build-gold",),
}


def select(wanted: tuple[str, ...] | None, upstream: bool = False) -> list[str]:
    """The wanted steps (None: all) in order; upstream: with all that they need."""
    if wanted is None:
        return list(STEPS)
    if strange := sorted(set(wanted) - set(STEPS)):
        raise ValueError(f"unknown steps {strange}; there are {list(STEPS)}")
    found = set(wanted)
    while upstream and (more := {x for s in found for x in STEPS[s]} - found):
        found |= more
    return [s for s in STEPS if s in found]


def full_refresh(spark: SparkSession, raw: str, lake: str, truth: str | None = None, to: str | None = None, settings: Settings | None = None, only: tuple[str, ...] | None = None, upstream: bool = False) -> list[str]:
    """All steps in order, or some; the names of those that ran. A scheduler can call it with one step at a time."""

    def scores() -> None:
        score(spark, lake, truth, settings)
        if to:
            write_reports(spark, lake, to)

    steps: dict[str, Callable[[], object]] = {
        "ingest": lambda: ingest.run(spark, raw, lake, settings),
        "build-silver": lambda: build_silver(spark, lake, settings),
        "run-dqa": lambda: run_dqa(spark, lake, settings),
        "run-linkage": lambda: run_linkage(spark, lake, settings),
        "build-gold": lambda: build_gold(spark, lake),
        "verify": lambda: verify(spark, lake),
    }
    if truth:
        steps["score"] = scores
    if to:
        steps["export"] = lambda: export(spark, lake, to)
    names = [n for n in select(only, upstream) if n in steps]
    for n in names:
        steps[n]()
    return names
