"""Raw files to scorecards on the tiny profile, and what a second load does."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelforge.config import FORBIDDEN, RULES
from panelforge.operators import resolver, scorecards
from panelforge.plans import ingest, lakehouse, synth


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    world = synth.generate(spark, f"{root}/raw", f"{root}/truth", "tiny", 2026)
    assert lakehouse.full_refresh(spark, f"{root}/raw", f"{root}/lake", f"{root}/truth", f"{root}/out")[-1] == "export"
    return root, world


def test_all_rows_arrive(spark, lake):
    root, world = lake
    n = sum(len(x) for x in world.waves.values())
    assert ingest.current(spark, f"{root}/lake", "school_submission").count() == n
    assert spark.read.parquet(f"{root}/lake/child_records").count() == n
    m = ingest.manifest(spark, f"{root}/lake")
    assert m.filter("status = 'ingested'").count() == 5 * 2 + 3


def test_links_keep_their_floors(spark, lake):
    root, _ = lake
    r = spark.read.parquet(f"{root}/lake/linkage_results")
    assert resolver.conflicts(r).count() == 0
    card = {(x.method, x.threshold): x for x in spark.read.parquet(f"{root}/lake/linkage_scorecard").collect()}
    probable, exact = card["probabilistic", 0.1], card["deterministic", 0.1]
    assert probable.precision == 1.0 and probable.recall >= 0.92 and probable.f1 >= 0.95
    assert probable.transfer_recall >= 0.70 and probable.review_queue <= 75
    assert exact.precision == 1.0 and exact.recall <= 0.75


def test_rules_keep_their_floors(spark, lake):
    root, _ = lake
    scored = spark.read.parquet(f"{root}/lake/dqa_scorecard")
    card = {x.rule_id: x for x in scored.collect()}
    assert scorecards.rule_totals(scored).collect()[0].sensitivity >= 0.90
    for rule in ("RANGE_IMPLAUSIBLE_HEIGHT", "RANGE_IMPLAUSIBLE_WEIGHT"):
        assert card[f"DQA_{rule}"].sensitivity >= 0.95, rule
    for rule in ("COMPLETENESS_MISSING_LRN", "VALIDITY_MALFORMED_LRN", "COMPLETENESS_MISSING_WEIGHT", "DATE_EXCEL_SERIAL", "DATE_AMBIGUOUS_FORMAT", "DUPLICATE_EXACT_ROW", "MEASUREMENT_DIGIT_HEAPING", "TIMELINESS_LATE_SUBMISSION"):
        x = card[f"DQA_{rule}"]
        assert x.injected > 0 and x.sensitivity >= 0.9, rule


def test_every_mapped_rule_gets_its_defects(spark, lake):
    root, world = lake
    card = {x.rule_id: x for x in spark.read.parquet(f"{root}/lake/dqa_scorecard").collect()}
    for rule, _, _, defects in RULES:
        assert (card[rule].injected > 0) == bool(defects), rule
    for rule in ("DUPLICATE_LRN_WITHIN_SCHOOL_PERIOD", "MEASUREMENT_DIGIT_HEAPING", "REFERENCE_SCHOOL_NAME_DRIFT", "TIMELINESS_LATE_SUBMISSION"):
        assert card[f"DQA_{rule}"].sensitivity >= 0.9, rule
    for rule in ("REFERENCE_SCHOOL_NAME_DRIFT", "TIMELINESS_LATE_SUBMISSION"):
        assert card[f"DQA_{rule}"].false_positives == 0, rule
    files = [d for d in world.defects if d["defect_type"] in ("school_name_drift", "late_submission")]
    assert len(files) == 2 and all(d["record_id"] == d["source_file_id"] for d in files)


def test_lagging_schools_get_less():
    got = synth._allocated({f"SCH_{i}": 1000 for i in range(400)}, 2026)
    lagging = [n for n in got.values() if n < 900]
    assert abs(len(lagging) - synth.LAGGING * 400) < 40
    assert all(620 <= n <= 860 for n in lagging) and all(980 <= n <= 1060 for n in got.values() if n >= 900)


def test_nothing_private_is_published(spark, lake):
    root, _ = lake
    for n in lakehouse.MARTS:
        assert not set(FORBIDDEN) & set(spark.read.parquet(f"{root}/out/parquet/{n}").columns)
        assert spark.read.option("header", True).csv(f"{root}/out/csv/{n}").count() == spark.read.parquet(f"{root}/out/parquet/{n}").count()


def test_a_second_load_adds_nothing_and_changed_bytes_replace(spark, lake):
    root, world = lake
    raw, out = f"{root}/raw", f"{root}/lake"
    again = ingest.run(spark, raw, out, run_id="second")
    assert (again.ingested, again.skipped, again.rows) == (0, 13, 0)
    seen = {(r.source_file_id, r.status): (r.row_count, r.dataset) for r in spark.read.parquet(f"{out}/manifest").collect()}
    files = {f for f, _ in seen}
    assert all(seen[f, "skipped"] == seen[f, "ingested"] for f in files) and len(files) == 13
    path = next(Path(raw, "baseline").glob("*.csv"))
    good, lines = path.read_bytes(), path.read_text().splitlines()
    before = ingest.current(spark, out, "school_submission").count()
    path.write_text("\n".join(lines[:-5]) + "\n")
    less = ingest.run(spark, raw, out, run_id="third")
    assert (less.ingested, less.superseded) == (1, 1)
    assert ingest.current(spark, out, "school_submission").count() == before - 5
    path.write_text("nothing,of,use\n1,2,3\n")
    bad = ingest.run(spark, raw, out, run_id="fourth")
    assert (bad.ingested, bad.failed) == (0, 1)
    assert ingest.current(spark, out, "school_submission").count() == before - 5
    path.write_bytes(good)


def test_same_seed_same_world():
    a, b = synth.world(sizes=(1, 1, 2, 50), seed=3), synth.world(sizes=(1, 1, 2, 50), seed=3)
    assert a.waves == b.waves
    assert synth.xlsx_bytes([["a"]]) == synth.xlsx_bytes([["a"]])


def test_report_escapes(spark):
    assert "&lt;b&gt;" in lakehouse.report(spark.createDataFrame([("<b>",)], "x string"), "t")


def test_steps_and_reports(spark, lake):
    root, _ = lake
    assert lakehouse.select(("build-gold",), upstream=True) == ["ingest", "build-silver", "run-dqa", "run-linkage", "build-gold"]
    with pytest.raises(ValueError):
        lakehouse.select(("build-lead",))
    found = lakehouse.reports(spark, f"{root}/lake")
    card = spark.read.parquet(f"{root}/lake/dqa_scorecard")
    total = card.agg(F.sum("injected"), F.sum("detected")).collect()[0]
    assert set(found) == {"dqa_scorecard", "linkage_scorecard", "summary"} and f"{total[1]} of {total[0]} injected" in found["summary"]
    assert all(r.rule_id in found["dqa_scorecard"] for r in card.collect())
    assert "<h1>Summary</h1>" in "".join(r.value for r in spark.read.text(f"{root}/out/reports/summary.html").collect())
    issues = spark.read.parquet(f"{root}/lake/dqa_issues")
    assert issues.filter("suggested_action is null or message is null").count() == 0
    assert spark.read.parquet(f"{root}/lake/contract_violations").filter("n > 0").count() == 0


def test_saved_model_gives_the_same_links(spark, lake):
    from panelforge.operators import linkage

    root, _ = lake
    before = {tuple(r) for r in spark.read.parquet(f"{root}/lake/linkage_results").select("link_id", "decision").collect()}
    again = lakehouse.run_linkage(spark, f"{root}/lake", model=linkage.load(spark, f"{root}/lake/linkage_model"))
    assert {tuple(r) for r in again.select("link_id", "decision").collect()} == before


def test_command_line(spark, lake, tmp_path, capsys):
    from panelforge.__main__ import main

    root, _ = lake
    (tmp_path / "s.json").write_text('{"grace_days": 7}')
    assert main(["doctor", "--settings", f"{tmp_path}/s.json"]) == 0
    where = ["--raw", f"{root}/raw", "--lake", f"{root}/lake", "--truth", f"{root}/truth", "--out", f"{tmp_path}/out"]
    assert main(["full-refresh", "--only", "verify", "export", *where]) == 0
    assert capsys.readouterr().out.split()[-2:] == ["verify", "export"]


def test_streaming_intake(spark, tmp_path):
    from panelforge.streaming import intake

    synth.generate(spark, f"{tmp_path}/raw", f"{tmp_path}/truth", sizes=(1, 1, 2, 20))
    q = intake.start(spark, f"{tmp_path}/raw", f"{tmp_path}/lake", f"{tmp_path}/mark")
    q.awaitTermination(180)
    assert ingest.manifest(spark, f"{tmp_path}/lake").filter(F.col("status") == "ingested").count() == 7
