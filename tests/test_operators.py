"""Rules, linkage, resolver and marts on small frames."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelforge.config import RULES, unmapped_defects
from panelforge.functions import ids, similarity, text
from panelforge.operators import linkage, marts, profile, resolver, rules, scorecards, versions
from panelforge.sources import files, headers, sheets

CHILD = "child_record_id string, school_id string, period string, lrn_clean string, student_name_clean string, first_letter_name string, birthday_str string, sex string, grade string, source_file_id string, source_row_number long, raw_payload_json string"
MEASURE = "measurement_id string, child_record_id string, school_id string, period string, measurement_date timestamp_ntz, height_cm double, weight_kg double"


def child(i, **over):
    row = {"child_record_id": f"R{i}", "school_id": "S1", "period": "baseline", "lrn_clean": f"{100000000000 + i}", "student_name_clean": f"NAME {i}", "first_letter_name": "N", "birthday_str": "2015-03-04", "sex": "Male", "grade": "1", "source_file_id": "F1", "source_row_number": i, "raw_payload_json": None} | over
    return tuple(row.values())


def measured(i, **over):
    row = {"measurement_id": f"M{i}", "child_record_id": f"R{i}", "school_id": "S1", "period": "baseline", "measurement_date": datetime(2024, 9, 1), "height_cm": 124.3, "weight_kg": 23.7} | over
    return tuple(row.values())


def frames(spark, children=(), measures=(), **more):
    return {
        "child_records": spark.createDataFrame(list(children), CHILD),
        "measurements": spark.createDataFrame(list(measures), MEASURE),
        "schools": spark.createDataFrame([("S1", "School One")], "school_id string, school_name string"),
        "allocations": spark.createDataFrame(more.get("allocations", []), "school_id string, allocated_children double, current_enrollment double"),
        "file_manifest": spark.createDataFrame(more.get("files", []), "source_file_id string, school_id_guess string, period_guess string, modified_at timestamp_ntz"),
        "schema_drift": spark.createDataFrame(more.get("drift", []), "source_file_id string, column_name_raw string, drift_type string, mapped_to string"),
    }


def test_clean_frames_have_no_findings(spark):
    f = frames(spark, [child(1), child(2)], [measured(1), measured(2)], allocations=[("S1", 300.0, 280.0)], files=[("F1", "S1", "baseline", datetime(2024, 10, 1))], drift=[("F1", "x", "unmapped", None)])
    assert rules.evaluate(f).count() == 0


def test_every_rule_fires(spark):
    payload = '{"School":"Shool 1","Date of Birth":"%s"}'
    children = [
        child(1, lrn_clean=None), child(2, lrn_clean="12"), child(3, birthday_str=" "), child(4, sex="X"), child(5, raw_payload_json=payload % "01/02/2015"), child(6, raw_payload_json=payload % "42000"),
        child(7, raw_payload_json=payload % "2015-02-30"), child(8), child(8, child_record_id="R8b"), child(9, lrn_clean="900000000001"), child(10, lrn_clean="900000000001"),
        child(11, lrn_clean="800000000001"), child(12, lrn_clean="800000000001", period="endline", sex="Female", birthday_str="2016-01-01"),
    ]
    measures = [measured(1, height_cm=20.0), measured(2, weight_kg=200.0), measured(3, height_cm=None), measured(4, weight_kg=None), measured(11, height_cm=130.0), measured(12, height_cm=120.0, period="endline")]
    measures += [measured(100 + i, height_cm=120.0, period="endline") for i in range(25)]
    f = frames(spark, children, measures, allocations=[("S1", 100.0, 101.0)], files=[("F1", "S1", None, datetime(2024, 10, 20))], drift=[("F1", "sex", "missing_required", "sex")])
    got = rules.evaluate(f)
    assert {r.rule_id for r in got.select("rule_id").distinct().collect()} == {r[0] for r in RULES}
    assert got.count() == got.select("issue_id").distinct().count()
    by = {r.rule_id: {x.record_id for x in got.filter(F.col("rule_id") == r.rule_id).collect()} for r in got.select("rule_id").distinct().collect()}
    assert by["DQA_DUPLICATE_EXACT_ROW"] == {"R8b"} and by["DQA_DUPLICATE_LRN_WITHIN_SCHOOL_PERIOD"] == {"R10"}
    assert by["DQA_CONSISTENCY_HEIGHT_DECREASE"] == by["DQA_CONSISTENCY_SEX_ACROSS_WAVES"] == by["DQA_CONSISTENCY_BIRTHDATE_ACROSS_WAVES"] == {"R12"}
    assert by["DQA_DATE_IMPOSSIBLE"] == {"R7"} and by["DQA_DATE_AMBIGUOUS_FORMAT"] == {"R5"} and by["DQA_DATE_EXCEL_SERIAL"] == {"R6"}


def test_missing_frames_skip_their_rules(spark):
    f = frames(spark, [child(1, lrn_clean=None)])
    assert {r.rule_id for r in rules.evaluate({"child_records": f["child_records"]}).collect()} == {"DQA_COMPLETENESS_MISSING_LRN"}


def test_policy_is_whole():
    rules.check_policy()
    assert not unmapped_defects()
    with pytest.raises(ValueError):
        rules.check_policy(RULES[:-1])


def sequential(pairs, accept, floor, margin):
    """The resolver as one scan over the pairs, best first."""
    above = [p for p in pairs if p["p"] >= accept]

    def runner_up(p, side):
        return sorted((q["w"] for q in above if q[side] == p[side]), reverse=True)

    clear = set()
    for p in above:
        ok = not p["amb"]
        for side in ("b", "e"):
            w = runner_up(p, side)
            ok &= p["w"] == w[0] and (len(w) < 2 or p["w"] - w[1] > margin)
        if ok:
            clear.add((p["b"], p["e"]))
    used, out = set(), {}
    for p in sorted(pairs, key=lambda x: (-x["p"], -x["w"], x["b"], x["e"])):
        k = (p["b"], p["e"])
        if p["p"] < accept:
            out[k] = "review" if p["p"] >= floor else "rejected"
        elif ("b", p["b"]) in used or ("e", p["e"]) in used:
            out[k] = "rejected"
        elif k in clear:
            out[k] = "accepted"
            used |= {("b", p["b"]), ("e", p["e"])}
        else:
            out[k] = "review"
    return out


def test_resolver_equals_the_sequential_scan(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for g in range(60):
        pairs = [{"b": f"b{g}_{i}", "e": f"e{g}_{j}", "p": rng.choice([0.05, 0.3, 0.5, 0.9]), "w": float(rng.randint(0, 6)), "amb": rng.random() < 0.1} for i in range(4) for j in range(4) if rng.random() < 0.5]
        want |= sequential(pairs, 0.4, 0.2, 1.0)
        rows += [(f"c{x['b']}{x['e']}", x["b"], x["e"], "probabilistic", x["p"], x["w"], "S1", "S1" if rng.random() < 0.8 else "S2", x["amb"]) for x in pairs]
    df = spark.createDataFrame(rows, "candidate_id string, baseline_record_id string, endline_record_id string, method string, match_probability double, match_weight double, baseline_school_id string, endline_school_id string, ambiguous boolean")
    got = resolver.resolve(df, 0.4, 0.2, 1.0)
    assert {(r.baseline_record_id, r.endline_record_id): r.decision for r in got.collect()} == want
    assert resolver.conflicts(got).count() == 0


def test_linkage_survives_noise(spark):
    rng = random.Random(2)
    names = [f"{a}{b} {c}{d}" for a in "ABCD" for b in ("NNA", "LLEN", "RIO") for c in "EFGH" for d in ("STAR", "ONDA", "ULLI")]
    base, end = [], []
    for i, n in enumerate(names):
        b = child(i, student_name_clean=n, first_letter_name=n[0], birthday_str=f"20{10 + i % 9}-0{1 + i % 9}-1{i % 9}", sex=rng.choice(["Male", "Female"]))
        base.append(b)
        e = list(b)
        e[0], e[2] = f"E{i}", "endline"
        if i % 3 == 0:
            e[3] = None
        if i % 4 == 0:
            e[4] = n[:2] + n[3] + n[2] + n[4:]
        end.append(tuple(e))
    b, e = spark.createDataFrame(base, CHILD), spark.createDataFrame(end, CHILD)
    model = linkage.train(b, e)
    links = resolver.resolve(linkage.probabilistic_candidates(b, e, model)).filter("decision = 'accepted'").collect()
    right = [x for x in links if x.baseline_record_id[1:] == x.endline_record_id[1:]]
    assert len(right) >= 0.98 * len(links) and len(right) >= 0.9 * len(names)


def test_model_is_kept_as_text(spark, tmp_path):
    model = {"prior": 0.01, "m": {g: [0.5] * linkage.HEIGHTS[g] for g in linkage.GAMMAS}, "u": {g: [0.25] * linkage.HEIGHTS[g] for g in linkage.GAMMAS}}
    linkage.save(spark, model, str(tmp_path / "m"))
    assert linkage.load(spark, str(tmp_path / "m")) == model
    linkage.save(spark, {"prior": 0.1, "m": {}, "u": {}}, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        linkage.load(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        linkage.train(spark.createDataFrame([], CHILD), spark.createDataFrame([], CHILD))


def jaro_winkler(a, b):
    """The definition, letter by letter."""
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    partner = {}
    for i, x in enumerate(a):
        free = [j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if b[j] == x and j not in partner.values()]
        if free:
            partner[i] = free[0]
    m = len(partner)
    if not m:
        return 0.0
    swapped = sum(a[i] != b[j] for i, j in zip(partner, sorted(partner.values()), strict=True)) // 2
    s = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    same = next((k for k in range(4) if k >= min(len(a), len(b)) or a[k] != b[k]), 4)
    return s + same * 0.1 * (1 - s) if s > 0.7 else s


def test_similarity(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("ABCÑ 中", k=rng.choice([0, 1, 2, 3, 5, 9, 20, 100])))
    pairs = [("MARTHA", "MARHTA"), ("DIXON", "DICKSONX"), ("A", ""), ("", ""), (None, "A"), ("A", None), *((word(), word()) for _ in range(400))]
    for _ in range(200):
        a = list(word())
        b = a[:]
        rng.shuffle(b) if rng.random() < 0.3 else b.reverse() if rng.random() < 0.2 else b.insert(len(b) // 2, "X")
        pairs.append(("".join(a), "".join(b)))
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.jaro_winkler("a", "b").alias("s")).collect()
    for r in got:
        assert r.s is None if r.a is None or r.b is None else r.s == pytest.approx(jaro_winkler(r.a, r.b), abs=1e-12), (r.a, r.b)
    assert got[0].s == pytest.approx(0.9611, abs=1e-4) and got[1].s == pytest.approx(0.8133, abs=1e-4)
    cases = [("2015-01-02", "2015-01-02", True), ("2015-01-02", "2015-01-20", True), ("2015-01-02", "2015-10-02", True), ("2015-01-02", "2015-01-03", True), ("2015-01-02", "2015-02-03", False), ("ab", "ba", True), ("abc", "cba", False), (None, "a", None)]
    df = spark.createDataFrame(cases, "a string, b string, want boolean")
    assert all(r.want == r.got for r in df.select("want", similarity.one_edit(F.col("a"), F.col("b")).alias("got")).collect())


def test_text_functions(spark):
    df = spark.createDataFrame([(" Émilie  O'Nell-2 ", "﻿x")], "a string, b string")
    r = df.select(text.standard_name(F.col("a")), text.fold_header(F.lit("  Sch. Náme (cm)ﬁ ")), ids.stable_id(F.lit("a"), F.lit(None).cast("string")), text.cell_text(F.lit(3.0)), text.cell_text(F.lit(float("nan"))), text.digits(F.lit("1-2")), text.digits(F.lit("x"))).collect()[0]
    import hashlib

    assert tuple(r) == ("EMILIE O'NELL-", "sch name cm fi", hashlib.sha256(b"a|").hexdigest()[:16], "3", "", "12", None)
    assert text.fold_header_text("  Sch. Náme (cm)ﬁ ") == "sch name cm fi"


def test_headers_and_votes(spark):
    h = spark.createDataFrame([("A", ["School", "SY", "Total Enrolment"]), ("B", ["LRN", "DOB"]), ("C", ["School", "Name"]), ("D", ["School"])], "source_file_id string, headers array<string>")
    assert {r.source_file_id: r.dataset for r in headers.vote(h).collect()} == {"A": "enrollment_snapshot", "C": "school_submission", "D": "enrollment_snapshot"}


def test_sheets():
    from panelforge.plans.synth import xlsx_bytes

    rows = list(sheets.parse("a.csv", 'title\n\nSchool,School,,Name\nx,"a\nb",1.0,é\n,,,\ny\n'.encode("cp1252")))
    assert rows[0][:4] == ("", 3, 1, ["School", "School__2", "column_3", "Name"])
    assert [r[2] for r in rows] == list(range(1, len(rows) + 1))
    assert [r[4] for r in sheets.parse("a.xlsx", xlsx_bytes([["School", "Name"], ["x", "<y>"]]))] == [["x", "<y>"]]
    assert sheets.cell_text(3.0) == "3" and sheets.cell_text(float("nan")) == "" and sheets.cell_text(None) == ""


def test_damaged_files_are_findings(spark):
    f = spark.createDataFrame([("1", "a.xlsx", b"junk"), ("2", "b.csv", b""), ("3", "c.csv", b"School,Name\nx,y\n")], "source_file_id string, source_file_path string, content binary")
    got = {r.source_file_id: r for r in sheets.rows(f).collect()}
    assert got["1"].error and got["2"].error == "no rows" and got["3"].cells == ["x", "y"]


def test_paths(spark):
    df = spark.createDataFrame([("baseline/sch-0007_v2.csv",), ("x_endline_masterlist.csv",), ("zz.csv",)], "p string")
    assert [tuple(r) for r in df.select(files.path_dataset(F.col("p")), files.path_period(F.col("p")), files.path_school(F.col("p"))).collect()] == [("school_submission", "baseline", "SCH_0007"), ("school_masterlist", "endline", None), (None, None, None)]


def test_versions_and_expectations(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "k int, v int, x string")
    assert {(r.k, r.x) for r in versions.latest(df, ["k"], ["v"]).collect()} == {(1, "b"), (2, None)}
    got = {(r.check_name, r.column_name): r.n for r in profile.violations(df, "t", ("x",), ("k",), {"x": ("a",)}, {"v": (1, 1)}, {"k": (df.filter("k = 1"), "k")}).collect()}
    assert got == {("not_null", "x"): 1, ("unique", "k"): 1, ("accepted", "x"): 1, ("between", "v"): 1, ("refers", "k"): 1}


def test_forbidden_columns(spark):
    with pytest.raises(ValueError):
        marts.check_public(spark.createDataFrame([(1,)], "lrn_clean int"))


def test_files_with_personal_data(spark, tmp_path):
    (tmp_path / "a" / "tests").mkdir(parents=True)
    for name, text in {"a/Student_roster.bin": "x", "a/n.csv": "id 123456789012,", "a/m.txt": "0.123456789012 and me@x.org", "a/k.md": "123456789012", "a/tests/n.csv": "123456789012", "a/z.json": "a1234567890123"}.items():
        (tmp_path / name).write_text(text)
    got = sorted((r.path.split("/")[-1], r.finding) for r in profile.scan_files(spark, str(tmp_path)).collect())
    assert got == [("Student_roster.bin", "file name"), ("m.txt", "e-mail address"), ("n.csv", "number of 12 digits")]
    assert profile.scan_files(spark, str(tmp_path), skip=()).count() == 4


def test_pair_outcomes(spark):
    links = spark.createDataFrame([("b1", "e1", "accepted"), ("b2", "e3", "accepted"), ("b3", "e3", "review")], "baseline_record_id string, endline_record_id string, decision string")
    truth = spark.createDataFrame([("b1", "e1"), ("b3", "e3")], "baseline_record_id string, endline_record_id string")
    assert {tuple(r) for r in scorecards.pair_outcomes(links, truth).collect()} == {("b1", "e1", "tp"), ("b2", "e3", "fp"), ("b3", "e3", "fn")}


def test_settings_files(tmp_path):
    from panelforge import config

    (tmp_path / "s.json").write_text('{"height_cm": [70, 210], "rules": {"DQA_DATE_IMPOSSIBLE": {"severity": "LOW"}}, "headers": {"school_submission": {"sex": ["Seks"]}}, "training": [["lrn_clean"]]}')
    s = config.load_settings(str(tmp_path / "s.json"))
    assert s.height_cm == (70, 210) and s.weight_kg == config.Settings().weight_kg and s.training == (("lrn_clean",),)
    assert {r[0]: r[1] for r in s.rules}["DQA_DATE_IMPOSSIBLE"] == "LOW" and len(s.rules) == len(config.RULES)
    assert s.datasets()[0].headers()["seks"] == "sex" and "seks" not in config.DATASETS[0].headers()
    (tmp_path / "s.toml").write_text('floor = 0.2\naccept = 0.3\nsweep = [0.3, 0.6]\n')
    assert config.load_settings(str(tmp_path / "s.toml")).sweep == (0.3, 0.6)
    assert s.threshold("margin") == 1.0
    with pytest.raises(KeyError):
        s.threshold("margn")
    for text in ('{"hight_cm": 1}', '{"rules": {"NO_RULE": {}}}', '{"rules": {"DQA_DATE_IMPOSSIBLE": {"severity": "BAD"}}}', '{"headers": {"school_submission": {"no_field": []}}}'):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(ValueError):
            config.load_settings(str(tmp_path / "bad.json"))
    for bad in (config.Settings(training=()), config.Settings(accept=0.1, floor=0.2), config.Settings(blocking=(("true",),)), config.Settings(margin=-1)):
        with pytest.raises(ValueError):
            linkage.check_settings(bad)
    assert all(config.action(r[0]) for r in config.RULES)


def test_contracts(spark):
    from panelforge.operators import contracts

    schools = spark.createDataFrame([("S1", "a", 1), ("S1", None, 2)], "school_id string, school_name string, treatment_status long")
    got = {(r.table_name, r.check_name, r.column_name): r.n for r in contracts.check({"schools": schools, "allocations": spark.createDataFrame([("S9",)], "school_id string")}).collect() if r.n}
    assert got == {("schools", "not_null", "school_name"): 1, ("schools", "unique", "school_id"): 1, ("schools", "accepted", "treatment_status"): 1, ("allocations", "exists", "school_year"): 1, ("allocations", "refers", "school_id"): 1}
    m = spark.createDataFrame([("a",), ("b",), ("b",)], "child_record_id string")
    assert {(r.child_record_id, r.n) for r in contracts.reconcile(spark.createDataFrame([("a",), ("b",), ("c",)], "child_record_id string"), m).collect()} == {("b", 2), ("c", 0)}


def test_flows_totals_and_blocks(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "x", 3), ("b", "x", 1)], "f string, t string, v long")
    assert {tuple(r) for r in profile.flows(df, "f", "t", "v").collect()} == {("a", "x", 5), ("b", "x", 1)}
    assert {tuple(r) for r in profile.flows(df, "f", "t").collect()} == {("a", "x", 2), ("b", "x", 1)}
    card = spark.createDataFrame([("r1", 4, 3, 1, 1), ("r2", 0, 0, 0, 2)], "rule_id string, injected long, detected long, missed long, false_positives long")
    assert tuple(scorecards.rule_totals(card).collect()[0]) == (2, 1, 4, 3, 1, 3, 0.75, 0.5)
    b = spark.createDataFrame([(f"b{i}", "2015-01-01") for i in range(3)] + [("b9", None)], "child_record_id string, birthday_str string")
    assert [tuple(r) for r in linkage.block_sizes(b, b, (("birthday_str",),)).collect()] == [(0, "2015-01-01", 9)]


def test_tables_as_folders_and_as_files(spark, tmp_path):
    from panelforge.plans import catalog

    import pyarrow as pa
    import pyarrow.parquet as pq

    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/one")
    spark.createDataFrame([(2, "b")], "x int, y string").write.partitionBy("y").parquet(f"{tmp_path}/bronze_two")
    for name in ("one", "three"):
        pq.write_table(pa.table({"x": pa.array([3], pa.int32())}), tmp_path / f"{name}.parquet")
    found = catalog.load(spark, str(tmp_path), ("one", "two"), ("three", "four"))
    assert set(found) == {"one", "two", "three"}
    assert sorted((r.x, r.y) for r in found["one"].collect()) == [(1, "a"), (3, None)]
    assert [tuple(r) for r in found["two"].collect()] == [(2, "b")]
    with pytest.raises(FileNotFoundError, match="four"):
        catalog.load(spark, str(tmp_path), ("one", "four"))


def test_policy_is_sound():
    from panelforge import config

    assert not config.unmapped_defects() and not config.ambiguous_headers()
    twice = config.Settings(headers={"school_submission": {"sex": ["DOB"]}}).datasets()
    assert config.ambiguous_headers(twice) == ["school_submission: 'dob' for ['birth_date', 'sex']"]


def _two_waves(spark, n=60):
    """Waves with repeated ids, reference numbers, names and dates, and with nulls."""
    rng = random.Random(11)
    rows = {}
    for wave in ("baseline", "endline"):
        some = lambda i: {"period": wave, "child_record_id": None if i == 5 else f"{wave[0]}{i % (n - 3)}", "school_id": f"S{rng.randrange(4)}", "lrn_clean": rng.choice([None, f"{100000000000 + rng.randrange(40)}"]), "student_name_clean": rng.choice([None, "ANA CRUZ", "ANNA CRUZ", "BEN REYES", f"NAME {rng.randrange(9)}"]), "first_letter_name": rng.choice("ABN"), "birthday_str": rng.choice([None, "2015-03-04", "2015-04-03", "2015-03-05", "2016-03-04"]), "sex": rng.choice([None, "Male", "Female"])}  # noqa: B023,E731
        rows[wave] = spark.createDataFrame([child(i, **some(i)) for i in range(n)], CHILD).localCheckpoint()
    return rows["baseline"], rows["endline"]


def test_blocked_pairs_are_told_apart_without_being_gathered(spark):
    from panelforge.config import BLOCKING

    b, e = _two_waves(spark)
    keys = [[[F.expr(x).alias(f"r{i}_{j}") for j, x in enumerate(rule)] for i, rule in enumerate(BLOCKING)] for _ in "be"]
    left, right = (df.select("child_record_id", *[x for rule in k for x in rule]).collect() for df, k in zip((b, e), keys, strict=True))
    want = {}
    for x in left:
        for y in right:
            met = [i for i, rule in enumerate(BLOCKING) if all(x[f"r{i}_{j}"] is not None and x[f"r{i}_{j}"] == y[f"r{i}_{j}"] for j in range(len(rule)))]
            if met:
                k = (x.child_record_id, y.child_record_id)
                want[k] = min(met[0], want.get(k, 9))
    got = linkage.blocked_pairs(b, e).collect()
    assert len(got) == len(want) and {(r.baseline_record_id, r.endline_record_id): r.match_key for r in got} == want
    named = linkage.blocked_pairs(b, e, columns=linkage.FIELDS)
    old = linkage.with_records(linkage.blocked_pairs(b, e), b, e)
    assert sorted(map(str, named.select(*old.columns).collect())) == sorted(map(str, old.collect()))
    once = [df.dropDuplicates(["child_record_id"]) for df in (b, e)]
    plan = linkage.blocked_pairs(*[df.localCheckpoint() for df in once])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # all pairs went through a shuffle before


def test_pairs_that_cannot_reach_a_threshold_are_the_rest(spark):
    from panelforge.plans.queries import FIXED_MODEL

    b, e = (df.filter("child_record_id is not null").dropDuplicates(["child_record_id"]).localCheckpoint() for df in _two_waves(spark))
    every = linkage.probabilistic_candidates(b, e, FIXED_MODEL).localCheckpoint()
    some, rest = (linkage.probabilistic_candidates(b, e, FIXED_MODEL, least=0.1, rest=x).localCheckpoint() for x in (False, True))
    assert sorted(map(str, some.unionByName(rest).collect())) == sorted(map(str, every.collect()))
    assert rest.count() and rest.filter("match_probability >= 0.1").count() == 0 and some.filter("match_probability >= 0.1").count()
    whole, parts = resolver.resolve(every), resolver.resolve(some, unique=True, rest=rest)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.select(*whole.columns).collect()))


def test_only_pairs_above_the_threshold_enter_windows(spark):
    from panelforge.plans.queries import FIXED_MODEL

    b, e = (df.filter("child_record_id is not null").dropDuplicates(["child_record_id"]).localCheckpoint() for df in _two_waves(spark))
    plan = resolver.resolve(linkage.probabilistic_candidates(b, e, FIXED_MODEL), unique=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "rank(" in plan and "rank(" not in plan[plan.rindex("\n+- ") :]  # all pairs did before


def test_one_edit_is_that_of_all_short_texts(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("ab1") for _ in range(rng.randrange(0, 9))) for _ in range(60)]

    def near(x, y):
        if abs(len(x) - len(y)) > 1:
            return False
        cut = [x[:i] + x[i + 1 :] for i in range(len(x))]
        swap = [x[:i] + x[i + 1] + x[i] + x[i + 2 :] for i in range(len(x) - 1)]
        change = [x[:i] + y[i] + x[i + 1 :] for i in range(len(x))] if len(x) == len(y) else []
        return x == y or y in cut or y in swap or y in change or x in [y[:i] + y[i + 1 :] for i in range(len(y))]

    df = spark.createDataFrame([(x, y) for x in words for y in words], "a string, b string")
    got = df.select("a", "b", similarity.one_edit(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.n for r in got] == [near(r.a, r.b) for r in got]


def test_joins_carry_each_column_once_and_only_one_rule_needs_repeated_numbers(spark):
    import re

    from panelforge.plans.queries import FIXED_MODEL

    b, e = (df.filter("child_record_id is not null").dropDuplicates(["child_record_id"]).localCheckpoint() for df in _two_waves(spark))
    plan = linkage.probabilistic_candidates(b, e, FIXED_MODEL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2  # ten before: one for each rule and side
    plan = linkage.blocked_pairs(b, e, columns=linkage.FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join Inner", plan)) == 5 and not re.search(r"(lrn_clean|birthday_str|school_id|sex)#\d+ AS [be]_k\d", plan)


def test_repeated_numbers_are_marked_in_the_join_on_numbers(spark):
    from panelforge.plans.queries import FIXED_MODEL

    b, e = _two_waves(spark)
    once = [df.dropDuplicates(["child_record_id"]).localCheckpoint() for df in (b, e)]  # one row of each wave has no id
    n = [Counter(r.lrn_clean for r in df.collect()) for df in once]
    own = [{r.child_record_id: r.lrn_clean for r in df.collect()} for df in once]
    got = linkage.probabilistic_candidates(*once, FIXED_MODEL).collect()
    shared = [(r, own[0][r.baseline_record_id]) for r in got if own[0][r.baseline_record_id] is not None and own[0][r.baseline_record_id] == own[1][r.endline_record_id]]
    assert {r.ambiguous for r, _ in shared} == {True, False} and all(r.ambiguous == (n[0][x] > 1 or n[1][x] > 1) for r, x in shared)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = linkage.probabilistic_candidates(*once, FIXED_MODEL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 10  # twelve or more before: the records went by their numbers first


def test_score_pairs_reads_waves_that_are_laid_out_and_shuffles_nothing(spark, monkeypatch):
    from panelforge.plans import queries

    monkeypatch.setattr(linkage, "BUCKET_ROWS", 20, raising=False)  # several buckets
    b, e = _two_waves(spark)
    once = [df.dropDuplicates(["child_record_id"]).localCheckpoint() for df in (b, e)]  # a row without an id is left
    for waves in ((b, e), once):  # with repeated ids, and without
        monkeypatch.setattr(queries, "people", lambda *_: waves)  # noqa: B023
        got = queries.score_pairs(spark, "")
        plan = got._jdf.queryExecution().executedPlan().toString()
        want = linkage.probabilistic_candidates(*waves, queries.FIXED_MODEL).select(got.columns).collect()
        assert want and sorted(map(str, got.collect())) == sorted(map(str, want))
    assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan  # ten shuffles were there at once before
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("panelforge_")]


def _competing(spark, seed=12):
    """Candidates in which weights tie, lead by little or by much, each pair once; probabilities follow the weights."""
    rng, rows = random.Random(seed), []
    for g in range(50):
        for b, e in ((i, j) for i in range(4) for j in range(4) if rng.random() < 0.5):
            w = float(rng.choice([-5, -1, 0, 1, 2, 3, 3.5, 6]))
            rows.append((f"c{g}{b}{e}", f"b{g}_{b}", f"e{g}_{e}", "probabilistic", 2**w / (1 + 2**w), w, "S1", rng.choice(["S1", "S1", "S2", None]), rng.random() < 0.1))
    return spark.createDataFrame(rows, "candidate_id string, baseline_record_id string, endline_record_id string, method string, match_probability double, match_weight double, baseline_school_id string, endline_school_id string, ambiguous boolean")


def test_accepted_pairs_are_those_of_the_resolver(spark):
    df = _competing(spark)
    columns = ["baseline_record_id", "endline_record_id", "match_probability", "match_weight", "transferred_flag", "decision"]
    parts = [df.filter(F.abs(F.xxhash64("candidate_id")) % 3 == i) for i in range(3)]
    for accept, margin in ((0.1, 1.0), (0.6, 0.0)):
        want = resolver.resolve(df, accept, accept, margin, unique=True).filter("decision = 'accepted'").select(columns).collect()
        got = resolver.accepted(parts, accept, margin).select(columns).collect()
        assert want and sorted(map(str, got)) == sorted(map(str, want))


def test_what_is_shuffled_for_accepted_pairs_grows_with_the_records(spark):
    n = 120  # all of a wave meet all of the other one, as on a common date
    df = spark.range(n * n).selectExpr("'B' || id div 120 as baseline_record_id", "'E' || id % 120 as endline_record_id", "cast(id % 7 as double) as match_weight", "0.9D as match_probability", "false as ambiguous", "'S' as baseline_school_id", "'S' as endline_school_id")
    assert resolver._best_of_task(df.coalesce(2), 0.1, 1.0).count() <= 2 * 2 * n
    import pandas as pd

    rows = pd.DataFrame([("b", "x", "p", 3.0, None, 0.9, False, False), ("b", "x", "q", 5.0, 4.5, 0.9, False, False), ("b", "y", "r", 5.0, 1.0, 0.9, False, True), ("b", "y", "s", 2.0, None, 0.9, False, False), ("e", "x", "t", 1.0, None, 0.9, True, False)], columns=[c.split()[0] for c in resolver.BEST.split(", ")])
    got = resolver._leading(rows, 1.0).sort_values(["side", "record_id"])
    assert got["partner"].tolist() == [None, "r", "t"] and got["weight"].tolist() == [5.0, 5.0, 1.0] and got["second"].fillna(-9).tolist() == [4.5, 2.0, -9.0]


def test_conflicts_and_outcomes_do_not_put_pairs_into_windows(spark, monkeypatch):
    from panelforge.plans import queries

    def refuse(*_, **__):
        raise AssertionError("all pairs above the threshold went through windows")

    monkeypatch.setattr(resolver, "decide", refuse)
    b, e = (df.filter("child_record_id is not null").dropDuplicates(["child_record_id"]).localCheckpoint() for df in _two_waves(spark))
    monkeypatch.setattr(queries, "people", lambda *_: (b, e))
    assert queries.one_to_one_conflicts(spark, "").count() == 0
    monkeypatch.setattr(queries, "truth_links", lambda *_: spark.createDataFrame([("none", "none")], "baseline_record_id string, endline_record_id string"))
    got = queries.pair_outcomes(spark, "").groupBy("outcome").count().collect()
    assert {r.outcome for r in got} == {"fn", "fp"}


def test_review_queue_without_windows_is_that_of_the_resolver(spark):
    from panelforge.plans.queries import FIXED_MODEL

    b, e = (df.filter("child_record_id is not null").dropDuplicates(["child_record_id"]).localCheckpoint() for df in _two_waves(spark, 40))
    columns = ["baseline_record_id", "endline_record_id", "match_probability", "match_weight", "transferred_flag", "decision"]
    every = linkage.probabilistic_candidates(b, e, FIXED_MODEL).localCheckpoint()
    for accept, floor in ((0.1, 0.1), (0.97, 0.3)):
        want = resolver.review_queue(resolver.resolve(every, accept, floor, 1.0, unique=True)).select(columns).collect()
        got = resolver.reviewed(b, e, lambda x, y: linkage.candidate_parts(x, y, FIXED_MODEL, least=min(accept, floor)), accept, floor, 1.0)  # noqa: B023
        assert {r.decision for r in want} >= {"review"} and sorted(map(str, got.select(columns).collect())) == sorted(map(str, want))
        # the pairs of the free records come from joins on keys, no window or aggregate over pairs: all pairs above went through four before
        assert "rank(" not in got._jdf.queryExecution().optimizedPlan().toString()
