"""Pairs of blocks that are compared as arrays, against the pairs that Spark joins one by one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.functions.similarity import jaro_winkler_texts
from panelforge.operators import blocks, linkage, resolver, scorecards
from panelforge.plans import queries
from tests.test_operators import _two_waves

MODEL = queries.FIXED_MODEL


def rows(df, columns=None):
    return sorted(map(str, df.select(columns or df.columns).collect()))


@pytest.fixture(scope="module")
def once(spark):
    """Unique ids, and in each wave a row without one, which counts where numbers are repeated."""
    return tuple(df.dropDuplicates(["child_record_id"]).localCheckpoint() for df in _two_waves(spark))


@pytest.fixture(scope="module")
def every(spark, once):
    return linkage.probabilistic_candidates(*once, MODEL).localCheckpoint()


def old_levels(once):
    return linkage.levels(linkage.blocked_pairs(*once, columns=linkage.FIELDS))


def old_sweep(every, once, truth):
    return scorecards.link_scorecard(every.unionByName(linkage.exact_candidates(*once)), truth, truth.count(), unique=True)


def old_mart(every):
    n = every.groupBy("baseline_record_id").agg(F.count("*").alias("candidate_count"))
    return resolver.resolve(every, unique=True).join(n, "baseline_record_id")


OLD = {
    "pattern_counts": lambda every, once, truth: linkage.pattern_counts(old_levels(once)),
    "comparison_levels": lambda every, once, truth: old_levels(once),
    "score_pairs": lambda every, once, truth: every,
    "pair_outcomes": lambda every, once, truth: scorecards.pair_outcomes(resolver.resolve(every, unique=True), truth),
    "one_to_one_conflicts": lambda every, once, truth: resolver.conflicts(resolver.resolve(every, unique=True)),
    "review_queue": lambda every, once, truth: resolver.review_queue(resolver.resolve(every, unique=True)),
    "resolve_one_to_one": lambda every, once, truth: resolver.resolve(every, unique=True),
    "linkage_scorecard_sweep": lambda every, once, truth: old_sweep(every, once, truth),
    "review_mart": lambda every, once, truth: old_mart(every),
}


@pytest.mark.parametrize("name", OLD)
def test_pairs_are_compared_in_blocks(spark, monkeypatch, once, every, name):
    truth = every.filter("match_probability > 0.5").select("baseline_record_id", "endline_record_id", (F.col("match_weight") > 2).alias("is_transfer")).localCheckpoint()
    want = OLD[name](every, once, truth).localCheckpoint()

    def refuse(*_):
        raise AssertionError("pairs were compared one by one")

    monkeypatch.setattr(linkage, "levels", refuse)
    monkeypatch.setattr(blocks, "CHUNK", 7)  # several rows of a block
    monkeypatch.setattr(blocks, "UNIT", 64)
    monkeypatch.setattr(queries, "people", lambda *_: once)
    monkeypatch.setattr(queries, "truth_links", lambda *_: truth)
    got = queries.QUERIES[name](spark, "")
    assert rows(got) == rows(want, got.columns) and (got.count() or name == "one_to_one_conflicts")


def test_review_with_a_floor_below_the_threshold(spark, once, every):
    columns = ["baseline_record_id", "endline_record_id", "match_probability", "match_weight", "transferred_flag", "decision"]
    want = resolver.resolve(every, 0.97, 0.3, 1.0, unique=True)
    assert rows(blocks.reviewed(*once, MODEL, 0.97, 0.3), columns) == rows(resolver.review_queue(want), columns)
    decided = blocks.resolved(*once, MODEL, 0.97, 0.3)
    assert rows(decided) == rows(want, decided.columns)


def test_levels_of_names_are_those_of_their_similarity():
    rng = random.Random(3)
    for letters, front, longest in (("ab", "", 6), ("CUSTOMER#0123", "", 30), ("CUSTOMER#0123", "ACUST", 14), (" ñéx漢", "", 20), ("abc", "xy", 70)):
        texts = list({front + "".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(24)})
        left, right = (x.ravel() for x in np.meshgrid(range(len(texts)), range(len(texts))))
        left, right = left[left != right], right[left != right]
        want = [sum(float(jaro_winkler_texts([texts[i]], [texts[j]])[0]) >= cut for cut in blocks.NAME_LEVELS) for i, j in zip(left, right, strict=True)]
        assert blocks.name_levels(texts, left, right).tolist() == want


def test_edits_of_packed_and_other_texts():
    rng = random.Random(4)
    for letters in ("abc", "abcdefghijklmnopqrs"):
        texts = list({"".join(rng.choice(letters) for _ in range(rng.randrange(9))) for _ in range(60)} | {"ab", "ba", "abc", "acb"})
        dates = blocks._Dates(texts)
        left, right = (x.ravel() for x in np.meshgrid(range(len(texts)), range(len(texts))))
        edits = lambda x: {x[:i] + c + x[i + k :] for i in range(len(x) + 1) for k in (0, 1) for c in ("", *letters)} | {x[:i] + x[i : i + 2][::-1] + x[i + 2 :] for i in range(len(x))}  # noqa: B023,E731
        one = [edits(x) for x in texts]
        assert dates.packed == (len(letters) < 16) and dates.near(left, right).tolist() == [texts[j] in one[i] for i, j in zip(left, right, strict=True)]
