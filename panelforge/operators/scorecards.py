"""Scorecards against the answer key. Only this module and plans.score read the truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.config import RULES, Settings
from panelforge.functions.measures import ratio
from panelforge.operators.resolver import PAIR, collapse, decide, exact_policy


def rule_scorecard(defects: DataFrame, issues: DataFrame, rules=RULES) -> DataFrame:
    """Injected, detected and missed defects and extra findings of each rule.

    defects: defect_type, record_id, source_file_id, school_id, period. A defect is
    found if its key was raised: the record or else the file; for rules of a school
    and wave, these two.
    """
    spark = issues.sparkSession
    policy = spark.createDataFrame([(r, s, d) for r, _, s, ds in rules for d in (ds or (None,))], "rule_id string, scope string, defect_type string")
    key = F.when(F.col("scope") == "school_period", F.concat_ws("|", "school_id", "period")).otherwise(F.coalesce("record_id", "source_file_id"))
    raised = issues.withColumn("key", key).filter("key is not null").select("rule_id", "key").distinct()
    expected = defects.join(F.broadcast(policy.filter("defect_type is not null")), "defect_type").withColumn("key", key).select("rule_id", "key")
    hit = expected.join(raised.withColumn("hit", F.lit(1)), ["rule_id", "key"], "left").groupBy("rule_id").agg(F.count("*").alias("injected"), F.count("hit").alias("detected"))
    extra = raised.join(expected.distinct(), ["rule_id", "key"], "left_anti").groupBy("rule_id").agg(F.count("*").alias("false_positives"))
    df = policy.select("rule_id").distinct().join(hit, "rule_id", "left").join(extra, "rule_id", "left").na.fill(0)
    return df.withColumn("missed", F.col("injected") - F.col("detected")).withColumn("sensitivity", ratio(F.col("detected"), F.col("injected"))).withColumn("precision", ratio(F.col("detected"), F.col("detected") + F.col("false_positives")))


def rule_totals(card: DataFrame) -> DataFrame:
    """One row: the sums of a rule scorecard and the ratios of the sums."""
    names = ("injected", "detected", "missed", "false_positives")
    one = card.agg(F.count("*").alias("rules"), F.count_if(F.col("injected") > 0).alias("rules_with_defects"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    return one.withColumn("sensitivity", ratio(F.col("detected"), F.col("injected"))).withColumn("precision", ratio(F.col("detected"), F.col("detected") + F.col("false_positives")))


def pair_outcomes(links: DataFrame, truth_links: DataFrame) -> DataFrame:
    """Each pair that was accepted or is true, as tp, fp or fn."""
    got = links.filter("decision = 'accepted'").select(*PAIR).distinct().withColumn("_got", F.lit(True))
    true = truth_links.select(*PAIR).distinct().withColumn("_true", F.lit(True))
    kind = F.when(F.col("_got").isNull(), "fn").when(F.col("_true").isNull(), "fp").otherwise("tp")
    return got.join(true, list(PAIR), "full").select(*PAIR, kind.alias("outcome"))


def _probable(candidates: DataFrame, sweep: DataFrame, s: Settings, unique: bool) -> DataFrame:
    """Probabilistic pairs with a decision for each threshold; rejected ones may be left out."""
    # only pairs from a threshold on compete; those between the floor and it are for review whatever the others do
    p, floor = F.col("match_probability"), F.least(F.col("threshold"), F.lit(s.floor))
    best = candidates.filter("method = 'probabilistic'").filter(p >= min(*s.sweep, s.floor))  # a pair's best candidate is the most probable
    best = best if unique else collapse(best)
    swept = best.join(F.broadcast(sweep), p >= floor)
    above = (p >= F.col("threshold")) & ~F.isnan(p)
    probable = decide(swept.filter(above), F.col("threshold"), floor, s.margin, keys=("threshold",))
    below = swept.filter(~above).withColumn("decision", F.lit("review"))
    return probable.select(*best.columns, "threshold", "decision").unionByName(below)


def link_scorecard(candidates: DataFrame, truth_links: DataFrame, n_children: int, settings: Settings | None = None, unique: bool = False, swept: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Precision, recall and the rest by method and threshold, all thresholds in one job.

    truth_links: baseline_record_id, endline_record_id, is_transfer. unique: no pair has several probabilistic candidates.
    swept: the accepted probabilistic pairs and the numbers for review as blocks.swept() has them; candidates are then exact ones.
    """
    s = settings or Settings()
    spark = candidates.sparkSession
    sweep = spark.createDataFrame([(t,) for t in s.sweep], "threshold double")
    probable = _probable(candidates, sweep, s, unique) if swept is None else swept[0].withColumn("decision", F.lit("accepted"))
    exact = exact_policy(candidates.filter("method = 'deterministic'"), sweep)
    columns = ["threshold", *PAIR, "decision"]
    both = probable.filter("decision <> 'rejected'").select(F.lit("probabilistic").alias("method"), *columns).unionByName(exact.select(F.lit("deterministic").alias("method"), *columns))
    marked = both.join(truth_links.select(*PAIR, "is_transfer", F.lit(1).alias("known")), list(PAIR), "left")
    ok = "decision = 'accepted'"
    got = marked.groupBy("method", "threshold").agg(
        F.count_if(F.expr(f"{ok} and known = 1")).alias("tp"),
        F.count_if(F.expr(f"{ok} and known is null")).alias("fp"),
        F.count_if(F.expr("decision = 'review'")).alias("review_queue"),
        F.countDistinct(F.when(F.expr(ok), F.col(PAIR[0]))).alias("matched"),
        F.count_if(F.expr(f"{ok} and is_transfer")).alias("transfers_found"),
    )
    if swept is not None:
        more = swept[1].select(F.lit("probabilistic").alias("method"), "threshold", "review")
        got = got.join(more, ["method", "threshold"], "full").withColumn("review_queue", F.coalesce("review_queue", F.lit(0)) + F.coalesce("review", F.lit(0))).drop("review")
    truth = truth_links.agg(F.count("*").alias("links"), F.count_if("is_transfer").alias("transfers"))
    grid = sweep.join(spark.createDataFrame([("deterministic",), ("probabilistic",)], "method string")).join(F.broadcast(truth))
    df = grid.join(got, ["method", "threshold"], "left").na.fill(0)
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("links"))
    return df.select(
        "method", "threshold", "tp", "fp", (F.col("links") - F.col("tp")).alias("fn"), precision.alias("precision"), recall.alias("recall"),
        ratio(2 * precision * recall, precision + recall).alias("f1"), ratio(F.col("matched"), F.lit(n_children)).alias("match_rate"), "review_queue",
        ratio(F.col("transfers_found"), F.col("transfers")).alias("transfer_recall"),
    )
