"""Record linkage of two waves: exact passes, blocking, comparison levels, scores.

Candidates always come from equi-joins on blocking keys; the union of rules is a
union of joins, never a join on alternatives. Null keys never meet. Pairs grow with
the square of a block, so they carry what is compared and are never shuffled: only
what can reach a threshold is.
"""

from __future__ import annotations

import json
import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.config import BLOCKING, EXACT_PASSES, NAME_LEVELS, Settings
from panelforge.functions.ids import stable_id
from panelforge.functions.similarity import jaro_winkler, one_edit
from panelforge.functions.text import present, twelve_digits
from panelforge.tables import bucketed, freed_shuffles

FIELDS = ("lrn_clean", "student_name_clean", "birthday_str", "sex", "school_id")
CANDIDATE = ("candidate_id", "baseline_record_id", "endline_record_id", "school_id", "method", "pass_id", "match_probability", "match_weight", "baseline_school_id", "endline_school_id", "ambiguous")


def waves(child_records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return child_records.filter("period = 'baseline'"), child_records.filter("period = 'endline'")


def sides(b: DataFrame, e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both waves with the prefixes b_ and e_."""
    return b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]), e.select(*[F.col(c).alias(f"e_{c}") for c in e.columns])


def exact_candidates(baseline: DataFrame, endline: DataFrame, passes=EXACT_PASSES) -> DataFrame:
    """Pairs that agree on all keys of a pass; ambiguous if an endpoint has another partner in the pass.

    Keys that may be null compare as equal when both are.
    """
    b, e = sides(baseline, endline)
    out = []
    for number, (name, keys, needed) in enumerate(passes):
        eligible = lambda df, x, needed=needed: df.filter(reduce(Column.__and__, [present(F.col(f"{x}_{k}")) for k in needed]))
        same = reduce(Column.__and__, [(F.col(f"b_{k}") == F.col(f"e_{k}")) if k in needed or k == "school_id" else F.col(f"b_{k}").eqNullSafe(F.col(f"e_{k}")) for k in keys])
        met = eligible(b, "b").join(eligible(e, "e"), same).select(F.col("b_child_record_id").alias("baseline_record_id"), F.col("e_child_record_id").alias("endline_record_id"), F.col("b_school_id").alias("baseline_school_id"), F.col("e_school_id").alias("endline_school_id")).distinct()
        by = lambda side: F.count("*").over(Window.partitionBy(f"{side}_record_id"))
        met = met.withColumn("ambiguous", (by("baseline") > 1) | (by("endline") > 1))
        out.append(met.withColumns({"pass_id": F.lit(name), "match_weight": F.lit(float(30 - number)), "match_probability": F.lit(1.0)}))
    df = reduce(DataFrame.unionByName, out).withColumns({"method": F.lit("deterministic"), "school_id": F.col("baseline_school_id")})
    return df.withColumn("candidate_id", stable_id(F.col("method"), F.col("pass_id"), F.col("baseline_record_id"), F.col("endline_record_id"))).select(*CANDIDATE)


PAIR = ("baseline_record_id", "endline_record_id")
#: Whether another record of the wave has this one's reference number; it counts only for pairs that share it.
TWICE = "twice"
#: About so many records of a wave go to a bucket, where the waves are laid out for each rule.
BUCKET_ROWS = 8192


def _keyed(df: DataFrame, rule: tuple[str, ...]) -> DataFrame:
    exprs = [F.expr(x) for x in rule]
    return df.filter(reduce(Column.__and__, [x.isNotNull() for x in exprs])).select("child_record_id", *[x.alias(f"k{i}") for i, x in enumerate(exprs)])


def _met(baseline: DataFrame, endline: DataFrame, rules, columns=(), buckets=0) -> list[DataFrame]:
    """For each rule, the pairs of rows that agree on it and on none before, with its number and the columns of both rows.

    The join on a rule's keys leaves out what agrees on an earlier rule, so no pair has to be gathered. With buckets, the
    waves are laid out in so many for each rule, one after the other, and the joins shuffle nothing.
    """
    late = TWICE in columns and TWICE not in baseline.columns  # the marks are made where records are together by their numbers
    columns = tuple(c for c in columns if c != TWICE or not late)
    keys = list(dict.fromkeys(x for rule in rules for x in rule))
    own = {x for x in keys if x in baseline.columns and x in endline.columns}  # a key that is a column goes along once, as that
    name = {x: f"_{x}" if x in own else f"_k{i}" for i, x in enumerate(keys)}
    both = list(dict.fromkeys((*columns, *(x for x in keys if x in own))))
    side = lambda df, x, record: df.select(F.col("child_record_id").alias(record), *[F.expr(k).alias(f"{x}{name[k]}") for k in keys if k not in own], *[F.col(c).alias(f"{x}_{c}") for c in both])
    b, e = side(baseline, "b", PAIR[0]), side(endline, "e", PAIR[1])
    agree = lambda rule: reduce(Column.__and__, [F.col(f"b{name[k]}") == F.col(f"e{name[k]}") for k in rule])
    known = lambda df, x, rule: df.filter(reduce(Column.__and__, [F.col(f"{x}{name[k]}").isNotNull() for k in rule]))
    # pairs of an equal reference number have all been met by its own rule; later ones need no marks of repeated numbers
    told = list(rules).index(("lrn_clean",)) if ("lrn_clean",) in rules else len(rules)
    marked = lambda df, x: df.withColumn(f"{x}_{TWICE}", F.coalesce(twelve_digits(F.col(f"{x}_lrn_clean")), F.lit(False)) & (F.count("*").over(Window.partitionBy(f"{x}_lrn_clean")) > 1))
    sides_ = [(b, "b", PAIR[0]), (e, "e", PAIR[1])]
    found = []
    for number, rule in enumerate(rules):
        out = lambda x, c, number=number: F.lit(False).alias(f"{x}_{c}") if c == TWICE and number > told else F.col(f"{x}_{c}")
        on = reduce(Column.__and__, [~F.coalesce(agree(r), F.lit(False)) for r in rules[:number]], agree(rule))
        mark = late and number == told
        dealt = lambda df, x, rule=rule: df.repartition(buckets, *[f"{x}{name[k]}" for k in rule]) if buckets else df
        ready = lambda df, x, record, rule=rule, mark=mark: (marked(dealt(known(df, x, rule), x), x) if mark else dealt(known(df, x, rule), x)).filter(F.col(record).isNotNull() if late else F.lit(True))
        left, right = [ready(*side) for side in sides_]
        if buckets:
            kept = [*(f"_{c}" for c in columns if c != TWICE or number <= told), *(name[k] for r in rules[: number + 1] for k in r), *([f"_{TWICE}"] if mark else [])]
            left, right = [bucketed(df.select(record, *dict.fromkeys(f"{x}{c}" for c in kept)), buckets, [f"{x}{name[k]}" for k in rule], (record,)) for df, (_, x, record) in zip((left, right), sides_, strict=True)]
            left = left.hint("merge")  # the size of compressed files says too little about the rows to broadcast them
        marks = [F.col(f"{x}_{TWICE}") if mark else F.lit(False).alias(f"{x}_{TWICE}") for x in "be"] if late else []
        found.append(left.join(right, on).select(*PAIR, F.lit(number).alias("match_key"), *[out(x, c) for x in "be" for c in columns], *marks))
    return found


def _repeated(*waves_: DataFrame) -> bool:
    """Whether a wave has a record id twice; a job."""
    again = [df.groupBy("child_record_id").agg(F.count("*").alias("n")).filter("n > 1").select("n") for df in waves_]
    with freed_shuffles(waves_[0].sparkSession):
        return not reduce(DataFrame.unionByName, again).isEmpty()


def blocked_pairs(baseline: DataFrame, endline: DataFrame, rules=BLOCKING, columns=None, laid_out: bool = False) -> DataFrame:
    """Pairs of record ids that agree on a blocking rule, once each, with the first such rule's number.

    With columns, also both records' columns as with_records() has them. Only pairs of ids that a wave
    has several times are gathered. laid_out: the records are written for each rule as compressed tables, by jobs,
    and not shuffled for all rules at once when the pairs are read, which takes more disk.
    """
    return reduce(DataFrame.unionByName, _blocked_parts(baseline, endline, rules, columns, laid_out))


def _blocked_parts(baseline: DataFrame, endline: DataFrame, rules=BLOCKING, columns=None, laid_out: bool = False) -> list[DataFrame]:
    """blocked_pairs() in parts that have no pair in common; with unique ids, one for each rule."""
    buckets = 1 + max(baseline.count(), endline.count()) // BUCKET_ROWS if laid_out else 0
    some = [df.filter("child_record_id is not null") if columns is not None else df for df in (baseline, endline)]
    several = _repeated(*some)
    if TWICE in (columns or ()) and (several or list(rules)[0] != ("lrn_clean",)):
        some = [_shared_numbers(df).filter("child_record_id is not null") for df in (baseline, endline)]
    elif TWICE in (columns or ()):
        some = [baseline, endline]  # records without an id count where a number is repeated, and are left out after that
    baseline, endline = some
    if not several:
        return _met(baseline, endline, rules, columns or (), buckets)
    n = F.count("*").over(Window.partitionBy("child_record_id"))
    (b, bs), (e, es) = ([df.withColumn("_n", n).filter(x).drop("_n") for x in ("_n = 1", "_n > 1")] for df in (baseline, endline))
    several = reduce(DataFrame.unionByName, [*_met(bs, endline, rules), *_met(b, es, rules)]).groupBy(*PAIR).agg(F.min("match_key").alias("match_key"))
    if columns is not None:
        several = with_records(several, baseline, endline, columns)
    return [*_met(b, e, rules, columns or (), buckets), several]


def with_records(pairs: DataFrame, baseline: DataFrame, endline: DataFrame, columns=FIELDS) -> DataFrame:
    b = baseline.select(F.col("child_record_id").alias("baseline_record_id"), *[F.col(c).alias(f"b_{c}") for c in columns])
    e = endline.select(F.col("child_record_id").alias("endline_record_id"), *[F.col(c).alias(f"e_{c}") for c in columns])
    return pairs.join(b, "baseline_record_id").join(e, "endline_record_id")


def levels(pairs: DataFrame) -> DataFrame:
    """pairs with a level per field: -1 null, 0 disagreement, more for more agreement.

    Names are compared a batch at a time, once per distinct pair in the batch.
    """
    df = pairs.withColumn("_jw", jaro_winkler("b_student_name_clean", "e_student_name_clean"))
    name = F.when(_null("student_name_clean"), -1).when(_same("student_name_clean"), len(NAME_LEVELS) + 1)
    for i, cut in enumerate(NAME_LEVELS):
        name = name.when(F.col("_jw") >= cut, len(NAME_LEVELS) - i)
    return df.withColumns(_plain_levels() | {"g_student_name_clean": name.otherwise(0)}).drop("_jw")


def _null(c: str) -> Column:
    return F.col(f"b_{c}").isNull() | F.col(f"e_{c}").isNull()


def _same(c: str) -> Column:
    return F.col(f"b_{c}") == F.col(f"e_{c}")


def _plain_levels(of=lambda g, level: level) -> dict[str, Column]:
    """The levels of all fields but the name, which Spark's own functions give, or what stands for each."""
    b, e = F.col("b_birthday_str"), F.col("e_birthday_str")
    apart = F.abs(F.datediff(b.try_cast("date"), e.try_cast("date")))
    day = lambda level: of("g_birthday_str", level)
    born = F.when(_null("birthday_str"), day(-1)).when(b == e, day(4)).when(one_edit(b, e), day(3)).when(apart <= 30, day(2)).when(apart <= 365, day(1)).otherwise(day(0))
    exact = lambda c: F.when(_null(c), of(f"g_{c}", -1)).when(_same(c), of(f"g_{c}", 1)).otherwise(of(f"g_{c}", 0))
    return {"g_lrn_clean": exact("lrn_clean"), "g_birthday_str": born, "g_sex": exact("sex"), "g_school_id": exact("school_id")}


GAMMAS = tuple(f"g_{c}" for c in FIELDS)
#: Levels of each field besides null.
HEIGHTS = {"g_lrn_clean": 2, "g_student_name_clean": len(NAME_LEVELS) + 2, "g_birthday_str": 5, "g_sex": 2, "g_school_id": 2}


def pattern_counts(leveled: DataFrame) -> DataFrame:
    """Number of pairs of each combination of levels: at most a few thousand rows."""
    return leveled.groupBy(*GAMMAS).agg(F.count("*").alias("n"))


def prior(n_baseline: int, n_endline: int) -> float:
    return min(0.1, max(0.001, 1 / max(n_baseline, n_endline, 1)))


def _shares(rows: list, weights: np.ndarray, gamma: str) -> np.ndarray:
    total = np.zeros(HEIGHTS[gamma])
    for r, w in zip(rows, weights, strict=True):
        if r[gamma] >= 0:
            total[r[gamma]] += w
    return (total + 1e-6) / (total + 1e-6).sum()


def random_pairs(baseline: DataFrame, endline: DataFrame, most: int, seed: int) -> DataFrame:
    """At most about so many pairs of a record each of two samples drawn by hash; the samples are sqrt(most) rows at most."""
    side = max(1, math.isqrt(most))
    drawn = lambda df, s: df.orderBy(F.xxhash64("child_record_id", F.lit(s)), "child_record_id").limit(side).select("child_record_id")
    b = drawn(baseline, seed).withColumnRenamed("child_record_id", "baseline_record_id")
    e = drawn(endline, seed + 1).withColumnRenamed("child_record_id", "endline_record_id")
    return b.join(F.broadcast(e))  # the samples' sizes are fixed


def estimate(u_rows: list, sessions: list[tuple[tuple[str, ...], list]], start: float, rounds: int = 200, tolerance: float = 1e-6) -> dict:
    """Fellegi-Sunter parameters from pattern counts.

    u comes from random pairs. m comes from expectation maximisation in a session
    per training rule, in which the rule's own fields are held out, and is
    averaged over the sessions.
    """
    u = {g: _shares(u_rows, np.array([r["n"] for r in u_rows], dtype=float), g).tolist() for g in GAMMAS}
    learned: dict[str, list[np.ndarray]] = {g: [] for g in GAMMAS}
    for used, rows in sessions:
        free = [g for g in GAMMAS if g[2:] not in used]
        n = np.array([r["n"] for r in rows], dtype=float)
        if not len(n):
            continue
        m = {g: np.linspace(1, HEIGHTS[g] * 3, HEIGHTS[g]) / np.linspace(1, HEIGHTS[g] * 3, HEIGHTS[g]).sum() for g in free}
        share = 0.5
        for _ in range(rounds):
            like_m, like_u = np.full(len(n), share), np.full(len(n), 1 - share)
            for g in free:
                k = np.array([r[g] for r in rows])
                like_m *= np.where(k >= 0, m[g][np.maximum(k, 0)], 1)
                like_u *= np.where(k >= 0, np.array(u[g])[np.maximum(k, 0)], 1)
            p = like_m / (like_m + like_u)
            new = {g: _shares(rows, n * p, g) for g in free}
            moved = max(float(np.abs(new[g] - m[g]).max()) for g in free)
            m, share = new, float(np.clip((n * p).sum() / n.sum(), 1e-6, 1 - 1e-6))
            if moved < tolerance:
                break
        for g in free:
            learned[g].append(m[g])
    m = {g: (np.mean(v, axis=0) if v else np.linspace(1, 9, HEIGHTS[g]) / np.linspace(1, 9, HEIGHTS[g]).sum()).tolist() for g, v in learned.items()}
    return {"prior": start, "m": m, "u": u}


def check_settings(s: Settings) -> None:
    """Settings that linkage can't work with fail before any job."""
    if not s.training or not s.blocking:
        raise ValueError("at least one training rule and one blocking rule are needed")
    if not 0 <= s.floor <= s.accept <= 1:
        raise ValueError("thresholds must be 0 <= floor <= accept <= 1")
    if s.margin < 0 or s.sample_pairs < 1:
        raise ValueError("the margin can't be negative and sample_pairs must be positive")
    if any(x.strip().lower() in ("", "1=1", "true") for rule in (*s.training, *s.blocking) for x in rule):
        raise ValueError("a rule without a key would pair everything")


def train(baseline: DataFrame, endline: DataFrame, settings: Settings | None = None, training=None) -> dict:
    """The model: only pattern counts come to the driver."""
    s = settings or Settings()
    training = s.training if training is None else training
    check_settings(s)
    nb, ne = baseline.count(), endline.count()
    if not nb or not ne:
        raise ValueError("both waves need records")
    if not training:
        raise ValueError("at least one training rule is needed")
    counted = lambda pairs: pattern_counts(levels(pairs)).collect()
    u_rows = counted(with_records(random_pairs(baseline, endline, s.sample_pairs, s.seed), baseline, endline))
    sessions = [(rule, counted(blocked_pairs(baseline, endline, (rule,), FIELDS))) for rule in training]
    return estimate(u_rows, sessions, prior(nb, ne))


def save(spark: SparkSession, model: dict, path: str) -> None:
    """The model as one line of JSON, in any file system that Spark writes to."""
    spark.createDataFrame([(json.dumps(model, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> dict:
    model = json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))
    if set(model) != {"prior", "m", "u"} or any(len(model[x].get(g, ())) != HEIGHTS[g] for x in "mu" for g in GAMMAS):
        raise ValueError(f"{path} holds no model of these levels")
    return model


def weights(model: dict) -> dict[str, list[float]]:
    """log2(m / u) of each level."""
    return {g: [math.log2(max(m, 1e-12) / max(u, 1e-12)) for m, u in zip(model["m"][g], model["u"][g], strict=True)] for g in GAMMAS}


def _weight(model: dict, part) -> Column:
    p = model["prior"]
    return reduce(Column.__add__, [part(g, values) for g, values in weights(model).items()], F.lit(math.log2(p / (1 - p))))


def _probability(weight: Column) -> Column:
    odds = F.pow(F.lit(2.0), F.least(weight, F.lit(1000.0)))
    return odds / (1 + odds)


def scored(leveled: DataFrame, model: dict) -> DataFrame:
    """match_weight and match_probability of leveled pairs, from literal weights."""
    of = lambda g, values: F.when(F.col(g) >= 0, F.get(F.array(*[F.lit(x) for x in values]), F.col(g))).otherwise(0.0)
    df = leveled.withColumn("match_weight", _weight(model, of)).withColumn("match_probability", _probability(F.col("match_weight")))
    if any(math.isnan(x) for values in weights(model).values() for x in (model["prior"], *values)):
        df = df.filter(~F.isnan("match_weight"))
    return df


def _can_reach(model: dict, least: float) -> Column:
    """Whether a pair can have this probability, whatever the similarity of its names; a pair that has it always can.

    Weights are compared, which takes each field once; they are let through from a little below.
    """
    name, values = "g_student_name_clean", weights(model)
    plain = _plain_levels(lambda g, level: float(values[g][level]) if level >= 0 else 0.0)
    bound = F.when(_null(name[2:]), 0.0).when(_same(name[2:]), values[name][-1]).otherwise(max(values[name][:-1]))
    most = _weight(model, lambda g, _: bound if g == name else plain[g])
    if least <= 0:
        return F.lit(True)
    return most >= (math.log2(least / (1 - least)) if least < 0.999 else 9.0) - 1e-6


def block_sizes(baseline: DataFrame, endline: DataFrame, rules=BLOCKING) -> DataFrame:
    """rule, key and pairs of each block that two waves share, largest first: what blocking will cost, before it is done."""
    found = []
    for number, rule in enumerate(rules):
        keys = [f"k{i}" for i in range(len(rule))]
        n = lambda df, c: _keyed(df, rule).groupBy(*keys).agg(F.count("*").alias(c))  # noqa: B023,E731
        both = n(baseline, "n_b").join(n(endline, "n_e"), keys)
        found.append(both.select(F.lit(number).alias("rule"), F.concat_ws("|", *keys).alias("key"), (F.col("n_b") * F.col("n_e")).alias("pairs")))
    return reduce(DataFrame.unionByName, found).orderBy(F.desc("pairs"), "rule", "key")


def _shared_numbers(df: DataFrame) -> DataFrame:
    """df with twice: whether another record of the wave has its reference number."""
    known = F.coalesce(twelve_digits(F.col("lrn_clean")), F.lit(False))
    key = F.when(known, F.col("lrn_clean")).otherwise(F.concat(F.lit("R"), "child_record_id"))  # null numbers don't meet in a window
    return df.withColumn(TWICE, known & (F.count("*").over(Window.partitionBy(key)) > 1))


def probabilistic_candidates(baseline: DataFrame, endline: DataFrame, model: dict, rules=BLOCKING, least: float | None = None, rest: bool = False, carried=(), laid_out: bool = False) -> DataFrame:
    """All blocked pairs with their scores; ambiguous where the shared reference number isn't unique in its wave.

    least: only pairs that can have this probability at least, by a bound without their names; with rest, only the
    others. Both together are all pairs. carried: columns of baseline that the pairs keep. laid_out: as in blocked_pairs().
    """
    for c in carried:
        endline = endline.withColumn(c, F.lit(None).cast(baseline.schema[c].dataType))
    pairs = blocked_pairs(baseline, endline, rules, (*FIELDS, TWICE, *carried), laid_out)
    return _candidates(pairs, model, least, rest, carried)


def candidate_parts(baseline: DataFrame, endline: DataFrame, model: dict, rules=BLOCKING, least: float | None = None) -> list[DataFrame]:
    """probabilistic_candidates() in parts that have no pair in common, one for each rule or a few more."""
    return [_candidates(pairs, model, least) for pairs in _blocked_parts(baseline, endline, rules, (*FIELDS, TWICE))]


def _candidates(pairs: DataFrame, model: dict, least: float | None = None, rest: bool = False, carried=()) -> DataFrame:
    if least is not None:
        enough = _can_reach(model, least)
        pairs = pairs.filter(~enough if rest else enough)
    df = scored(levels(pairs), model)
    shared = (F.col("g_lrn_clean") == 1) & (F.col("b_twice") | F.col("e_twice"))
    df = df.withColumns({"ambiguous": shared, "method": F.lit("probabilistic"), "pass_id": F.concat(F.lit("rule_"), F.col("match_key")), "baseline_school_id": F.col("b_school_id"), "endline_school_id": F.col("e_school_id"), "school_id": F.col("b_school_id")})
    return df.withColumn("candidate_id", stable_id(F.col("method"), *[F.col(c) for c in PAIR])).select(*CANDIDATE, *[F.col(f"b_{c}").alias(c) for c in carried])
