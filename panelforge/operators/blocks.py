"""Pairs of the blocks of two waves, compared as arrays.

A wave is laid in rows of up to CHUNK records of a block. Rows of both waves meet in an equi-join on the
block's keys, so what Spark moves grows with the records; a worker makes the pairs of two rows, leaves out
those that agree on an earlier rule, and compares them many at a time. What is counted or kept per record
never leaves it as pairs.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.config import BLOCKING, NAME_LEVELS
from panelforge.functions.similarity import jaro_winkler_texts
from panelforge.functions.text import twelve_digits
from panelforge.operators import linkage, resolver
from panelforge.tables import bucketed, stored

FIELDS = linkage.FIELDS
#: Records of a block in a row, and about so many pairs that are compared at a time.
CHUNK, UNIT = 1024, 1 << 16
#: About so many records of a wave go to a task.
BUCKET_ROWS = 16384
#: Pairs of texts at a time: their arrays stay near the processor.
STEP = 1 << 13
#: Texts with more entries than this in their table of letters are compared without one.
TABLE = 1 << 22
#: Levels of each field and null, in the order of a pattern's digits.
SIZES = tuple(n + 1 for n in linkage.HEIGHTS.values())
PATTERNS = math.prod(SIZES)
ONE = np.uint64(1)


# Comparison of texts


def _level(jaro: np.ndarray, first: np.ndarray | int) -> np.ndarray:
    """Levels of unequal names: 0, or more for more agreement."""
    raised = np.where(jaro > 0.7, jaro + first * 0.1 * (1 - jaro), jaro)
    out = np.zeros(len(raised), dtype=np.int8)
    for cut in NAME_LEVELS:
        out += raised >= cut
    return out


def _window(i: int, reach: int) -> int:
    return ((1 << min(64, i + reach + 1)) - 1) & ~((1 << max(0, i - reach)) - 1)


def name_levels(texts: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Levels of pairs of unequal texts, given by their places among texts: those of jaro_winkler_texts() by its cuts.

    The letters of a text are bits, so a pair takes a step for each letter of its left text behind what all texts begin with.
    """
    size = np.array([len(x) for x in texts], dtype=np.int64)
    width = int(size.max(initial=1))
    if not len(left):
        return np.zeros(0, dtype=np.int8)
    if width > 64:
        out, short = np.zeros(len(left), dtype=np.int8), (size[left] <= 64) & (size[right] <= 64)
        for i in np.flatnonzero(~short):
            out[i] = _level_of([texts[left[i]]], [texts[right[i]]])[0]
        some = np.flatnonzero(size <= 64)
        place = np.cumsum(size <= 64) - 1
        out[short] = name_levels([texts[i] for i in some], place[left[short]], place[right[short]])
        return out
    points = np.array(texts, dtype=f"<U{max(width, 1)}").view(np.uint32).reshape(len(texts), -1)
    alphabet, letter = np.unique(points, return_inverse=True)
    letter, kinds = letter.reshape(points.shape), len(alphabet)
    if kinds * len(texts) > TABLE:
        return np.concatenate([_level_of([texts[i] for i in left[at : at + 4096]], [texts[i] for i in right[at : at + 4096]]) for at in range(0, len(left), 4096)])
    table = np.zeros((len(texts), kinds), dtype=np.uint64)
    for i in range(width):
        has = np.flatnonzero(size > i)
        table[has, letter[has, i]] |= ONE << np.uint64(i)
    # letters in front that all texts share are paired with each other
    shared = len(os.path.commonprefix([min(texts), max(texts)]))
    same = lambda i, j: 4 if shared >= 4 else ((points[i, :4] == points[j, :4]) & (np.arange(min(4, width)) < np.minimum(size[i], size[j])[:, None])).cumprod(axis=1).sum(axis=1)
    known = (table.ravel(), kinds, np.ascontiguousarray(letter.T), size, shared, same)
    return np.concatenate([_bit_levels(left[at : at + STEP], right[at : at + STEP], *known) for at in range(0, len(left), STEP)])


def _bit_levels(left: np.ndarray, right: np.ndarray, table: np.ndarray, kinds: int, letter: np.ndarray, size: np.ndarray, shared: int, same: Callable) -> np.ndarray:
    base, n_left, n_right = right * kinds, size[left], size[right]
    reach = np.maximum(np.maximum(n_left, n_right) // 2 - 1, 0)
    least, most = int(n_left.min()), int(n_left.max())
    same_reach = bool((reach == reach[0]).all())
    paired = np.full(len(left), (1 << shared) - 1, dtype=np.uint64)
    used = paired.copy()
    for i in range(shared, most):
        x = table[base + letter[i][left]]
        x &= np.uint64(_window(i, int(reach[0]))) if same_reach else np.array([_window(i, r) for r in range(32)], dtype=np.uint64)[reach]
        if i >= least:
            x[n_left <= i] = 0
        x &= ~used
        x &= ~x + ONE
        used |= x
        paired |= (x != 0).astype(np.uint64) << np.uint64(i)
    m = np.bitwise_count(used).astype(np.int64)
    first = same(left, right)

    def levels(at, swapped):
        k = m[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(k > 0, (k / n_left[at] + k / n_right[at] + (k - swapped) / k) / 3, 0.0)
        return _level(jaro, first if shared >= 4 else first[at])

    every = slice(None)
    out = levels(every, 0)
    open_ = np.flatnonzero(out != levels(every, (m - shared) // 2))  # only here the letters' order decides
    if len(open_):
        on, rest, base, left = paired[open_], used[open_] & ~np.uint64((1 << shared) - 1), base[open_], left[open_]
        apart = np.zeros(len(open_), dtype=np.int64)
        for i in range(shared, most):
            here = (on >> np.uint64(i)) & ONE
            low = rest & (~rest + ONE)
            apart += ((table[base + letter[i][left]] & low) == 0) & (here == 1)
            rest ^= low * here
        out[open_] = levels(open_, apart // 2)
    return out


def _level_of(left: list[str], right: list[str]) -> np.ndarray:
    x = jaro_winkler_texts(left, right)
    return sum((x >= cut).astype(np.int8) for cut in NAME_LEVELS)


def near(x: str, y: str) -> bool:
    """Equal up to one insertion, deletion, change or swap of neighbours."""
    if abs(len(x) - len(y)) > 1:
        return False
    i = len(os.path.commonprefix([x, y]))
    if len(x) != len(y):
        return x[i + 1 :] == y[i:] if len(x) > len(y) else x[i:] == y[i + 1 :]
    return x[i + 1 :] == y[i + 1 :] or (x[i : i + 2] == y[i : i + 2][::-1] and x[i + 2 :] == y[i + 2 :])


class _Dates:
    """Texts of dates as words of four bits a letter, if they have few letters."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.size = np.array([len(x) for x in texts], dtype=np.int64)
        letters = {c: i for i, c in enumerate(sorted({c for x in texts for c in x}))}
        self.packed = len(letters) <= 16 and self.size.max(initial=0) <= 16
        self.even = bool((self.size == self.size[:1]).all())
        self.word = np.array([sum(letters[c] << 4 * i for i, c in enumerate(x)) for x in texts] if self.packed else [0] * len(texts), dtype=np.uint64)

    def near(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pairs of texts, given by their places, are one edit apart at most."""
        odd = np.zeros(len(left), dtype=bool) if self.even and self.packed else np.full(len(left), not self.packed) | (self.size[left] != self.size[right])
        a, b = self.word[left], self.word[right]
        x = a ^ b
        x |= x >> ONE
        x |= x >> np.uint64(2)
        x &= np.uint64(0x1111111111111111)
        n = np.bitwise_count(x)
        out = n <= 1
        two = np.flatnonzero((n == 2) & ~odd)
        if len(two):
            a, b, x = a[two], b[two], x[two]
            low = x & (~x + ONE)
            here, after = low * np.uint64(15), (low << np.uint64(4)) * np.uint64(15)
            out[two] = (x == low | (low << np.uint64(4))) & ((a & here) == (b & after) >> np.uint64(4)) & ((a & after) >> np.uint64(4) == (b & here))
        odd = np.flatnonzero(odd)
        if len(odd):
            code, back = np.unique(left[odd].astype(np.int64) * len(self.texts) + right[odd], return_inverse=True)
            out[odd] = np.array([near(self.texts[c // len(self.texts)], self.texts[c % len(self.texts)]) for c in code])[back]
        return out


# Patterns: a number for each combination of levels


def _digits() -> list[np.ndarray]:
    """Of each pattern, the level of each field."""
    return [x.ravel() - 1 for x in np.indices(SIZES)]


def pattern_scores(model: dict) -> tuple[np.ndarray, np.ndarray]:
    """match_weight and match_probability of each pattern, in the order of sums that linkage.scored() has."""
    if any(math.isnan(x) for values in linkage.weights(model).values() for x in (model["prior"], *values)):
        raise ValueError("a weight of the model isn't a number")
    weight = np.full(PATTERNS, math.log2(model["prior"] / (1 - model["prior"])))
    for level, values in zip(_digits(), linkage.weights(model).values(), strict=True):
        weight = weight + np.array([0.0, *values])[level + 1]
    odds = np.array([2.0 ** min(w, 1000.0) for w in weight.tolist()])
    return weight, odds / (1 + odds)


def reachable(model: dict, least: float) -> np.ndarray:
    """For each pattern whose name is null, equal or neither (level 0), whether such pairs can have this probability."""
    name = list(linkage.HEIGHTS).index("g_student_name_clean")
    values = linkage.weights(model)["g_student_name_clean"]
    most = np.full(PATTERNS, math.log2(model["prior"] / (1 - model["prior"])))
    for i, (level, x) in enumerate(zip(_digits(), linkage.weights(model).values(), strict=True)):
        most = most + np.array([0.0, *(x if i != name else [max(values[:-1])] * (len(values) - 1) + [values[-1]])])[level + 1]
    return most >= (math.log2(least / (1 - least)) if least < 0.999 else 9.0) - 1e-6 if least > 0 else np.ones(PATTERNS, dtype=bool)


# Rows of records


def _laid(df: DataFrame, rules, number: int, carried, buckets: int, laid_out: bool) -> DataFrame:
    """k0, k1, ..., which are the keys of a rule, and rows: up to CHUNK records that have them."""
    ks = list(dict.fromkeys(x for rule in rules[: number + 1] for x in rule))
    place = [f"k{i}" for i in range(len(rules[number]))]
    df = df.select(F.col("child_record_id").alias("id"), *FIELDS, *carried, *([linkage.TWICE] if linkage.TWICE in df.columns else []), F.datediff(F.col("birthday_str").try_cast("date"), F.lit("1970-01-01").cast("date")).alias("day"), *[F.expr(x).alias(f"r{i}") for i, x in enumerate(ks) if x not in FIELDS], *[F.expr(x).alias(k) for k, x in zip(place, rules[number], strict=True)])
    df = df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in place])).repartition(buckets, *place)
    if linkage.TWICE not in df.columns:  # pairs of an equal number have all been met by its own rule, which comes first
        mark = F.coalesce(twelve_digits(F.col("lrn_clean")), F.lit(False)) & (F.count("*").over(Window.partitionBy("k0")) > 1) if number == 0 else F.lit(False)
        df = df.withColumn(linkage.TWICE, mark)
    df = df.filter("id is not null")
    at = F.row_number().over(Window.partitionBy(*place).orderBy("student_name_clean", "id"))  # names with a common beginning go together
    df = df.withColumn("_chunk", ((at - 1) / CHUNK).cast("int"))
    rows = df.groupBy(*place, "_chunk").agg(F.collect_list(F.struct(*[c for c in df.columns if c not in (*place, "_chunk")])).alias("rows")).drop("_chunk")
    return bucketed(rows, buckets, place) if laid_out else rows


def met(baseline: DataFrame, endline: DataFrame, schema: str, work: Callable, rules=BLOCKING, carried=(), laid_out: bool = False) -> list[DataFrame]:
    """For each rule, what work makes of its pairs: of an iterator of _Unit, record batches of the schema.

    Ids must be unique in each wave; pairs that agree on several rules are those of the first. carried: more columns of
    both waves. laid_out: the rows are written as compressed tables in buckets, and not shuffled when they meet.
    """
    if list(rules)[0] != ("lrn_clean",):
        baseline, endline = linkage._shared_numbers(baseline), linkage._shared_numbers(endline)
    spark = baseline.sparkSession
    buckets = max(1 + max(baseline.count(), endline.count()) // BUCKET_ROWS, spark.sparkContext.defaultParallelism)
    out = []
    for number, rule in enumerate(rules):
        b, e = (_laid(df, rules, number, carried, buckets, laid_out) for df in (baseline, endline))
        keys = [f"k{i}" for i in range(len(rule))]
        rows = b.hint("merge").join(e.withColumnRenamed("rows", "rows_e"), keys).select("rows", "rows_e")
        ks = list(dict.fromkeys(x for r in rules[: number + 1] for x in r))
        name = {x: x if x in FIELDS else f"r{i}" for i, x in enumerate(ks)}
        before = [[name[x] for x in r] for r in rules[:number]]
        out.append(rows.mapInArrow(_worker(work, before, number), schema))
    return out


def _worker(work: Callable, before: list[list[str]], number: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(_Batch(batch, before, number) for batch in batches if batch.num_rows)

    return run


class _Batch:
    """Rows of both waves that meet: columns of the records, as codes where only equality counts."""

    def __init__(self, batch: pa.RecordBatch, before: list[list[str]], number: int):
        self.before, self.number = before, number
        self.side, self.offsets = [], []
        for column in batch.columns:
            at = column.offsets.to_numpy().astype(np.int64)
            rows = column.values.slice(at[0], at[-1] - at[0])
            self.side.append(dict(zip([f.name for f in rows.type], rows.flatten(), strict=True)))
            self.offsets.append(at - at[0])
        self._codes: dict[tuple[str, str], tuple] = {}
        self._columns: dict[tuple[int, str], np.ndarray] = {}

    def codes(self, left: str, right: str | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Equal codes for equal values of both waves, -1 for null, and the values."""
        key = (left, right or left)
        if key not in self._codes:
            b, e = self.side[0][key[0]], self.side[1][key[1]]
            d = pa.concat_arrays([b, e]).dictionary_encode()
            code = d.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
            self._codes[key] = (code[: len(b)], code[len(b) :], d.dictionary)
        return self._codes[key]

    def column(self, wave: int, c: str, null=0) -> np.ndarray:
        if (wave, c) not in self._columns:
            self._columns[wave, c] = self.side[wave][c].fill_null(null).to_numpy(zero_copy_only=False)
        return self._columns[wave, c]

    def units(self) -> Iterator[tuple]:
        """Pairs of records that agree on no earlier rule, and the ranges they are from, if it is one of each wave."""
        (ob, oe), tiny = self.offsets, 1 << 12
        nb, ne = np.diff(ob), np.diff(oe)
        n = nb * ne
        for r in np.flatnonzero(n > tiny):
            step = max(1, UNIT // int(ne[r]))
            right = np.arange(oe[r], oe[r + 1])
            for at in range(int(ob[r]), int(ob[r + 1]), step):
                rows = np.arange(at, min(at + step, int(ob[r + 1])))
                yield from self._open(np.repeat(rows, len(right)), np.tile(right, len(rows)), (rows, right))
        small = np.flatnonzero((n > 0) & (n <= tiny))
        part = np.cumsum(n[small]) // UNIT
        for rows in np.split(small, np.flatnonzero(np.diff(part)) + 1):
            if len(rows):
                count = n[rows]
                row = np.repeat(rows, count)
                place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                yield from self._open(ob[row] + place // ne[row], oe[row] + place % ne[row], None)

    def _open(self, i: np.ndarray, j: np.ndarray, ranges) -> Iterator[tuple]:
        known = np.zeros(len(i), dtype=bool)
        for rule in self.before:
            agree = None
            for c in rule:
                b, e, _ = self.codes(c)
                x = b[i]
                same = (x == e[j]) & (x >= 0)
                agree = same if agree is None else agree & same
            known |= agree
        if known.any():
            i, j = i[~known], j[~known]
        if len(i):
            yield i, j, ranges

    def exact(self, c: str, i, j) -> np.ndarray:
        b, e, _ = self.codes(c)
        x, y = b[i], e[j]
        return np.where((x < 0) | (y < 0), 0, 1 + (x == y)).astype(np.int16)

    def born(self, i, j) -> np.ndarray:
        b, e, texts = self.codes("birthday_str")
        if not hasattr(self, "_dates"):
            self._dates = _Dates(texts.to_pylist())
            self._days = self.column(0, "day", -(10**9)).astype(np.int32), self.column(1, "day", 10**9).astype(np.int32)
        x, y = b[i], e[j]
        null, same = (x < 0) | (y < 0), x == y
        out = np.where(null, 0, 5).astype(np.int16)
        rest = np.flatnonzero(~null & ~same)
        if len(rest):
            whole = len(rest) == len(i)
            x, y, i, j = (x, y, i, j) if whole else (x[rest], y[rest], i[rest], j[rest])
            apart = np.abs(self._days[0][i] - self._days[1][j])
            level = 1 + (apart <= 365).astype(np.int16) + (apart <= 30)
            level[self._dates.near(x, y)] = 4
            out[rest] = level
        return out

    def named(self, i, j, ranges) -> np.ndarray:
        """Levels of names that are neither null nor equal."""
        b, e, texts = self.codes("student_name_clean")
        if ranges is not None:
            (left, x), (right, y) = (np.unique(code[rows], return_inverse=True) for code, rows in zip((b, e), ranges, strict=True))
            if len(left) * len(right) <= len(i):  # each text of one range with each of the other
                own = np.union1d(left, right)
                own = own[own >= 0]
                far = np.repeat(np.searchsorted(own, left), len(right)), np.tile(np.searchsorted(own, right), len(left))
                grid = np.zeros(len(far[0]), dtype=np.int8)
                some = np.flatnonzero(np.repeat(left >= 0, len(right)) & np.tile(right >= 0, len(left)))
                grid[some] = name_levels(texts.take(pa.array(own)).to_pylist(), far[0][some], far[1][some])
                return grid[x[i - ranges[0][0]] * len(right) + y[j - ranges[1][0]]]
        x, y = b[i], e[j]
        own, place = np.unique(np.concatenate([x, y]), return_inverse=True)
        return name_levels(texts.take(pa.array(own)).to_pylist(), place[: len(x)], place[len(x) :])

    def patterns(self, reach: np.ndarray | None = None, rest: bool = False) -> Iterator[tuple]:
        """i, j and the pattern of pairs; with reach, only those whose levels but the name's reach it.

        With rest, also the others, whose pattern is -1: what it would be doesn't matter.
        """
        for i, j, ranges in self.units():
            b, e, _ = self.codes("student_name_clean")
            x, y = b[i], e[j]
            name = np.where((x < 0) | (y < 0), 0, np.where(x == y, len(NAME_LEVELS) + 2, 1)).astype(np.int16)
            other = [self.exact("lrn_clean", i, j), None, self.born(i, j), self.exact("sex", i, j), self.exact("school_id", i, j)]
            step = np.cumprod((1, *SIZES[:0:-1]))[::-1].astype(np.int16)
            code = sum(o * s for o, s in zip(other, step, strict=True) if o is not None) + name * step[1]
            kept = None
            if reach is not None:
                kept = np.flatnonzero(reach[code])
                if not rest:
                    i, j, code, name = i[kept], j[kept], code[kept], name[kept]
                    kept = None
            open_ = np.flatnonzero(name == 1) if kept is None else kept[name[kept] == 1]
            if len(open_):
                code[open_] += self.named(i[open_], j[open_], ranges) * step[1]
            if kept is not None:
                off = np.ones(len(code), dtype=bool)
                off[kept] = False
                code[off] = -1
            if len(i):
                yield i, j, code

    def ids(self, i, j) -> list[pa.Array]:
        return [self.side[0]["id"].take(pa.array(i)), self.side[1]["id"].take(pa.array(j))]

    def moved(self, i, j) -> np.ndarray:
        b, e, _ = self.codes("school_id")
        return b[i] != e[j]

    def ambiguous(self, i, j, code) -> np.ndarray:
        if self.number > 0 and not self.twice:
            return np.zeros(len(i), dtype=bool)
        b, e = self.column(0, linkage.TWICE, False), self.column(1, linkage.TWICE, False)
        return (code // (PATTERNS // SIZES[0]) == 2) & (b[i] | e[j])

    @cached_property
    def twice(self) -> bool:
        return any(self.column(w, linkage.TWICE, False).any() for w in (0, 1))


def unique(baseline: DataFrame, endline: DataFrame) -> bool:
    """Whether no wave has a record id twice; a job."""
    return not linkage._repeated(*[df.filter("child_record_id is not null") for df in (baseline, endline)])


# What is made of the pairs

_LEVELS = "baseline_record_id string, endline_record_id string, " + ", ".join(f"{g} int" for g in linkage.GAMMAS)


def levels(baseline: DataFrame, endline: DataFrame, rules=BLOCKING) -> DataFrame:
    """Ids and levels of all pairs, as linkage.levels() of linkage.blocked_pairs() gives them."""
    digits = [x.astype(np.int32) for x in _digits()]
    names = [c.split()[0] for c in _LEVELS.split(", ")]

    def work(batches):
        for batch in batches:
            for i, j, code in batch.patterns():
                yield pa.RecordBatch.from_arrays([*batch.ids(i, j), *[pa.array(x[code]) for x in digits]], names)

    return reduce(DataFrame.unionByName, met(baseline, endline, _LEVELS, work, rules, laid_out=True))


def pattern_counts(baseline: DataFrame, endline: DataFrame, rules=BLOCKING) -> DataFrame:
    """linkage.pattern_counts() of all pairs; a task hands on a row for each combination it has seen."""
    digits = [x.astype(np.int32) for x in _digits()]

    def work(batches):
        n = np.zeros(PATTERNS, dtype=np.int64)
        for batch in batches:
            for _, _, code in batch.patterns():
                n += np.bincount(code, minlength=PATTERNS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([*[pa.array(x[some]) for x in digits], pa.array(n[some])], [*linkage.GAMMAS, "n"])

    parts = met(baseline, endline, ", ".join([*(f"{g} int" for g in linkage.GAMMAS), "n bigint"]), work, rules)
    return _told(parts).groupBy(*linkage.GAMMAS).agg(F.sum("n").alias("n"))


def _told(parts: list[DataFrame]) -> DataFrame:
    """All rows, which are few, as tables: a job for each part, whose shuffles go before the next."""
    return reduce(DataFrame.unionByName, [stored(df)[0] for df in parts])


_IDS = "baseline_record_id string, endline_record_id string"
_SCORES = f"{_IDS}, baseline_school_id string, endline_school_id string, match_weight double, match_probability double, ambiguous boolean"


def scores(baseline: DataFrame, endline: DataFrame, model: dict, rules=BLOCKING) -> DataFrame:
    """Ids, schools and scores of all pairs, as linkage.probabilistic_candidates() gives them."""
    weight, chance = pattern_scores(model)
    names = [c.split()[0] for c in _SCORES.split(", ")]

    def work(batches):
        for batch in batches:
            for i, j, code in batch.patterns():
                schools = [batch.side[0]["school_id"].take(pa.array(i)), batch.side[1]["school_id"].take(pa.array(j))]
                yield pa.RecordBatch.from_arrays([*batch.ids(i, j), *schools, pa.array(weight[code]), pa.array(chance[code]), pa.array(batch.ambiguous(i, j, code))], names)

    return reduce(DataFrame.unionByName, met(baseline, endline, _SCORES, work, rules, laid_out=True))


def _top(rec, weight, second, *more) -> tuple:
    """The pair of the largest weight of each record, and the next weight."""
    order = np.lexsort((-weight, rec))
    rec, weight, second = rec[order], weight[order], second[order]
    first = np.flatnonzero(np.diff(rec, prepend=-1))
    after = np.full(len(rec), -np.inf)
    again = np.flatnonzero(rec[1:] == rec[:-1])
    after[again] = weight[again + 1]
    return rec[first], weight[first], np.maximum(after[first], np.maximum.reduceat(second, first)), *[x[order][first] for x in more]


def best(baseline: DataFrame, endline: DataFrame, model: dict, accept: float, margin: float, rules=BLOCKING) -> tuple[DataFrame, str]:
    """resolver.BEST of all records that have a pair above the threshold, a row each, and its folder."""
    (weight, chance), reach = pattern_scores(model), reachable(model, accept)

    def tops(batches):
        for batch in batches:
            held = [[], []]
            for i, j, code in batch.patterns(reach):
                up = np.flatnonzero(chance[code] >= accept)
                if len(up):
                    i, j, code = i[up], j[up], code[up]
                    none = np.full(len(up), -np.inf)
                    for rows, own, other in zip(held, (i, j), (j, i), strict=True):
                        rows.append(_top(own, weight[code], none, other, code, batch.ambiguous(i, j, code), batch.moved(i, j)))
            for wave, rows in enumerate(held):
                if rows:
                    own, w, second, other, code, ambiguous, moved = _top(*map(np.concatenate, zip(*rows, strict=True)))
                    text = lambda at, x: batch.side[at]["id"].take(pa.array(x)).to_numpy(zero_copy_only=False)  # noqa: B023,E731
                    yield pd.DataFrame({"side": "be"[wave], "record_id": text(wave, own), "partner": text(1 - wave, other), "weight": w, "second": np.where(np.isneginf(second), np.nan, second), "match_probability": chance[code], "ambiguous": ambiguous, "moved": moved})

    def work(batches):
        yield from resolver.gathered(tops(batches), margin)

    return resolver.merged(met(baseline, endline, resolver.BEST, work, rules), margin)


def accepted(baseline: DataFrame, endline: DataFrame, model: dict, accept: float = 0.1, margin: float = 1.0, rules=BLOCKING) -> DataFrame:
    """resolver.accepted() of all pairs."""
    if margin < 0:
        raise ValueError("the margin can't be negative")
    return resolver.clear(*best(baseline, endline, model, accept, margin, rules))


def reviewed(baseline: DataFrame, endline: DataFrame, model: dict, accept: float = 0.1, floor: float = 0.1, margin: float = 1.0, rules=BLOCKING) -> DataFrame:
    """resolver.reviewed() of all pairs: only records without an accepted pair are met again above the threshold."""
    weight, chance = pattern_scores(model)
    links = accepted(baseline, endline, model, accept, margin, rules)
    schema = f"{_IDS}, match_probability double, match_weight double, transferred_flag boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def between(low, high):
        reach = reachable(model, low)

        def work(batches):
            for batch in batches:
                for i, j, code in batch.patterns(reach):
                    up = np.flatnonzero((chance[code] >= low) & (chance[code] < high))
                    if len(up):
                        i, j, code = i[up], j[up], code[up]
                        yield pa.RecordBatch.from_arrays([*batch.ids(i, j), pa.array(chance[code]), pa.array(weight[code]), pa.array(batch.moved(i, j))], names)

        return work

    free = [stored(df.join(links.select(F.col(side).alias("child_record_id")), "child_record_id", "left_anti"))[0] for df, side in zip((baseline, endline), linkage.PAIR, strict=True)]
    queue = met(*free, schema, between(accept, math.inf), rules, laid_out=True)
    if floor < accept:
        queue += met(baseline, endline, schema, between(floor, accept), rules, laid_out=True)
    return reduce(DataFrame.unionByName, [df.withColumn("decision", F.lit("review")) for df in queue], links.filter("transferred_flag"))


def candidate_counts(baseline: DataFrame, endline: DataFrame, rules=BLOCKING) -> DataFrame:
    """The number of pairs of each baseline record that has any."""

    def work(batches):
        for batch in batches:
            n = np.zeros(len(batch.side[0]["id"]), dtype=np.int64)
            for i, _, _ in batch.units():
                n += np.bincount(i, minlength=len(n))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([batch.side[0]["id"].take(pa.array(some)), pa.array(n[some])], ["baseline_record_id", "n"])

    parts = met(baseline, endline, "baseline_record_id string, n bigint", work, rules)
    parts = [df.groupBy("baseline_record_id").agg(F.sum("n").alias("n")) for df in parts]
    return stored(_told(parts).groupBy("baseline_record_id").agg(F.sum("n").alias("candidate_count")))[0]


def resolved(baseline: DataFrame, endline: DataFrame, model: dict, accept: float = 0.1, floor: float = 0.1, margin: float = 1.0, rules=BLOCKING, counted: bool = False) -> DataFrame:
    """The decisions of resolver.resolve() on all pairs; counted: with probabilities and the baseline record's number of pairs.

    A record with an accepted pair loses its others above the threshold, so a pair is decided by what is known of
    its two records. Without probabilities, the names of pairs that can't reach the floor aren't compared.
    """
    (_, chance), reach = pattern_scores(model), None if counted else reachable(model, floor)
    chance = np.append(chance, 0.0)  # of what can't reach the floor
    links = accepted(baseline, endline, model, accept, margin, rules).select(*linkage.PAIR)
    carried = ["partner", *(["candidate_count"] if counted else [])]
    waves_ = []
    for df, (own, other) in zip((baseline, endline), (linkage.PAIR, linkage.PAIR[::-1]), strict=True):
        df = df.join(links.select(F.col(own).alias("child_record_id"), F.col(other).alias("partner")), "child_record_id", "left")
        if counted and own == linkage.PAIR[0]:
            df = df.join(candidate_counts(baseline, endline, rules).withColumnRenamed(own, "child_record_id"), "child_record_id", "left")
        elif counted:
            df = df.withColumn("candidate_count", F.lit(None).cast("bigint"))
        waves_.append(stored(df)[0])
    words = pa.array(["rejected", "accepted", "review"])
    reasons = pa.array(["one_to_one_conflict", "school_transfer_detected", None, "ambiguous_candidate_margin", "score_between_review_floor_and_accept"])
    schema = f"{_IDS}, " + ("match_probability double, " if counted else "") + "decision string, review_reason string, transferred_flag boolean" + (", candidate_count bigint" if counted else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches):
        for batch in batches:
            partner, ids, _ = batch.codes("partner", "id")
            taken = batch.side[1]["partner"].is_valid().to_numpy(zero_copy_only=False)
            for i, j, code in batch.patterns(reach, rest=True):
                p, moved, own = chance[code], batch.moved(i, j), partner[i]
                above = p >= accept
                clear = above & (own == ids[j])
                lost = above & ~clear & ((own >= 0) | taken[j])
                near_ = ~above & (p >= floor)
                decision = np.where(clear, 1, np.where((above & ~lost) | near_, 2, 0))
                reason = np.where(lost, 0, np.where(clear, np.where(moved, 1, 2), np.where(above, 3, np.where(near_, 4, 2))))
                out = [*batch.ids(i, j), *([pa.array(p)] if counted else []), words.take(pa.array(decision)), reasons.take(pa.array(reason)), pa.array(moved)]
                yield pa.RecordBatch.from_arrays([*out, *([batch.side[0]["candidate_count"].take(pa.array(i))] if counted else [])], names)

    return reduce(DataFrame.unionByName, met(*waves_, schema, work, rules, carried, laid_out=True))


def swept(baseline: DataFrame, endline: DataFrame, model: dict, sweep: tuple[float, ...], floor: float = 0.1, margin: float = 1.0, rules=BLOCKING) -> tuple[DataFrame, DataFrame]:
    """By threshold, the accepted pairs, and the number of pairs for review."""
    if margin < 0:
        raise ValueError("the margin can't be negative")
    (_, chance), low = pattern_scores(model), min(*sweep, floor)
    tops, _ = best(baseline, endline, model, min(sweep), -math.inf, rules)  # partners stay, whatever their lead
    spark = baseline.sparkSession
    steps = spark.createDataFrame([(t, k) for k, t in enumerate(sweep)], "threshold double, step int")
    least = F.col("threshold")
    second = F.when(linkage._probability(F.col("second")) >= least, F.col("second"))
    lead = tops.join(F.broadcast(steps), F.col("match_probability") >= least).filter(second.isNull() | (F.col("weight") - second > margin)).filter(~F.col("ambiguous"))
    b = lead.filter("side = 'b'").select("threshold", "step", F.col("record_id").alias(linkage.PAIR[0]), F.col("partner").alias(linkage.PAIR[1]))
    e = lead.filter("side = 'e'").select("step", F.col("partner").alias(linkage.PAIR[0]), F.col("record_id").alias(linkage.PAIR[1]))
    links = stored(b.join(e, ["step", *linkage.PAIR]))[0]
    at = lambda c: reduce(Column.__add__, [F.max(F.when(F.col("step") == k, 1 << k).otherwise(0).cast("bigint")) for k in range(len(sweep))]).alias(c)
    waves_ = [stored(df.join(links.groupBy(F.col(side).alias("child_record_id")).agg(at("taken")), "child_record_id", "left"))[0] for df, side in zip((baseline, endline), linkage.PAIR, strict=True)]
    reach = reachable(model, low)

    def work(batches):
        n = np.zeros(len(sweep), dtype=np.int64)
        for batch in batches:
            taken = batch.column(0, "taken").astype(np.int64), batch.column(1, "taken").astype(np.int64)
            for i, j, code in batch.patterns(reach):
                up = np.flatnonzero(chance[code] >= low)
                p, lost = chance[code[up]], taken[0][i[up]] | taken[1][j[up]]
                for k, t in enumerate(sweep):
                    n[k] += int(np.where(p >= t, (lost >> k) & 1 == 0, p >= min(t, floor)).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.array(sweep, dtype=float)), pa.array(n)], ["threshold", "n"])

    parts = met(*waves_, "threshold double, n bigint", work, rules, ("taken",))
    return links.drop("step"), _told(parts).groupBy("threshold").agg(F.sum("n").alias("review"))
