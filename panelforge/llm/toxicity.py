"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of lexicon words, of lexicon prefixes and of seed
insults; second person near a lexicon word; capitals; punctuation; obfuscated
words (digits or signs between letters), and those that match the lexicon once
the signs are read as letters. The lexicon is learned: words and prefixes whose
share of toxic documents in one part of the sample is far above the average.

The sample is the SAMPLE labelled rows that come first by a hash of doc_id,
among those whose crc32(doc_id as text) mod 5 is not 0. SAMPLE bounds what is
fitted on; texts are whole, and everything is scored. A third of the sample
gives the lexicon; the trees are fitted on the rest. The calibration is fitted on
out-of-fold scores: the rest is cut into FOLDS by a hash of doc_id, and trees of
the other folds score each one. That holds for any number of labels.

Null texts count as empty and are scored like them. A null doc_id has no label
and is held out iff crc32('') mod 5 is 0. Repeated labels of a document: toxic
if any says so; null labels are none. Labels that aren't of both kinds can't be
learned from: the score is the density of seed insults then, 0.5 at SEED_RATE.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelforge.llm.common import SPACE_WORDS, Words, fresh, mix64, pick, slices, slim, small_batches, span_hashes

SAMPLE = 12_000
FOLDS = 3
SEED_RATE = 0.01
#: Common insults, and words for the second person in four languages.
INSULTS = ("idiot", "moron", "stupid", "loser", "trash", "scum", "clown", "pathetic", "worthless", "disgusting", "dumb", "fool", "jerk", "ugly", "shut", "hate")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "tu", "te", "toi", "vous", "votre", "tú", "usted", "ustedes", "vos")
#: Signs that stand for letters in obfuscated words.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
PREFIXES = (6, 8)
NEAR = 5

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_READ = _LOWER.copy()
for _k, _v in LEET.items():
    _READ[ord(_k)] = ord(_v)
_CLASS = {k: np.zeros(256, dtype=bool) for k in ("alnum", "letter", "upper", "digit", "punct", "shout", "sign")}
for _i in range(256):
    _c = chr(_i) if _i < 128 else "x"
    _CLASS["alnum"][_i] = _i >= 128 or _c.isalnum()
    _CLASS["letter"][_i] = _i >= 128 or _c.isalpha()
    _CLASS["upper"][_i] = 65 <= _i <= 90
    _CLASS["digit"][_i] = 48 <= _i <= 57
    _CLASS["punct"][_i] = _i < 128 and 32 < _i and not _c.isalnum()
    _CLASS["shout"][_i] = _c in "!?"
    _CLASS["sign"][_i] = _i < 128 and 32 < _i and not _c.isalpha()


def _hash_words(words: tuple[str, ...]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in data])
    return np.unique(span_hashes(np.frombuffer(b"".join(data), np.uint8), ends - [len(w) for w in data], ends))


SEEDS, SECOND = _hash_words(INSULTS), _hash_words(SECOND_PERSON)


class Terms:
    """Words of a slice without the signs around them, and the hashes that stand for them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = self.words = Words(data, offsets, SPACE_WORDS)
        starts, ends = w.starts.copy(), w.ends.copy()
        alnum = _CLASS["alnum"][data]
        n = len(data)
        if len(starts):
            place = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
            after = np.minimum.accumulate(np.where(alnum, place, n)[::-1])[::-1]  # next letter or digit
            before = np.maximum.accumulate(np.where(alnum, place, -1))
            s, e = after[starts], before[ends - 1] + 1
            bare = s < e  # else the word has signs only
            starts, ends = np.where(bare & (s < ends), s, starts), np.where(bare & (s < ends), e, ends)
        self.starts, self.ends = starts, ends
        low = _LOWER[data]
        self.hashes = span_hashes(low, starts, ends)
        self.prefixes = [mix64(span_hashes(low, starts, np.minimum(ends, starts + p)) + _U(p)) for p in PREFIXES]
        for p, h in zip(PREFIXES, self.prefixes, strict=True):
            h[ends - starts <= p] = 0  # a word is not its own prefix

    def sums(self, of: np.ndarray) -> np.ndarray:
        """Totals per text of a value per word."""
        total = np.concatenate([[0], np.cumsum(of)])
        return total[self.words.first[1:]] - total[self.words.first[:-1]]


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(x):
        return np.zeros(len(x), dtype=bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def features(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """A row per text. lexicon: sorted hashes of words and prefixes."""
    t = Terms(data, offsets)
    w, n = t.words, np.maximum(t.words.counts, 1)
    inside, whole = {}, {}
    total = np.zeros(len(data) + 1, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    for k, of in _CLASS.items():  # one running count at a time
        np.cumsum(of[data], out=total[1:])
        inside[k], whole[k] = total[t.ends] - total[t.starts], total[offsets[1:]] - total[offsets[:-1]]
    letters = inside["letter"]
    odd = (letters > 0) & (inside["sign"] > 0)
    seed, known = _among(t.hashes, SEEDS), _among(t.hashes, lexicon)
    begun = np.zeros(len(w), dtype=bool)
    for h in t.prefixes:
        begun |= _among(h, lexicon)
    disguised = np.zeros(len(w), dtype=bool)
    at = np.flatnonzero(odd)
    if len(at):
        h = span_hashes(_READ[data], t.starts[at], t.ends[at])
        disguised[at] = _among(h, SEEDS) | _among(h, lexicon)
    hit = seed | known | begun | disguised
    second = np.concatenate([[0], np.cumsum(_among(t.hashes, SECOND))])
    i = np.arange(len(w))
    lo, hi = np.maximum(i - NEAR, w.first[w.owner] if len(w) else i), np.minimum(i + NEAR + 1, w.first[w.owner + 1] if len(w) else i)
    close = hit & (second[hi] > second[lo])
    size = np.maximum(offsets[1:] - offsets[:-1], 1)
    shouted = (inside["upper"] > 1) & (inside["upper"] == letters)
    per_word = [seed, known, begun, hit, disguised, odd, close, shouted]
    rates = [t.sums(x) / n for x in per_word]
    hits = t.sums(hit)
    return np.column_stack([*rates, hits, t.sums(seed | disguised), t.sums(begun), np.log1p(w.counts), *[whole[k] / size for k in ("upper", "digit", "punct", "shout")], t.sums(second[1:] - second[:-1]) / n]).astype(np.float64)


# Trees


@dataclass
class Trees:
    """Boosted regression trees on the logistic loss, all of one depth; split s of a node: feature[s] > threshold[s] goes right."""

    depth: int
    rate: float
    base: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, th, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > th[node])
            out += self.rate * v[node - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, smooth: float = 2.0) -> Trees:
    """Second-order boosting on histograms of quantile bins."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(d)]
    for j in range(d):  # rare values too
        cuts[j] = np.unique(np.concatenate([cuts[j], np.quantile(x[x[:, j] > 0, j], np.linspace(0, 1, 16)) * (1 - 1e-9) if (x[:, j] > 0).any() else []]))
    width = max(len(c) for c in cuts) + 1
    binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(d)])
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Trees(depth, rate, float(np.log(share / (1 - share))))
    score = np.full(n, model.base)
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            local = node - first
            best, pick_f, pick_b = np.full(many, 1e-6), np.zeros(many, dtype=np.int64), np.full(many, -1)
            for j in range(d):
                key = local * width + binned[:, j]
                gs, hs = (np.bincount(key, v, many * width).reshape(many, width).cumsum(axis=1) for v in (g, h))
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + smooth) + (gt - gs) ** 2 / (ht - hs + smooth) - gt**2 / (ht + smooth)
                gain[(hs < 1) | (ht - hs < 1)] = 0
                b = gain[:, : len(cuts[j])].argmax(axis=1) if len(cuts[j]) else np.zeros(many, dtype=np.int64)
                got = gain[np.arange(many), b]
                better = (got > best) & bool(len(cuts[j]))
                best[better], pick_f[better], pick_b[better] = got[better], j, b[better]
            for m in np.flatnonzero(pick_b >= 0):
                feature[first + m], threshold[first + m] = pick_f[m], cuts[pick_f[m]][pick_b[m]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + smooth)
        model.feature.append(feature), model.threshold.append(threshold), model.value.append(value)
        score += rate * value[leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: scores and the calibrated values at them, to be interpolated."""
    level, of = np.unique(score, return_inverse=True)
    blocks: list[list[float]] = []  # sum of labels, weight, smallest and largest score
    for s, v, n in zip(level.tolist(), np.bincount(of, y, len(level)).tolist(), np.bincount(of, minlength=len(level)).tolist(), strict=True):
        blocks.append([v, n, s, s])  # rows of one score are together from the start
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + b[0], blocks[-1][1] + b[1], blocks[-1][2], b[3]]
    xs = np.array([x for b in blocks for x in (b[2], b[3])])
    ys = np.array([b[0] / b[1] for b in blocks for _ in range(2)])
    return xs, ys


@dataclass
class Model:
    lexicon: np.ndarray
    trees: Trees | None = None
    at: np.ndarray | None = None
    calibrated: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return x[:, 0] / (x[:, 0] + SEED_RATE)
        raw = self.trees.raw(x)
        # Among texts of one calibrated value the raw score still tells more from less likely ones.
        value = np.interp(raw, self.at, self.calibrated)
        tied = 1 / (1 + np.exp(-raw))
        return np.where(value >= 0.5, np.maximum(0.5, value * 0.98 + tied * 0.02), np.minimum(np.nextafter(0.5, 0), value * 0.98 + tied * 0.02))


def _parts(column) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word or prefix, and toxic ones among them, summed over a slice."""
    for b in batches:
        toxic = _parts(b.column("toxic"))
        for lo, _, data, offsets in slices(b.column("text")):
            t = Terms(data, offsets)
            owner = np.tile(t.words.owner, 1 + len(PREFIXES))
            terms = np.concatenate([t.hashes, *t.prefixes])
            owner, terms = owner[terms != 0], terms[terms != 0]
            order = np.lexsort((owner, terms))
            owner, terms = owner[order], terms[order]
            new = np.ones(len(terms), dtype=bool)
            new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
            owner, terms = owner[new], terms[new]
            keys, at = np.unique(terms, return_index=True)
            if not len(keys):
                continue
            hot = np.add.reduceat(toxic[lo + owner].astype(np.int64), at)
            every = np.diff(np.append(at, len(terms)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(hot), pa.array(every.astype(np.int64))], names=["term", "hot", "every"])


_count_terms = slim(_count_terms)


def _features(lexicon: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in slices(b.column("text")):
                x = features(data, offsets, lexicon)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("toxic").slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "toxic", "x"])

    return slim(run)


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of documents (doc_id, text) and labels (doc_id, toxic)."""
    spark = documents.sparkSession
    small_batches(spark)
    known = pick(labels, doc_id="long", toxic="int").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)))
    docs = pick(documents, doc_id="long", text="string").join(F.broadcast(drawn), "doc_id")  # at most sample rows of two numbers
    first = docs.filter("part = 0").select("text", "toxic")
    terms = first.mapInArrow(_count_terms, "term long, hot long, every long").groupBy("term").agg(F.sum("hot").alias("hot"), F.sum("every").alias("every"))
    sizes = drawn.filter("part = 0").agg(F.sum("toxic").alias("hot"), F.count("*").alias("every")).collect()[0]
    hot, every = sizes["hot"] or 0, sizes["every"]
    lexicon = np.zeros(0, dtype=np.uint64)
    if hot:
        share = hot / every
        least = max(3, hot // 150)
        odds = (F.col("hot") + 0.5) / (F.col("every") - F.col("hot") + 0.5)
        strong = terms.filter((F.col("hot") >= least) & (odds >= 8 * share / (1 - share + 1e-9)) & (odds >= 1))
        lexicon = np.sort(np.array([r["term"] for r in strong.select("term").collect()], dtype=np.int64).view(np.uint64))
    rest = docs.filter("part > 0").select("doc_id", "toxic", "text").mapInArrow(_features(lexicon), "doc_id long, toxic int, x binary").toArrow()
    rest = rest.sort_by([("doc_id", "ascending"), ("x", "ascending")])
    y = rest.column("toxic").to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return Model(lexicon)
    x = np.stack([np.frombuffer(r) for r in rest.column("x").to_pylist()])
    return Model(lexicon, *fit(x, y, rest.column("doc_id").to_numpy()))


def fit(x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> tuple[Trees, np.ndarray, np.ndarray]:
    """Trees on all rows, and the calibration of their scores from those of rows that the trees hadn't seen."""
    fold = (mix64(ids.astype(np.uint64)) % _U(FOLDS)).astype(np.int64)
    unseen = np.empty(len(y))
    for f in np.unique(fold).tolist():
        own = fold == f
        others = ~own if not own.all() else own  # rows of one document only
        unseen[own] = boost(x[others], y[others]).raw(x[own])
    return boost(x, y), *isotonic(unseen, y)


def _scores(model: Model, passed: list[str], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = slices(b.column("text"))
            score = [np.clip(model.score(features(data, offsets, model.lexicon)), 0.0, 1.0) for _, _, data, offsets in parts]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in passed], pa.array(np.concatenate(score) if score else np.zeros(0))], names=[*passed, name])

    return slim(run)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of documents (doc_id, text)."""
    small_batches(documents.sparkSession)
    rows = pick(documents, doc_id="long", text="string").mapInArrow(_scores(model, ["doc_id"], "score"), "doc_id long, score double")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, model: Model) -> DataFrame:
    """The documents below 0.5, with all their columns."""
    small_batches(documents.sparkSession)
    name = fresh("score", documents.columns)
    schema = StructType([*documents.schema.fields, StructField(name, DoubleType())])
    scored = documents.mapInArrow(_scores(model, documents.columns, name), schema)
    return scored.filter(F.col(name) < 0.5).drop(name)
