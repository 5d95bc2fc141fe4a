"""Benchmark decontamination: BM25 with an inverted index of the test items and block-max WAND.

Texts are split into the words of letters and digits, lower-cased. Items fall
into classes by their number of words, up to 1, 2, 4, 8 and so on. For a class a
document is read in passages of twice its largest number that overlap by half,
so that every stretch as long as an item lies within one. A passage is a query; an
item's score is the sum of its BM25 weights of the passage's terms, as a share
of its score for itself. Document frequencies, the number of items and their mean
length are those of the whole benchmark. All items of at least THRESHOLD are
retrieved: blocks of items whose summed largest weights stay below are left out
for a passage, and WAND
moves over the posting lists of the others by their largest weights. A retrieved
item is a leak if the passage holds at least SHARE of the shingles of its
question and of its answer. Shingles have SHINGLE words, or fewer in a short
part, down to 1 in an answer and 2 elsewhere, so that a changed word leaves
SHARE of them if that is possible. The answer is the last sentence, or the
last SHINGLE words if that is shorter; an item too short for both is one part.

A pass over the documents takes at most ITEMS items or ITEM_BYTES, whose indexes
are sent to the workers; a larger benchmark takes several passes. How items are
dealt to passes has no influence on what is found. Null and empty texts hold no leak; items
without words match nothing; repeated items and documents give rows each. Ids
may be null.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import ALNUM_WORDS, Words, pick, slices, slim, small_batches
from panelforge.llm.components import join_hubs

K1, B = 1.2, 0.75
THRESHOLD = 0.5
SHINGLE, SHARE = 5, 0.8
#: Of k * EDIT - 1 words, one change leaves SHARE of the shingles of k words.
EDIT = 6
ITEMS, ITEM_BYTES = 4096, 8 << 20
ITEMS_A_BLOCK = 4
#: Passages whose bounds are computed at once.
PASSAGES = 2048

FOUND = "doc_id long, item_id long, score double, question double, answer double, first_word long"


def _words(text: str) -> tuple[Words, np.ndarray]:
    data = np.frombuffer((text or "").encode(), np.uint8)
    w = Words(data, np.array([0, len(data)]), ALNUM_WORDS, lower=True)
    return w, w.hashes()


def _whole(t: list[int]) -> set:
    return {tuple(t[i : i + SHINGLE]) for i in range(len(t) - SHINGLE + 1)} if len(t) >= SHINGLE else {tuple(t)} if t else set()


def _grams(t: list[int], k: int) -> set:
    """Shingles of k words, marked by their size: they never equal a short text as a whole."""
    return {(-k, *t[i : i + k]) for i in range(len(t) - k + 1)}


def shingles(terms: np.ndarray) -> set:
    """Of a passage: shingles of all sizes."""
    t = terms.tolist()
    return _whole(t).union(*[_grams(t, k) for k in range(1, SHINGLE)])


def part_shingles(terms: np.ndarray, least: int) -> set:
    """Of a part of an item: shingles of one size, least at least; a part below SHINGLE words is one."""
    t = terms.tolist()
    k = max(least, (len(t) + 1) // EDIT)
    return _whole(t) if k >= SHINGLE or len(t) < SHINGLE else _grams(t, k)


def parts(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of an item, of its question and of its answer."""
    terms = _words(text)[1]
    sentences = [x for x in re.split(r"(?<=[.?!])\s+", text or "") if len(_words(x)[1])]
    last = len(_words(sentences[-1])[1]) if len(sentences) > 1 else 0
    last = max(last, min(SHINGLE, len(terms)))
    if len(terms) - last < SHINGLE:
        return terms, terms, terms
    return terms, terms[:-last], terms[-last:]


@dataclass(frozen=True)
class Corpus:
    """What the weights take from the whole benchmark: items, their mean length, and the frequency of each of the terms."""

    items: int
    mean: float
    frequency: dict[int, int]

    def weights(self, terms: np.ndarray) -> dict[int, float]:
        """BM25 weights of an item's terms, as shares of its own score."""
        norm = K1 * (1 - B + B * len(terms) / self.mean)
        weight = {}
        for x, f in Counter(terms.tolist()).items():
            df = self.frequency[x]
            weight[x] = np.log(1 + (self.items - df + 0.5) / (df + 0.5)) * f * (K1 + 1) / (f + norm)
        own = sum(weight.values())
        return {x: v / own for x, v in weight.items()}


def length_class(words: int) -> int:
    """The power of two that many words fit into."""
    return 1 << max(words - 1, 0).bit_length()


class Index:
    """Posting lists of items of one length class, shortest item first; weights are shares of the items' own scores.

    Blocks are runs of ITEMS_A_BLOCK items of about one length, so a block's
    largest weights bound the score of each of its items closely.
    """

    def __init__(self, items: list[tuple[int | None, str]], corpus: Corpus):
        split = sorted(((i, parts(t)) for i, t in items), key=lambda x: len(x[1][0]))
        self.ids = [i for i, _ in split]
        self.question = [part_shingles(q, 2) for _, (_, q, _) in split]
        self.answer = [part_shingles(a, 1 if len(a) < len(t) else 2) for _, (t, _, a) in split]
        self.step = length_class(max([1, *(len(t) for _, (t, _, _) in split)]))
        n = len(split)
        postings: dict[int, list[tuple[int, float]]] = {}
        for i, (_, (t, _, _)) in enumerate(split):
            for x, v in corpus.weights(t).items():
                postings.setdefault(x, []).append((i, v))
        self.terms = np.array(sorted(postings), dtype=np.uint64)
        self.lists = [([i for i, _ in postings[x]], [v for _, v in postings[x]]) for x in self.terms.tolist()]
        most: list[dict[int, float]] = []
        for ids, values in self.lists:
            most.append({})
            for i, v in zip(ids, values, strict=True):
                most[-1][i // ITEMS_A_BLOCK] = max(v, most[-1].get(i // ITEMS_A_BLOCK, 0.0))
        self.block_most = most
        self.blocks = -(-n // ITEMS_A_BLOCK)
        self.first = np.concatenate([[0], np.cumsum([len(m) for m in most])]).astype(np.int64)
        self.block = np.array([k for m in most for k in m], dtype=np.int64)
        self.weight = np.array([v for m in most for v in m.values()])

    def bounds(self, passage: np.ndarray, term: np.ndarray, passages: int) -> np.ndarray:
        """Upper bounds of the items of each block for each passage, from distinct (passage, term) pairs."""
        size = self.first[term + 1] - self.first[term]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[term], size)
        cell = np.repeat(passage, size) * self.blocks + self.block[at]
        return np.bincount(cell, self.weight[at], passages * self.blocks).reshape(passages, self.blocks)

    def search(self, query: list[int], threshold: float, blocks: list[int]) -> list[tuple[int, float]]:
        """WAND over the posting lists of the query's terms, in the blocks whose bounds reach the threshold: all items that do."""
        found, slack = [], threshold - 1e-9
        for block in blocks:
            done = (block + 1) * ITEMS_A_BLOCK
            heads = []  # place in the list, end of the block there, largest weight, ids, weights
            for t in query:
                if block in self.block_most[t]:
                    ids, values = self.lists[t]
                    lo = bisect_left(ids, block * ITEMS_A_BLOCK)
                    heads.append([lo, bisect_left(ids, done, lo), self.block_most[t][block], ids, values])
            while True:
                heads = sorted((h for h in heads if h[0] < h[1]), key=lambda h: h[3][h[0]])
                bound, pivot = 0.0, None
                for k, h in enumerate(heads):
                    bound += h[2]
                    if bound >= slack:
                        pivot = h[3][h[0]]
                        break
                if pivot is None:
                    break
                if heads[0][3][heads[0][0]] == pivot:
                    score = 0.0
                    for h in heads:
                        if h[3][h[0]] != pivot:
                            break
                        score += h[4][h[0]]
                        h[0] += 1
                    if score >= slack:
                        found.append((pivot, score))
                else:
                    for h in heads[:k]:
                        h[0] = bisect_left(h[3], pivot, h[0], h[1])
        return found


def overlap(part: set, passage: set) -> float:
    return len(part & passage) / len(part) if part else 0.0


def matches(w: Words, h: np.ndarray, index: Index, threshold: float = THRESHOLD, share: float = SHARE) -> list[tuple[int, int, float, float, float, int]]:
    """Leaks in the texts of a slice with words w of hashes h: text, item, score, overlaps of question and answer, first word of the passage."""
    if not len(index.terms) or not len(h):
        return []
    number = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[number] == h)
    if not len(hit):
        return []
    step = index.step
    steps = np.maximum(1, -(-np.maximum(w.counts - step, 0) // step))
    before = np.cumsum(steps) - steps
    best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
    # a word is in the passage that begins in its stretch of step words, and in the one before
    owner = w.owner[hit]
    nth = (hit - w.first[owner]) // step
    now, past = nth < steps[owner], nth > 0
    pair = np.concatenate([(before[owner] + nth)[now], (before[owner] + nth - 1)[past]])
    pair = np.unique(pair * len(index.terms) + np.concatenate([number[hit[now]], number[hit[past]]]))
    passage, term = np.divmod(pair, len(index.terms))
    text = np.repeat(np.arange(len(steps)), steps)
    for lo in range(0, int(steps.sum()), PASSAGES):
        a, b = np.searchsorted(passage, [lo, lo + PASSAGES])
        bound = index.bounds(passage[a:b] - lo, term[a:b], min(PASSAGES, int(steps.sum()) - lo))
        rows, blocks = np.nonzero(bound >= threshold - 1e-6)
        for k in np.unique(rows).tolist():
            p = lo + k
            i, j = np.searchsorted(passage, [p, p + 1])
            begin = int(w.first[text[p]] + (p - before[text[p]]) * step)
            held = None
            for item, score in index.search(term[i:j].tolist(), threshold, blocks[rows == k].tolist()):
                held = shingles(h[begin : min(begin + 2 * step, int(w.first[text[p] + 1]))]) if held is None else held
                q, r = overlap(index.question[item], held), overlap(index.answer[item], held)
                if q >= share and r >= share:
                    key, row = (int(text[p]), item), (score, q, r, begin - int(w.first[text[p]]))
                    if key not in best or row[:3] > best[key][:3]:
                        best[key] = row
    return [(*key, *row) for key, row in sorted(best.items())]


@slim
def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [_words(t)[1].view(np.int64) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([len(x) for x in found], pa.int64()), pa.array([np.unique(x) for x in found], pa.list_(pa.int64()))], names=[*b.schema.names, "words", "terms"])


def _passes(benchmark: DataFrame) -> Iterator[list[Index]]:
    """The indexes of each pass, one for each length class in it. At most a pass's items are on the driver at a time."""
    known = pick(benchmark, item_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    known = known.mapInArrow(_terms, "item_id long, text string, words long, terms array<long>").filter("words > 0")
    total = known.agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.sum(F.size("terms")).alias("terms")).collect()[0]
    if not total["n"]:
        return
    mean = total["words"] / total["n"]
    named = known.withColumn("name", F.xxhash64("item_id", "text"))  # repeated items share their terms
    each = named.select("name", "item_id", "text", "words", F.explode("terms").alias("term"))
    often = each.groupBy("term").agg(F.count("*").alias("df"), F.count("*").alias("n"))
    facts = join_hubs(each, often, "term", total["terms"])
    facts = facts.groupBy("name", "item_id", "text", "words").agg(F.collect_list(F.struct("term", "df")).alias("terms"), (F.count("*") / F.count_distinct("term")).cast("long").alias("copies"))
    held: dict[int, list] = {}
    frequency: dict[int, int] = {}
    n = size = 0

    def out() -> list[Index]:
        return [Index(items, Corpus(total["n"], mean, frequency)) for _, items in sorted(held.items())]

    for r in facts.orderBy("words", "item_id", "text").toLocalIterator():
        if n and (n >= ITEMS or size + len(r["text"]) > ITEM_BYTES):
            yield out()
            held, frequency, n, size = {}, {}, 0, 0
        held.setdefault(length_class(r["words"]), []).extend([(r["item_id"], r["text"])] * r["copies"])
        frequency.update((int(np.int64(t["term"]).view(np.uint64)), t["df"]) for t in r["terms"])
        n, size = n + r["copies"], size + len(r["text"])
    if held:
        yield out()


def _each(batch: pa.RecordBatch, indexes: list[Index]) -> Iterator[tuple[int, Index, list]]:
    """First row, index and matches, slice by slice; the words of a slice are found once."""
    for lo, _, data, offsets in slices(batch.column("text")):
        w = Words(data, offsets, ALNUM_WORDS, lower=True)
        h = w.hashes()
        for index in indexes:
            yield lo, index, matches(w, h, index)


def _find(indexes: list[Index]):
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for lo, index, found in _each(b, indexes):
                rows = [(ids[lo + t].as_py(), index.ids[i], *rest) for t, i, *rest in found]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names=names)

    return slim(run)


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document (doc_id, text) and item (item_id, text) that it leaks: score, overlaps and place."""
    spark = documents.sparkSession
    small_batches(spark)
    docs = pick(documents, doc_id="long", text="string")
    found = [docs.mapInArrow(_find(indexes), FOUND) for indexes in _passes(benchmark)]
    if not found:
        return spark.createDataFrame([], FOUND)
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def _drop(indexes: list[Index]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.ones(b.num_rows, dtype=bool)
            for lo, _, found in _each(b, indexes):
                keep[[lo + t for t, *_ in found]] = False
            yield b.filter(pa.array(keep))

    return slim(run)


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    small_batches(documents.sparkSession)
    for indexes in _passes(benchmark):
        documents = documents.mapInArrow(_drop(indexes), documents.schema)
    return documents
