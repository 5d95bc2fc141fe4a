"""MinHash near-dedup by fast similarity sketching.

A document is the set of its distinct shingles of SHINGLE lower-cased words.
Its sketch has COORDINATES places. In round i every shingle is put into a hashed
place with value i + hash; from round COORDINATES on, into place i - COORDINATES,
so that every place is filled after twice as many rounds at most. A place keeps
its smallest value. Two sketches agree in a place with the sets' Jaccard
similarity as the chance, and the share of places that agree is concentrated
around it as sharply as for independent places.

1. Equal sets form classes, by a fingerprint of 128 bits from two independent
   hashes of the words; only their smallest document goes on.
2. Bands of ROWS places: at a similarity of 0.8, two documents share none of the
   BANDS bands with a chance of 3e-8. Every member of a band's bucket is tied to
   its smallest one; the components of these ties are the groups in which all
   links must lie.
3. Each text goes to its group once. There, sketches that agree in fewer than
   AGREE places (six standard deviations below 0.8) are no link; other pairs,
   most alike first, are compared exactly on the full sets unless they are
   connected already. Groups of more than BLOCK documents are cut into blocks
   that are solved alone together with PIVOTS documents of the group. What isn't
   tied to the block's first pivot then asks the whole group, by rare shingles:
   with a group's shingles in order of their number in it, linked sets share one
   of their first size - ceil(0.8 size) + 1. Lines that many texts have are late
   in that order, so texts that share no more than such lines don't meet. Where
   at most ASKERS documents ask by a shingle, they are paired with all that have
   it; the shingles of more tie their documents to sets, in which a block of
   askers meets a block of documents in a task, so that no pairs are made. A pair
   is compared by hashes of its shingles first, and becomes a link if the
   shingles' words themselves confirm it. Only the edges of a forest are emitted.
4. Components of these edges, spread over the classes.

Null and empty texts, and texts without words, have an empty set and are linked
with nothing. A null doc_id is linked with nothing. Rows that repeat a doc_id
all stay in the result, but are one document with one set: where their texts
differ, a group compares one of these only, which one depends on the order of
rows, and near copies of the others may get no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import SPACE_WORDS, Scratch, Words, buffers, fresh, give_back, mix64, pick, slices, slim, small_batches, written
from panelforge.llm.components import components, join_hubs

ROWS, BANDS = 5, 44
COORDINATES = ROWS * BANDS
#: Documents of a block at most, about, and shingles of all of them.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22
PIVOTS = 16
#: Documents that ask by a shingle, up to which they are paired with all that have it.
ASKERS = 4
#: Documents and shingles, as in a block, of the small groups that are solved at once.
BIN, BIN_SHINGLES = 256, 1 << 19
#: Places of COORDINATES that agree at 0.8, less six standard deviations.
AGREE = int(COORDINATES * 0.8 - 6 * (COORDINATES * 0.16) ** 0.5)

_U = np.uint64


class Sets:
    """Distinct shingles of the texts of a slice: keys, sorted for each text; first: where each text's begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shingle: int):
        self.words = Words(data, offsets, SPACE_WORDS, lower=True)
        self.shingle = shingle
        self.keys, self.owner = self._distinct(0)
        self.first = np.searchsorted(self.owner, np.arange(len(offsets)))
        self.counts = np.diff(self.first)

    def _distinct(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        w = self.words
        h = w.hashes(seed)
        at, keys = w.windows(h, self.shingle, seed=2)
        owner = w.owner[at]
        brief = np.flatnonzero((w.counts > 0) & (w.counts < self.shingle))  # the whole sequence is one shingle
        if len(brief):
            whole = np.array([self._whole(h[w.first[i] : w.first[i + 1]]) for i in brief], dtype=np.uint64)
            owner, keys = np.concatenate([owner, brief]), np.concatenate([keys, whole])
        order = np.lexsort((keys, owner))
        owner, keys = owner[order], keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        return keys[new], owner[new]

    @staticmethod
    def _whole(h: np.ndarray) -> int:
        x = np.array([len(h)], dtype=np.uint64)
        for v in h:
            x = mix64(x * _U(31) + v)
        return x[0]

    def prints(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums over each text's shingles, in any order, of independent hashes."""
        out = []
        for keys, owner in ((self.keys, self.owner), self._distinct(1)):
            first = np.searchsorted(owner, np.arange(len(self.counts) + 1))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(keys ^ _U(0x2545F4914F6CDD1D)), dtype=np.uint64)])
            out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
        return out[0], out[1]

    def sketches(self) -> np.ndarray:
        """A row of COORDINATES values for each text; of empty texts all are the largest value."""
        t, n = COORDINATES, len(self.counts)
        full = np.full(n * t, np.iinfo(np.uint64).max, dtype=np.uint64)
        open_text = self.counts > 0
        keys, owner = self.keys, self.owner
        for i in range(2 * t):
            if not len(keys):
                break
            x = mix64(keys ^ mix64(np.array([1000 + i], np.uint64)))
            place = (((x >> _U(32)) * _U(t)) >> _U(32)).astype(np.int64) if i < t else np.full(len(x), i - t)
            value = (_U(i) << _U(54)) | (mix64(x) >> _U(10))
            np.minimum.at(full, owner * t + place, value)
            open_text = (full.reshape(n, t) == np.iinfo(np.uint64).max).any(axis=1)
            more = open_text[owner]
            keys, owner = keys[more], owner[more]
        return full.reshape(n, t)


def bands(sketches: np.ndarray) -> np.ndarray:
    """A key per band; keys of different bands don't meet."""
    x = sketches.reshape(len(sketches), BANDS, ROWS)
    key = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), x.shape[:2])
    for r in range(ROWS):
        key = mix64(key * _U(3) + x[:, :, r])
    return key.view(np.int64)


SKETCHES = "doc_id long, text_hash long, n_shingles long, fp1 long, fp2 long, bands array<long>"


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in slices(b.column("text"), 1 << 19):
                s = Sets(data, offsets, shingle)
                one, two = s.prints()
                keys = bands(s.sketches())
                cuts = np.concatenate([[0], np.cumsum(np.where(s.counts > 0, BANDS, 0))]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys[s.counts > 0].ravel()))
                own = [b.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(s.counts.astype(np.int64)), pa.array(one), pa.array(two), flat], names=["doc_id", "text_hash", "n_shingles", "fp1", "fp2", "bands"])

    return slim(run)


@slim
def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for b in batches:
        data, offsets = buffers(b.column("text"))
        at = offsets.tolist()
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([pack.compress(data[lo:hi].tobytes()) for lo, hi in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["doc_id", "packed"])


def _shingles(text: bytes, size: int) -> set[bytes]:
    """The shingles themselves, their words joined by a space."""
    w = text.lower().split()
    return {b" ".join(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()


class Group:
    """Documents of one group: their sets and sketches. Rows of the same number with another set are left out."""

    def __init__(self, t: pa.Table, shingle: int, sketched: bool = True):
        unpack = zstandard.ZstdDecompressor()
        self.packed, self.shingle = t.column("packed").to_pylist(), shingle
        ids, prints = t.column("node").to_numpy(), t.column("fp1").to_numpy()
        sets, sketches, keep, seen = [], [], [], set()
        lo = 0
        while lo < len(self.packed):  # texts are unpacked a slice at a time
            texts, size = [], 0
            while lo + len(texts) < len(self.packed) and size < 1 << 20:
                texts.append(unpack.decompress(self.packed[lo + len(texts)]))
                size += len(texts[-1])
            hi = lo + len(texts)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
            s = Sets(np.frombuffer(b"".join(texts), np.uint8), offsets, shingle)
            one = s.prints()[0]
            sk = s.sketches() if sketched else np.zeros((hi - lo, 0), np.uint64)
            for i in range(hi - lo):
                if one[i] == prints[lo + i] and ids[lo + i] not in seen:
                    seen.add(ids[lo + i])
                    keep.append(lo + i)
                    sets.append(s.keys[s.first[i] : s.first[i + 1]].copy())
                    sketches.append((mix64(sk[i]) >> _U(48)).astype(np.uint16))
            lo = hi
        self.at = np.array(keep, dtype=np.int64)
        self.ids, self.sets = ids[self.at], sets
        self.sketches = np.stack(sketches) if sketches else np.zeros((0, COORDINATES), np.uint16)
        self.parent = list(range(len(sets)))

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def linked(self, i: int, j: int, percent: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
            return False
        if len(a) > len(b):
            a, b = b, a
        both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return 100 * both >= percent * (len(a) + len(b) - both) and self.confirmed(i, j, percent)

    def confirmed(self, i: int, j: int, percent: int) -> bool:
        unpack = zstandard.ZstdDecompressor()
        a, b = (_shingles(unpack.decompress(self.packed[self.at[x]]), self.shingle) for x in (i, j))
        both = len(a & b)
        return 100 * both >= percent * (len(a) + len(b) - both)

    def join(self, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
        """Compares the documents left with the documents right; the links that connected something."""
        edges = []
        cols = np.ascontiguousarray(self.sketches[right].T)
        for lo in range(0, len(left), 128):
            part = left[lo : lo + 128]
            rows = self.sketches[part]
            if len(part) * len(right) <= 1 << 12:
                agree = (rows[:, None, :] == self.sketches[right][None, :, :]).sum(axis=2)
            else:
                agree = np.zeros((len(part), len(right)), dtype=np.int16)
                for c in range(COORDINATES):
                    agree += rows[:, c][:, None] == cols[c][None, :]
            i, j = np.nonzero(agree >= AGREE)
            best = np.argsort(-agree[i, j], kind="stable")
            for a, b in zip(part[i[best]].tolist(), right[j[best]].tolist(), strict=True):
                if a != b and (ra := self.root(a)) != (rb := self.root(b)) and self.linked(a, b, percent):
                    self.parent[max(ra, rb)] = min(ra, rb)
                    edges.append((a, b))
        return edges


EDGES = "a long, b long, loose long"


def _rows(g: Group, edges: list[tuple[int, int]], loose: np.ndarray) -> pa.Table:
    """Links, and documents that aren't tied to the first pivot."""
    a, b = (g.ids[[e[k] for e in edges]] if edges else np.zeros(0, np.int64) for k in (0, 1))
    none = lambda n: pa.nulls(n, pa.int64())
    col = lambda x, n: pa.chunked_array([pa.array(x, pa.int64()), none(n)])
    return pa.table({"a": col(a, len(loose)), "b": col(b, len(loose)), "loose": pa.chunked_array([none(len(a)), pa.array(loose, pa.int64())])})


def _solve(shingle: int, percent: int):
    """Whole groups, or a block of a large one with the group's pivots: all pairs within."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by([("node", "ascending"), ("pivot", "descending")])  # a pivot counts as one in its own block too
        g = Group(t, shingle)
        pivot = t.column("pivot").to_numpy(zero_copy_only=False)[g.at].astype(bool)
        grp = t.column("grp").to_numpy()[g.at]
        order = np.argsort(grp, kind="stable")
        edges: list[tuple[int, int]] = []
        for part in np.split(order, np.flatnonzero(np.diff(grp[order])) + 1):
            edges += g.join(part, part, percent)
        give_back()
        if not pivot.any():  # whole groups are here
            return _rows(g, edges, np.zeros(0, np.int64))
        first = g.root(int(np.flatnonzero(pivot)[np.argmin(g.ids[pivot])]))
        loose = np.array([g.root(i) != first for i in range(len(g.ids))], dtype=bool)
        return _rows(g, edges, g.ids[loose])

    return run


KEYS = "key long, node long, size long, asks boolean"


def _keys(shingle: int):
    """A row per distinct shingle of each document of a large group; keys of different groups don't meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            prints, grp = b.column("fp1").to_numpy(), b.column("grp").to_numpy().astype(np.uint64)
            node, asks = b.column("node").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            texts = pa.array([unpack.decompress(x) for x in b.column("packed").to_pylist()], pa.binary())
            for lo, _, data, offsets in slices(texts, 1 << 19):
                s = Sets(data, offsets, shingle)
                own = s.prints()[0] == prints[lo : lo + len(s.counts)]  # rows of the same number with another set are left out
                at = s.owner[own[s.owner]] + lo
                keys = mix64(s.keys[own[s.owner]] ^ mix64(grp[at])).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(node[at]), pa.array(s.counts[at - lo].astype(np.int64)), pa.array(asks[at])], names=["key", "node", "size", "asks"])

    return slim(run)


def _prefixes(keys: DataFrame, percent: int) -> DataFrame:
    """key, node, size, asks, place: the shingles by which documents may be linked, from the one that is rarest in their group."""
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).withColumn("often", F.col("n"))
    # repeated rows of a document have one place
    place = F.dense_rank().over(Window.partitionBy("node").orderBy("often", "key"))
    first = join_hubs(keys, counts, "key", keys.count()).withColumn("place", place)
    return first.filter(F.col("place") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1).drop("often").distinct()


def _crowds(first: DataFrame, shared: DataFrame, scratch: Scratch) -> DataFrame:
    """node, crowd, size, asks: the sets of documents that hang together by shingles with over ASKERS askers."""
    often = shared.filter(F.col("asked") > ASKERS).select("key", "least", "n")
    ties = join_hubs(first, often, "key", first.count()).filter("node <> least")
    found = components(ties.select(F.col("node").alias("a"), F.col("least").alias("b")), scratch).withColumnRenamed("component", "crowd")
    return scratch.put(found.join(first.select("node", "size", "asks").distinct(), "node"))


def _rare(first: DataFrame, shared: DataFrame, crowds: DataFrame, percent: int) -> DataFrame:
    """a, b, size: pairs of a document that asks and another one that may be linked, but for those of one crowd.

    A pair goes on if what it can still share after a common shingle is enough.
    """
    few = shared.filter(F.col("asked").between(1, ASKERS) & (F.col("n") > 1)).select("key")
    first = first.join(few, "key").join(crowds.select("node", "crowd"), "node", "left")
    a, b = (first.select("key", *[F.col(c).alias(f"{x}_{c}") for c in ("node", "size", "asks", "place", "crowd")]) for x in "ab")
    common = F.least("a_place", "b_place") + F.least(F.expr("a_size - a_place"), F.expr("b_size - b_place"))
    enough = 100 * common >= percent * (F.col("a_size") + F.col("b_size") - common)
    once = F.when(F.col("b_asks"), F.col("a_node") < F.col("b_node")).otherwise(F.col("a_node") != F.col("b_node"))
    apart = F.coalesce(F.col("a_crowd") != F.col("b_crowd"), F.lit(True))
    return a.filter("a_asks").join(b, "key").filter(once & enough & apart).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), F.col("b_size").alias("size")).distinct()


def _dealt(crowds: DataFrame) -> DataFrame:
    """node, crowd, k1, k2, asker, met: each crowd's blocks of askers with each of its blocks of documents; small crowds share a bin."""
    cut = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_SHINGLES), F.lit(1)).cast("int")
    sizes = crowds.groupBy("crowd").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.count_if("asks").alias("an"), F.sum(F.when(F.col("asks"), F.col("size")).otherwise(0)).alias("asize"))
    total = sizes.agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect()[0]
    bins = max(1, -(-(total["n"] or 0) // BIN), -(-(total["size"] or 0) // BIN_SHINGLES))
    placed = crowds.join(sizes.select("crowd", cut(F.col("n"), F.col("size")).alias("there"), cut(F.col("an"), F.col("asize")).alias("here")), "crowd")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    met = placed.select("node", "crowd", "here", "there", every("here").alias("i"), own("there", 5).alias("j"), F.lit(False).alias("asker"))
    asking = placed.filter("asks").select("node", "crowd", "here", "there", own("here", 6).alias("i"), every("there").alias("j"), F.lit(True).alias("asker"))
    small = F.col("here") * F.col("there") == 1
    k1 = F.when(small, F.pmod(F.xxhash64("crowd"), F.lit(bins))).otherwise(F.col("crowd"))
    k2 = F.when(small, F.lit(-1).cast("long")).otherwise(F.col("i").cast("long") * F.col("there") + F.col("j"))
    return met.unionByName(asking).select("node", "crowd", k1.alias("k1"), k2.alias("k2"), "asker")


def _meet(shingle: int, percent: int):
    """Askers of crowds with the documents that they meet. A document that does both is there twice."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        asker = t.column("asker").to_numpy(zero_copy_only=False).astype(bool)
        node = t.column("node").to_numpy()
        asks, here = node[asker], node[~asker]
        g = Group(t, shingle)
        asks, here = np.isin(g.ids, asks), np.isin(g.ids, here)
        crowd = t.column("crowd").to_numpy()[g.at]
        order = np.argsort(crowd, kind="stable")
        edges: list[tuple[int, int]] = []
        for part in np.split(order, np.flatnonzero(np.diff(crowd[order])) + 1):
            edges += g.join(part[asks[part]], part[here[part]], percent)
        give_back()
        return _rows(g, edges, np.zeros(0, np.int64))

    return run


def _ask(shingle: int, percent: int):
    """Documents, each with the one that asks for it, or with none if it asks itself."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        asked = t.select(["node", "asker"]).filter(pc.is_valid(t.column("asker"))).sort_by([("asker", "ascending"), ("node", "ascending")])
        g = Group(t, shingle, sketched=False)
        at = {x: i for i, x in enumerate(g.ids.tolist())}
        edges = []
        for x, y in zip(asked.column("asker").to_pylist(), asked.column("node").to_pylist(), strict=True):
            i, j = at.get(x), at.get(y)
            if i is not None and j is not None and (ri := g.root(i)) != (rj := g.root(j)) and g.linked(i, j, percent):
                g.parent[max(ri, rj)] = min(ri, rj)
                edges.append((i, j))
        give_back()
        return _rows(g, edges, np.zeros(0, np.int64))

    return run


def near(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash (xxhash64) and kept of each row of documents (doc_id, text)."""
    spark = documents.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    docs = pick(documents, doc_id="long", text="string")
    sketched = scratch.put(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sketch(shingle), SKETCHES))
    named = sketched.filter("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("size"))

    # the bands of each class's smallest document; equal sets have equal bands
    banded = named.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    banded = scratch.put(banded.select("node", F.explode("bands").alias("band")))
    buckets = banded.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("most"), F.count("*").alias("n"))
    buckets = buckets.filter("pivot < most").drop("most")
    ties = join_hubs(banded, buckets, "band", banded.count()).filter("node <> pivot")
    groups = scratch.put(components(ties.select(F.col("node").alias("a"), F.col("pivot").alias("b")), scratch).withColumnRenamed("component", "grp"))

    # blocks: one for a group of at most BLOCK documents with BLOCK_SHINGLES shingles
    placed = groups.join(classes, "node")
    sizes = placed.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    large = sizes.filter("blocks > 1")
    block = F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")), F.lit(0)).cast("int")
    placed = placed.join(large, "grp", "left").select("node", "grp", "size", F.coalesce("blocks", F.lit(1)).alias("blocks"), block.alias("block"), "fp1")
    texts = docs.filter("doc_id is not null").mapInArrow(_compress, "doc_id long, packed binary")
    what = ["node", "grp", "size", "blocks", "block", "fp1", "packed"]
    members = scratch.put(placed.join(texts, F.col("node") == F.col("doc_id")).select(*what))

    drawn = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks") * (BLOCK // PIVOTS)) == 0
    drawn = F.slice(F.array_sort(F.collect_set(F.when(drawn, F.col("node")))), 1, PIVOTS)
    many = members.filter("blocks > 1").drop("size")
    drawn = many.groupBy("grp").agg(F.array_union(F.array(F.min("node")), drawn).alias("p")).select("grp", F.explode("p").alias("node"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pivots = many.join(drawn, ["grp", "node"]).select("node", "grp", every("blocks").alias("block"), "fp1", "packed").withColumn("pivot", F.lit(True))
    alone = members.select("node", "grp", "block", "fp1", "packed", "blocks").withColumn("pivot", F.lit(False))
    total = members.agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()[0]
    bins = max(1, -(-total["n"] // BIN), -(-(total["size"] or 0) // BIN_SHINGLES))
    both = pivots.withColumn("blocks", F.lit(2)).unionByName(alone)
    small = F.col("blocks") == 1
    both = both.withColumn("k1", F.when(small, F.pmod(F.xxhash64("grp"), F.lit(bins))).otherwise(F.col("grp")))
    both = both.withColumn("k2", F.when(small, F.lit(-1)).otherwise(F.col("block"))).drop("blocks", "block")
    found = scratch.put(both.groupBy("k1", "k2").applyInArrow(_solve(shingle, percent), EDGES))

    # what no pivot ties asks its group
    loose = found.filter("loose is not null").select(F.col("loose").alias("node")).distinct().withColumn("asks", F.lit(True))
    here = many.select("node", "grp", "fp1", "packed").join(loose, "node", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    here = here.join(many.join(loose, "node").select("grp").distinct(), "grp")
    first = scratch.put(_prefixes(scratch.put(here.select("node", "grp", "fp1", "packed", "asks").mapInArrow(_keys(shingle), KEYS)), percent))
    shared = first.groupBy("key").agg(F.count_if("asks").alias("asked"), F.min("node").alias("least"), F.count("*").alias("n"))
    crowds = _crowds(first, shared, scratch)
    pairs = scratch.put(_rare(first, shared, crowds, percent))
    total = pairs.agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()[0]
    bins = max(1, -(-total["n"] // BLOCK), -(-(total["size"] or 0) // BIN_SHINGLES))
    askers = pairs.select(F.col("a").alias("node"), F.lit(None).cast("long").alias("asker")).distinct()
    both = pairs.select(F.col("b").alias("node"), F.col("a").alias("asker")).unionByName(askers).join(many.select("node", "fp1", "packed"), "node")
    met = both.groupBy(F.pmod(F.xxhash64(F.coalesce("asker", "node")), F.lit(bins)).alias("bin")).applyInArrow(_ask(shingle, percent), EDGES)
    crowded = _dealt(crowds).join(many.select("node", "fp1", "packed"), "node").groupBy("k1", "k2").applyInArrow(_meet(shingle, percent), EDGES)

    links = found.filter("a is not null").select("a", "b").unionByName(met.select("a", "b")).unionByName(crowded.select("a", "b"))
    labels = components(links, scratch).select("node", F.col("component").alias("c"))
    known = scratch.put(classes.join(labels, "node", "left").select("fp1", "fp2", F.coalesce("c", "node").alias("c")))  # a table, so that Spark can split the rows of a large class
    has_set = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    out = (
        sketched.select("doc_id", "text_hash", "n_shingles", F.when(has_set, F.col("fp1")).alias("fp1"), "fp2")
        .join(known, ["fp1", "fp2"], "left")
        .select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"), "text_hash")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
    out = written(out)
    scratch.clear()
    return out


def keep_one(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, that are the smallest of their group."""
    one, two = (fresh(c, documents.columns) for c in ("of_doc", "of_text"))
    gone = near(documents, shingle, percent).filter("not kept").select(F.col("doc_id").alias(one), F.col("text_hash").alias(two)).distinct()
    here = (documents["doc_id"].cast("long") == F.col(one)) & (F.xxhash64(documents["text"].cast("string")) == F.col(two))
    return documents.join(gone, here, "left_anti")
