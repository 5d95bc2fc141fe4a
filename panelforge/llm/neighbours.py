"""Nearest neighbours by inner product: a block matrix join on int8 tiles.

Vectors are quantised to int8 with a scale each, |x - s*q| <= s/2 per component.
For a tile of queries and candidates the int8 products give approximate scores,
and |a.b - sa*sb*(qa.qb)| <= sa/2*|b|_1 + sb/2*|a|_1 + sa*sb*d/4 bounds their
error. A candidate survives if its upper bound reaches the k-th best lower bound
of its query in the tile; survivors are computed again in double precision, the
products summed in order of the components. The tiles' best k are merged by a
heap per query. So the result is exact, and only the work is pruned.

Blocks travel in the vectors' own type (float: 4 bytes a component), not as int8
alone: survivors are computed in the tile. Were they looked up afterwards, groups
of nearly equal vectors would have to be emitted as pairs. Equal vectors are one
candidate that carries its k + 1 smallest ids; no query can need others.

Ties go to the smaller vec_id. Vectors that are null, zero or hold null or
non-finite components take no part. A query meets the vectors of its own length.
Rows that repeat a vec_id are candidates each; a query is never its own
candidate, by id. The rows of a query's id are one query, with the smallest vector
of these.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from panelforge.llm.common import mix64, slim, small_batches

#: Bytes of vectors in a block of queries and of candidates, and in a candidates' column of the grid.
QUERY_BYTES, CANDIDATE_BYTES, GROUP_BYTES = 8 << 20, 1 << 20, 8 << 20
#: Queries of a tile that are compared at once, and whose best candidates a task holds.
ROWS, HELD_QUERIES = 256, 1 << 16
#: int8 products of so many components are exact as sums of 32-bit floats: 1024 * 127**2 < 2**24.
EXACT_PRODUCTS = 1024
BLOCK = "g int, dim int, ids binary, counts binary, rows binary"
TOP_SCHEMA = "query_id long, vec_id long, score double"
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding, as floats or else as doubles, of the vectors that take part."""
    kind = vectors.schema["embedding"].dataType
    to = "array<float>" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "array<double>"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(to).alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine & F.exists("embedding", lambda x: x != 0))


def _pack(size: int, groups: int):
    """Rows to blocks of about so many bytes of vectors of one length and group.

    A group is a hash of the first id. A task holds less than one block of each
    group, twice size in all, before it hands blocks on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        total = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (g, dim), parts in held.items():
                ids, counts, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
                ends, step = np.cumsum(counts), max(1, size // rows[0].nbytes)
                for lo in range(0, len(rows), step):
                    hi = min(lo + step, len(rows))
                    own = ids[ends[lo] - counts[lo] : ends[hi - 1]]
                    values = [pa.array([x.tobytes()], pa.binary()) for x in (own, counts[lo:hi], rows[lo:hi])]
                    yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([dim], pa.int32()), *values], names=["g", "dim", "ids", "counts", "rows"])
            held.clear()

        for b in batches:
            vectors, lists = b.column("embedding"), b.column("ids")
            dims, counts = (x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (vectors, lists))
            flat, ids = (x.flatten().to_numpy(zero_copy_only=False) for x in (vectors, lists))
            begins, first = np.cumsum(dims) - dims, np.cumsum(counts) - counts
            of = (mix64(ids[first].astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
            for g, dim in np.unique(np.column_stack([of, dims]), axis=0).tolist():
                at = np.flatnonzero((of == g) & (dims == dim))
                n = counts[at]
                inner = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                rows = flat[begins[at][:, None] + np.arange(dim)]
                held.setdefault((g, dim), []).append((ids[inner], n, rows))
                total += rows.nbytes
            if total >= 2 * size:
                yield from out()
                total = 0
        yield from out()

    return slim(run)


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 codes and each vector's scale."""
    scale = np.abs(rows).max(axis=1) / 127.0
    scale[scale == 0] = np.finfo(np.float64).tiny
    return np.clip(np.rint(rows / scale[:, None]), -127, 127).astype(np.int8), scale


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class Candidates:
    """A block of distinct vectors, each with its smallest ids in order."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, rows: np.ndarray):
        self.ids, self.counts, self.rows = ids, counts, rows.astype(np.float64)
        self.first = np.cumsum(counts) - counts
        codes, self.scale = quantise(self.rows)
        self.codes = codes.T.astype(np.float32)
        self.norm = np.abs(self.rows).sum(axis=1)

    def best(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query index, id and score of the best k rows for each query."""
        dim = q.shape[1]
        codes, scale = quantise(q)
        approx = np.zeros((len(q), len(self.rows)))
        for lo in range(0, dim, EXACT_PRODUCTS):
            cut = slice(lo, lo + EXACT_PRODUCTS)
            approx += codes[:, cut].astype(np.float32) @ self.codes[cut]
        scales = scale[:, None] * self.scale[None, :]
        approx *= scales
        slack = scale[:, None] / 2 * self.norm[None, :] + self.scale[None, :] / 2 * np.abs(q).sum(axis=1)[:, None] + scales * (dim / 4)
        slack = slack * (1 + 1e-9) + np.abs(approx) * 1e-12 + 1e-300
        low = approx - slack
        only = self.counts == 1
        own = (q_ids[:, None] == np.where(only, self.ids[self.first], 0)[None, :]) & only[None, :]  # no other row has that vector
        low[own] = -np.inf
        if len(self.rows) > k:
            kth = np.partition(low, len(self.rows) - k, axis=1)[:, len(self.rows) - k]
        else:
            kth = np.full(len(q), -np.inf)
        qi, ci = np.nonzero((approx + slack >= kth[:, None]) & ~own)
        score = np.empty(len(qi))
        for lo in range(0, len(qi), 1 << 15):
            s = slice(lo, lo + (1 << 15))
            score[s] = exact(q[qi[s]], self.rows[ci[s]])
        head = self.ids[self.first[ci]]
        mine = head == q_ids[qi]  # the smallest id but the query's own; there is another one
        head = np.where(mine, self.ids[np.minimum(self.first[ci] + 1, len(self.ids) - 1)], head)
        qi, ci, score = _ranked(qi, ci, score, head, k)
        n = self.counts[ci]
        at = np.repeat(self.first[ci] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        qi, score, ids = np.repeat(qi, n), np.repeat(score, n), self.ids[at]
        other = ids != q_ids[qi]
        return _ranked(qi[other], ids[other], score[other], ids[other], k)


def _ranked(qi: np.ndarray, what: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of each query, by score and then the smaller id."""
    order = np.lexsort((ids, -score, qi))
    qi, what, score = qi[order], what[order], score[order]
    best = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[best], what[best], score[best]


def _tiles(kind: type, k: int):
    """Tiles to the best k of each query over all tiles that the task sees, of at most HELD_QUERIES queries at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # by the ids of a block of queries

        def out() -> Iterator[pa.RecordBatch]:
            for key, (qi, ids, score) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(key, np.int64)[qi]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])
            held.clear()

        for b in batches:
            for at in range(b.num_rows):
                value = lambda c: b.column(c)[at].as_buffer()  # noqa: E731,B023
                dim = b.column("dim")[at].as_py()
                block = Candidates(np.frombuffer(value("ids"), np.int64), np.frombuffer(value("counts"), np.int64), np.frombuffer(value("rows"), kind).reshape(-1, dim))
                key = value("q_ids").to_pybytes()
                q_ids, q = np.frombuffer(key, np.int64), np.frombuffer(value("q_rows"), kind).reshape(-1, dim)
                if key not in held and 8 * HELD_QUERIES < len(key) + sum(map(len, held)):
                    yield from out()
                parts = [held[key]] if key in held else []
                for lo in range(0, len(q_ids), ROWS):  # the tile's matrices stay small
                    qi, ids, score = block.best(q_ids[lo : lo + ROWS], q[lo : lo + ROWS].astype(np.float64), k)
                    parts.append((lo + qi, ids, score))
                qi, ids, score = (np.concatenate(x) for x in zip(*parts, strict=True))
                held[key] = _ranked(qi, ids, score, ids, k)
        yield from out()

    return slim(run)


def _merge(k: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        best = heapq.nsmallest(k, zip((-t.column("score").to_numpy()).tolist(), t.column("vec_id").to_pylist(), strict=True))
        n = len(best)
        return pa.table({"query_id": pa.array([key[0].as_py()] * n, pa.int64()), "rank": pa.array(range(1, n + 1), pa.int32()), "vec_id": pa.array([v for _, v in best], pa.int64()), "score": pa.array([-s for s, _ in best], pa.float64())})

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest of each query among all vectors.

    Queries form groups i of about QUERY_BYTES and candidates groups j of about
    GROUP_BYTES; the cells (i, j) of that grid are joined on (i, j), a block at a
    time, so that no row is ever paired with a row outside a tile. Candidates are
    copied once per group of queries.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    vectors, queries = usable(vectors), usable(queries)
    single = all("float" in dict(df.dtypes)["embedding"] for df in (vectors, queries))
    if not single:
        vectors, queries = (df.withColumn("embedding", F.col("embedding").cast("array<double>")) for df in (vectors, queries))
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    width = 4 if single else 8
    size = F.coalesce(F.sum(F.size("embedding")), F.lit(0)) * width
    asked, had = (df.agg(size.alias("b"), F.count("*").alias("n")).collect()[0] for df in (queries, vectors))
    across = -(-asked["b"] // QUERY_BYTES) or 1
    down = max(-(-had["b"] // GROUP_BYTES), min(had["n"] // 256 + 1, spark.sparkContext.defaultParallelism))
    # the k + 1 smallest ids of each vector; Spark limits them before the shuffle too
    vectors = vectors.withColumn("h", F.xxhash64("embedding"))
    same = Window.partitionBy("h", "embedding").orderBy("vec_id")
    vectors = vectors.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1)
    vectors = vectors.groupBy("h", "embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("ids", "embedding")
    queries = queries.select(F.array("vec_id").alias("ids"), "embedding")
    each = lambda most: F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    q = queries.mapInArrow(_pack(QUERY_BYTES, across), BLOCK).select("dim", F.col("g").alias("i"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), each(down).alias("j"))
    c = vectors.mapInArrow(_pack(CANDIDATE_BYTES, down), BLOCK).select("dim", F.col("g").alias("j"), "ids", "counts", "rows", each(across).alias("i"))
    best = c.join(q, ["dim", "i", "j"]).mapInArrow(_tiles(np.float32 if single else np.float64, k), TOP_SCHEMA)
    return best.groupBy("query_id").applyInArrow(_merge(k), RESULT)
