"""Packing of documents into sequences by the sum-of-squares rule.

A document's ids are followed by an end id; longer ones are cut into pieces of
the capacity. Pieces that fill a sequence stand alone. The others are dealt to
groups of about GROUP_PIECES by a hash, and each group packs its pieces from the
longest to the shortest: a piece goes where the sum over all gaps of the squared
number of open sequences with that gap becomes smallest (ties: the smallest
gap). Opening a sequence is one of the choices, taken only if no open one fits:
few sequences are asked for, and a sequence costs more than an uneven profile.
Each group wastes at most a sequence's worth or so, whatever the input's size.

Null texts are empty; an empty text is the end id alone. Repeated rows are
packed each. No rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import pick, slim, small_batches, written
from panelforge.llm.tokens import default_path, encoded, encoder

CAPACITY = 4096
GROUP_PIECES = 1 << 14
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
PACKED = PIECES + ", sequence_id long, offset long"
PIECE_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        uid = TaskContext.get().partitionId() << 33
        for b in batches:
            ids = b.column("doc_id")
            for lo, flat, begins in encoded(b, enc):
                flat, size = flat.astype("<u4"), np.diff(begins)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, size[row] - start)
                at = (begins[row] + start).tolist()
                crc = [zlib.crc32(flat[i : i + n]) for i, n in zip(at, length.tolist(), strict=True)]
                columns = [ids.take(pa.array(lo + row)), piece.astype(np.int32), start, length, np.array(crc, dtype=np.int64), uid + np.arange(len(row))]
                uid += len(row)
                yield pa.RecordBatch.from_arrays([columns[0], *map(pa.array, columns[1:])], names=PIECE_NAMES)

    return slim(run, keep=True)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, which come from the longest to the shortest; and the number of bins."""
    n = len(lengths)
    bins, offsets = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap; a full one is not open
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # N(g) falls and N(g - size) rises by one: the sum of squares changes by 2 (N(g - size) - N(g)) + 2
        here = count[size:]
        change = count[: capacity + 1 - size] - here
        fits = np.flatnonzero(here)
        if len(fits):
            gap = int(fits[np.argmin(change[fits])]) + size
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - gap
        left = gap - size
        if left:
            open_bins[left].append(b)
            count[left] += 1
    return bins, offsets, made


def _pack(capacity: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        group = key[0].as_py()
        t = t.sort_by([("length", "descending"), ("uid", "ascending")]).drop_columns(["packed_in"])
        bins, offsets, _ = sum_of_squares(t.column("length").to_numpy(), capacity)
        return t.append_column("sequence_id", pa.array((np.int64(group + 1) << 32) + bins)).append_column("offset", pa.array(offsets))

    return run


def pack(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of documents (doc_id, text): its place, the crc32 of its ids, its sequence and the offset there.

    The ids are computed once and written, lengths and checksums only, to the
    shared folder; the texts are never shuffled.
    """
    small_batches(documents.sparkSession)
    docs = pick(documents, doc_id="long", text="string")
    pieces = written(docs.mapInArrow(_cut(tokenizer or default_path(), capacity), PIECES))
    full = pieces.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    dealt = rest.withColumn("packed_in", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int"))
    return full.unionByName(dealt.groupBy("packed_in").applyInArrow(_pack(capacity), PACKED)).drop("uid")
