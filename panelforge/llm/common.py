"""Shared pieces: whole-batch word segmentation and hashing, shared folders, sizing.

Texts are handled as Arrow buffers: word boundaries, word hashes and window
hashes of all texts of a slice come from a few numpy passes, with no loop over
words. Slices hold at most SLICE_BYTES of text (one longer text is a slice of
its own), so a worker's memory does not depend on the batch size.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.tables import dropped, freed_shuffles, shared_dir, until_exit

SLICE_BYTES = 1 << 20
#: Bytes of a word beyond which BLAKE2b takes over from the loop over eight bytes at a time.
LONG_WORD = 64

_U = np.uint64
_MASKS = np.array([(1 << (8 * r)) - 1 for r in range(9)], dtype=np.uint64)
_ODD = _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit integers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _table(separators: list[tuple[int, int]]) -> np.ndarray:
    lut = np.ones(256, dtype=bool)
    for lo, hi in separators:
        lut[lo : hi + 1] = False
    return lut


#: Bytes of words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in UTF-8.
SPACE_WORDS = _table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM_WORDS = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range, the same in every process; other seeds give independent hashes.

    Eight bytes at a time are mixed in; each step is a bijection, so that ranges
    of one length up to 8 never collide. No sum over the bytes is involved, which
    texts with a regular structure could bring to collide.
    """
    sizes = ends - starts
    out = mix64(sizes.astype(np.uint64) * _ODD + mix64(np.array([seed], dtype=np.uint64)))
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))
    at, rest = starts[left], sizes[left]
    whole = len(left) == len(out)
    while len(left):
        chunk = eights[at] & _MASKS[np.minimum(rest, 8)]
        if whole:
            out = mix64(out ^ chunk)
        else:
            out[left] = mix64(out[left] ^ chunk)
        more = rest > 8
        left, at, rest, whole = left[more], at[more] + 8, rest[more] - 8, False
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


class Words:
    """Words of the texts of one slice.

    starts, ends: byte ranges in data; first: index of each text's first word,
    with the number of words at its end; owner: each word's text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        word = table[self.data]
        edges = np.zeros(len(word) + 1, dtype=bool)
        edges[offsets] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | edges[1:-1]
        finish = word.copy()
        finish[:-1] &= ~word[1:] | edges[1:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.data, self.starts, self.ends, seed)

    def windows(self, hashes: np.ndarray, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of so many words within one text, and their hashes.

        Hashes of 1, 2, 4, ... words are mixed from two halves each; the last step
        takes two runs that overlap, unless size is a power of two.
        """
        n = len(hashes)
        if n < size:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        value, span = hashes, 1
        while span < size:
            step = min(span, size - span)
            value = mix64(value[: len(value) - step] * _ODD + value[step:])
            span += step
        at = np.flatnonzero(self.owner[: n - size + 1] == self.owner[size - 1 :])
        return at, mix64(value[at] + mix64(np.array([seed], dtype=np.uint64)))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The texts from lo to hi of the column, with their bytes and offsets, in runs of bounded size."""
    data, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = path or shared_dir(spark)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(until_exit(path, spark))


class Scratch:
    """Tables in the shared folder that are needed until clear() only."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def put(self, df: DataFrame) -> DataFrame:
        self.paths.append(shared_dir(self.spark))
        return written(df, self.paths[-1])

    def clear(self) -> None:
        while self.paths:
            dropped(self.paths.pop(), self.spark)


#: What a worker keeps from task to task, until a task of another kind runs in it.
KEPT: dict[str, object] = {}

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library
    _LIBC = None


def give_back() -> None:
    """Returns memory that the worker has freed to the system, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slim(run, keep: bool = False):
    """For mapInArrow: run, and at the end of each task give_back()."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            KEPT.clear()
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no column of the input has, in any case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast; other columns of the input never reach an operator."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def small_batches(spark: SparkSession) -> None:
    """Bounds what goes to a Python worker at once by bytes, whatever the rows' length; the session keeps that."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
