"""Substring dedup by difference-cover anchors.

A word is removed if a window of WINDOW words over it also starts in a document
with a smaller doc_id. Windows are judged on the input.

{1, 2, 4} is a difference cover modulo PERIOD = 7: for any two places i and j
some k < 7 has (i + k) % 7 and (j + k) % 7 both in the cover. So two equal
windows of 13 words share an anchor, 7 words at a cover position, that begins
at the same k in both. Only anchors are hashed and compared first (3 of 7
positions), to so many bits that about one in 2**SPARE_BITS meets another one by
chance, which costs work only; where an anchor occurs in another document, the match is extended:
the windows around it are compared by 96 bits from two independent word hashes.

Documents are dealt to segments of about SEGMENT_BYTES by a hash of their
content. A segment sends each of its anchors and windows once, as a row of its
own, however often it holds it, so that a passage in a third of all documents
makes a row per segment, and rows grow with the input only. Window functions of
Spark, which spill, tell the keys that count; these return to the segments that
sent them. They are keys, not places, so recomputed tasks may see rows in any
order.

Null texts have no words. Rows with a null doc_id, and documents of fewer than
WINDOW words, neither lose words nor remove any. Rows that repeat a doc_id are
the same document for this purpose and don't remove each other's words; they are
dealt to segments by their places in the input, so that input should be a table
in files: a task that is repeated must see its rows in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from panelforge.llm.common import SPACE_WORDS, Words, buffers, fresh, give_back, slim, small_batches

WINDOW = 13
PERIOD = 7
ANCHOR = 7
COVER = (1, 2, 4)
SEGMENT_BYTES = 1 << 21
SPARE_BITS = 8

_U = np.uint64


@slim
def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for b in batches:
        data, offsets = buffers(b.column("text"))
        at = offsets.tolist()
        texts = [pack.compress(data[lo:hi].tobytes()) if hi > lo else b"" for lo, hi in zip(at[:-1], at[1:], strict=True)]
        others = [n for n in b.schema.names if n not in ("seg", "doc_id", "text")]
        yield pa.RecordBatch.from_arrays([b.column("seg"), b.column("doc_id"), pa.array(texts, pa.binary()), *[b.column(n) for n in others]], names=["seg", "doc_id", "packed", *others])


class Segment:
    """The words of a segment's documents, and 64-bit hashes of the words."""

    def __init__(self, t: pa.Table):
        unpack = zstandard.ZstdDecompressor()
        texts = [unpack.decompress(x) if x else b"" for x in t.column("packed").to_pylist()]
        lengths = np.array([len(x) for x in texts], dtype=np.int64)
        self.words = Words(np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), SPACE_WORDS)
        ids = t.column("doc_id")
        self.named = ids.is_valid().to_numpy(zero_copy_only=False) if not isinstance(ids, pa.ChunkedArray) else ids.is_valid().combine_chunks().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.hashes = self.words.hashes()

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """First words of the anchors of documents that have a window, and their hashes."""
        at, keys = self.words.windows(self.hashes, ANCHOR, seed=7)
        owner = self.words.owner[at]
        place = (at - self.words.first[owner]) % PERIOD
        keep = np.isin(place, COVER) & (self.words.counts[owner] >= WINDOW) & self.named[owner]
        return at[keep], keys[keep]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of all windows, and their hashes of 64 and 32 bits."""
        at, keys = self.words.windows(self.hashes, WINDOW, seed=11)
        _, more = self.words.windows(self.words.hashes(1), WINDOW, seed=13)
        keep = self.named[self.words.owner[at]]
        return at[keep], keys[keep], (more[keep] >> _U(32)).astype(np.uint32)


ANCHORS = "key long, seg int, local boolean"
WINDOWS = "key long, more int, seg int, id long"


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.table({n: pa.array([], kinds[t]) for n, t in (c.split() for c in schema.split(", "))})


def _unique(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, with the smallest and the largest id of each."""
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return keys, ids, ids
    return keys[first], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)


def _bits(text_bytes: int) -> int:
    """Bits of an anchor's hash for so much text, which has an anchor in 14 / 3 bytes at most."""
    return min(64, (text_bytes * 3 // 14).bit_length() + SPARE_BITS)


def _send_anchors(bits: int):
    """Each anchor of a segment once, and whether two of its documents have it."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        s = Segment(t)
        at, keys = s.anchors()
        keys, low, high = _unique(keys >> _U(64 - bits), s.ids[s.words.owner[at]])
        give_back()
        return pa.table({"key": pa.array(keys.view(np.int64)), "seg": pa.array(np.full(len(keys), key[0].as_py(), np.int32)), "local": pa.array(low < high)})

    return run


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray | None]:
    keys = answers.column("key").to_numpy().view(np.uint64)
    return keys, answers.column("more").to_numpy().view(np.uint32) if "more" in answers.column_names else None


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    known = np.sort(known)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _among_both(keys: np.ndarray, more: np.ndarray, known: np.ndarray, known_more: np.ndarray) -> np.ndarray:
    """Where (keys, more) is one of the known pairs."""
    out = np.zeros(len(keys), dtype=bool)
    at = np.flatnonzero(_among(keys, known))
    number = np.unique(np.concatenate([keys[at], known]), return_inverse=True)[1].astype(np.uint64) << _U(32)
    out[at] = _among(number[: len(at)] | more[at], number[len(at) :] | known_more)
    return out


def _send_windows(bits: int):
    """Extends the shared anchors: each window over one, once, with its smallest document."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows or not answers.num_rows:
            return _empty(WINDOWS)
        s = Segment(t)
        at, keys = s.anchors()
        hit = at[_among(keys >> _U(64 - bits), _told(answers)[0])]
        near = np.zeros(len(s.words) + 1, dtype=bool)
        for k in range(PERIOD):
            near[np.maximum(hit - k, 0)] = True
        at, keys, more = s.windows()
        keep = near[at]
        keys, more, ids = keys[keep], more[keep], s.ids[s.words.owner[at[keep]]]
        order = np.lexsort((ids, more, keys))
        keys, more, ids = keys[order], more[order], ids[order]
        first = _firsts(keys, more)
        order = np.flatnonzero(first)[np.argsort(ids[first], kind="stable")]  # runs of one document, which compress
        keys, more, ids = keys[order], more[order], ids[order]
        give_back()
        seg = np.full(len(keys), t.column("seg")[0].as_py(), np.int32)
        return pa.table({"key": pa.array(keys.view(np.int64)), "more": pa.array(more.view(np.int32)), "seg": pa.array(seg), "id": pa.array(ids)})

    return run


def _firsts(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])
    return first


RESULT = "doc_id long, n_words long, n_removed long, kept binary"


def _joined(s: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words, a space after each, and where each document's begin."""
    starts, sizes = s.starts[keep], (s.ends - s.starts)[keep]
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(int(begins[-1]), 32, dtype=np.uint8)
    to = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
    shift = np.repeat(starts - begins[:-1], sizes)
    out[to] = s.data[to + shift]
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    return out, begins[kept_before[s.first]]


def _remove(digest: bool, carried: list[str]):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table, answers: pa.Table) -> pa.Table:
        s = Segment(t)
        at, keys, more = s.windows()
        ids = s.ids[s.words.owner[at]]
        gone = _among_both(keys, more, *_told(answers)) if answers.num_rows else np.zeros(len(at), dtype=bool)
        order = np.lexsort((ids, more, keys))
        k, m, i = keys[order], more[order], ids[order]
        if len(k):
            first = _firsts(k, m)
            gone[order] |= i[np.flatnonzero(first)][np.cumsum(first) - 1] < i
        cover = np.zeros(len(s.words) + WINDOW + 1, dtype=np.int64)
        np.add.at(cover, at[gone], 1)
        np.add.at(cover, at[gone] + WINDOW, -1)
        keep = np.cumsum(cover)[: len(s.words)] == 0
        out, where = _joined(s.words, keep)
        raw, cuts = out.tobytes(), where.tolist()
        texts = [raw[lo : max(lo, hi - 1)] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
        left = np.concatenate([[0], np.cumsum(keep)])[s.words.first]
        removed = s.words.counts - np.diff(left)
        kept = pa.array([hashlib.sha256(x).digest() for x in texts] if digest else texts, pa.binary())
        del out, raw, texts
        give_back()
        return pa.table({"doc_id": t.column("doc_id"), "n_words": pa.array(s.words.counts.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "kept": kept} | {n: t.column(n) for n in carried})

    return run


def deduplicate(documents: DataFrame, digest: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (digest: kept_sha256, its lowercase hex digest) of each row of documents (doc_id, text).

    carry: columns that come along unchanged.
    """
    spark = documents.sparkSession
    small_batches(spark)
    columns = {f"c{i}": documents[f"`{c}`"] for i, c in enumerate(carry)}
    docs = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text"), *[c.alias(n) for n, c in columns.items()])
    kinds = StructType(docs.schema.fields[2:])
    total = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()[0]
    least = min(total["n"] // 64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    segments = max(1, -(-(total["b"] or 0) // SEGMENT_BYTES), least)
    # rows that repeat a document are dealt by their places in the scan too, which decide about nothing else
    place = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    dealt = docs.withColumn("seg", F.pmod(F.xxhash64("doc_id", "text", place), F.lit(segments)).cast("int"))
    dealt = dealt.mapInArrow(_compress, _schema("seg int, doc_id long, packed binary", kinds))
    whole = dealt.groupBy("seg")
    bits = _bits(total["b"] or 0)
    anchors = whole.applyInArrow(_send_anchors(bits), ANCHORS)
    of_key = Window.partitionBy("key")
    shared = anchors.withColumn("others", F.min("seg").over(of_key) < F.max("seg").over(of_key))
    shared = shared.filter("others or local")
    windows = whole.cogroup(shared.select("key", "seg").groupBy("seg")).applyInArrow(_send_windows(bits), WINDOWS)
    earlier = windows.withColumn("least", F.min("id").over(Window.partitionBy("key", "more"))).filter("least < id")
    removed = whole.cogroup(earlier.select("key", "more", "seg").groupBy("seg"))
    out = removed.applyInArrow(_remove(digest, list(columns)), _schema(RESULT, kinds))
    kept = F.lower(F.hex("kept")).alias("kept_sha256") if digest else F.col("kept").cast("string").alias("kept_text")
    return out.select("doc_id", "n_words", "n_removed", kept, *[F.col(n).alias(c) for n, c in zip(columns, carry, strict=True)])


def _schema(own: str, carried: StructType) -> StructType:
    return StructType([*StructType.fromDDL(own).fields, *[StructField(f.name, f.dataType) for f in carried.fields]])


def rewrite(documents: DataFrame) -> DataFrame:
    """The documents with all their columns, without the words that go; n_chars follows, texts that lose nothing stay as they are."""
    columns = documents.columns
    done = deduplicate(documents, carry=tuple(columns))
    own = [fresh(c, columns) for c in ("id_", "words_", "removed_", "kept_")]
    done = done.toDF(*own, *columns)
    gone, kept = F.col(own[2]) > 0, F.col(own[3])
    out = {c: F.col(f"`{c}`") for c in columns}
    out["text"] = F.when(gone, kept).otherwise(F.col("text"))
    if "n_chars" in out:
        out["n_chars"] = F.when(gone, F.length(kept)).otherwise(F.col("n_chars")).cast(dict(documents.dtypes)["n_chars"])
    return done.select(*[x.alias(c) for c, x in out.items()])
