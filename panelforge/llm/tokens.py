"""Token ids: exact ids of a public tokenizer, and training-order materialisation.

Encoder: a text's ids are those of its runs between ASCII white space, one after
the other: the tokenizer's normaliser and pre-tokenizer never join across white
space. Where they also part letters from signs and fold ASCII case, which is
tried out on some strings, signs at the end of a run are a run of their own, and
case is folded first. Runs repeat, so each is encoded once per task and its ids
are found again by a 64-bit hash, for all runs of a slice at once (at most
CACHE_RUNS are kept; the memory is bounded, the ids are not affected).

materialise(): documents are dealt to groups of about GROUP_BYTES of text by a
hash of doc_id and text, and lie in a group in order of doc_id and a hash of the
text. A group's ids, an end id after each document, are cut into sequences of
SEQUENCE ids; only its last one is padded. So sequences and their numbers follow
from the documents, not from how a cluster splits the scan. A keyed Feistel
permutation with cycle walking gives sequence i of n the slot p(i) in 0..n-1.
Slots are cut into ranges of SHARD_SLOTS, a partition each, and each partition
writes its range as one file, the shard, in records of fixed stride. Slot t is
read at byte (t % SHARD_SLOTS) * STRIDE of shard t // SHARD_SLOTS, and a reader
can stop and go on anywhere. Within the workers records travel in blocks of
BLOCK_SLOTS slots, so that no task holds a shard.

A record names its first and last document: the others are those of the group in
between, in the order above. Ids must fit 16 bits, else materialise() raises.
Null and empty texts give the end id alone; repeated rows are repeated
documents; a null doc_id is written as the smallest long. No rows: no shards.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import KEPT, SPACE_WORDS, Scratch, Words, freed_shuffles, give_back, mix64, pick, slices, slim, small_batches, span_hashes

END_ID = 1
CACHE_RUNS = 1 << 20
SEQUENCE = 512
SHARD_SLOTS = 1 << 14
BLOCK_SLOTS = 1 << 10
GROUP_BYTES = 1 << 24
#: Sequences of a row between the jobs.
ROW_SEQUENCES = 2048
NO_ID = -(2**63)
#: slot, first and last document, place in the first one, number of ids; then the ids; then a line feed.
HEADER = np.dtype([("slot", "<i8"), ("doc_id", "<i8"), ("last_doc_id", "<i8"), ("start", "<i8"), ("n_ids", "<i4")])
RECORD = np.dtype([("head", HEADER), ("ids", "<u2", (SEQUENCE,)), ("end", "u1")])
STRIDE = RECORD.itemsize

_U = np.uint64
#: ASCII signs but the apostrophe; and ASCII bytes but letters and digits.
_SIGN_BYTES = [x for x in range(33, 127) if not chr(x).isalnum() and chr(x) != "'"]
_SIGNS = np.isin(np.arange(256), _SIGN_BYTES)
_OTHER = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])
_MOST_SIGNS = 16
_WORDY = re.compile(r"\w")
#: Bytes as characters, as byte-level tokenizers have them: those that can't be seen get the characters from 256 on.
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174))}


class Encoder:
    """Ids of whole slices by the tokenizer in the file.

    Known runs stand in a table with open addressing, by their hashes: entry
    numbers, of which first and size tell where the ids are in ids.
    """

    def __init__(self, path: str, runs: int = 0):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.splits = self._splits()
        self.runs = runs or CACHE_RUNS
        self.clear()

    def _splits(self) -> bool:
        """Whether letters are lower-cased and stay together, and signs after them stand alone."""
        told = json.loads(self.tokenizer.to_str())
        if told["model"]["type"] != "BPE" or self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None:
            return False
        if any(not _WORDY.search(x["content"]) for x in told["added_tokens"]):
            return False  # one of signs only
        kinds = [x["type"] for x in (told["pre_tokenizer"].get("pretokenizers") or [told["pre_tokenizer"]])]
        if kinds[-1] != "ByteLevel" or told["pre_tokenizer"].get("pretokenizers", [{}])[-1].get("add_prefix_space"):
            return False
        letters, signs = "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, _SIGN_BYTES))
        if any(self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(x))[0][0] != chr(x).encode().decode("latin-1").translate(_BYTE_LETTERS) for x in (0x61, 0xE9, 0x17F)):
            return False
        more = "".join(chr(x) for x in range(0xDF, 0x250) if chr(x).islower() and chr(x).isalpha())
        cut = lambda x: [where for _, where in self.tokenizer.pre_tokenizer.pre_tokenize_str(x)]
        same = all(self.tokenizer.normalizer.normalize_str(x) == x for x in (letters, signs))
        low = self.tokenizer.normalizer.normalize_str(letters.upper() + "ÄÑÉ") == letters + "äñé"
        at = len(letters + more)
        return same and low and cut(letters + more) == [(0, at)] and all(cut(letters + more + c) == [(0, at), (at, at + 1)] for c in signs) and cut("a" + signs) == [(0, 1), (1, 1 + len(signs))]

    def clear(self) -> None:
        slots = 1 << (2 * self.runs - 1).bit_length()
        self.mask = _U(slots - 1)
        self.keys, self.entry = np.zeros(slots, dtype=np.uint64), np.full(slots, -1, dtype=np.int32)
        self.first, self.size = np.zeros(1 << 10, dtype=np.int64), np.zeros(1 << 10, dtype=np.int32)
        self.ids, self.used, self.n = np.zeros(1 << 12, dtype=np.uint32), 0, 0
        self.add([[END_ID]])  # entry 0

    def run(self, run: bytes) -> list[int]:
        """Ids of one run."""
        text = run.decode("utf-8", "replace")
        if self.splits and text.isalpha() and max(text) < "\u0250" and "\u0130" not in text:
            if not run.isascii():
                text = text.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
            return [t.id for t in self.tokenizer.model.tokenize(text)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _cut(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beginnings and ends of the runs, signs after letters apart, and the first run of each text."""
        data, starts, ends = w.data, w.starts, w.ends
        if not self.splits or not len(starts):
            return starts, ends, w.first
        last = ends.copy()
        at = np.flatnonzero(_SIGNS[data[ends - 1]])
        for _ in range(_MOST_SIGNS):
            last[at] -= 1
            at = at[last[at] > starts[at]]
            at = at[_SIGNS[data[last[at] - 1]]]
            if not len(at):
                break
        one, two = data[np.maximum(last - 1, 0)], data[np.maximum(last - 2, 0)]
        latin = (two >= 0xC3) & (two <= 0xC9) & (one >= 0x80) & (one < 0xC0) & ~((two == 0xC3) & ((one == 0x97) | (one == 0xB7))) & ~((two == 0xC4) & (one == 0xB0))
        letter = ((one >= 97) & (one <= 122)) | (latin & (last - starts > 1))
        total = np.zeros(len(data) + 1, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
        np.cumsum(_OTHER[data], out=total[1:])
        parted = (last > starts) & (last < ends) & letter & (total[last] == total[starts])
        many = 1 + parted
        begins = np.concatenate([[0], np.cumsum(many)])
        cut = np.repeat(starts, many), np.repeat(ends, many)
        at = begins[:-1][parted]
        cut[1][at], cut[0][at + 1] = last[parted], last[parted]
        return *cut, begins[w.first]

    def add(self, found: list[list[int]]) -> np.ndarray:
        """Entries of new runs."""
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        n, used = self.n + len(found), self.used + int(sizes.sum())
        if n > len(self.first):
            self.first, self.size = (np.concatenate([x, np.zeros(max(len(x), n - len(x)), x.dtype)]) for x in (self.first, self.size))
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), used - len(self.ids)), np.uint32)])
        self.first[self.n : n], self.size[self.n : n] = self.used + np.cumsum(sizes) - sizes, sizes
        self.ids[self.used : used] = np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32, count=used - self.used)
        new = np.arange(self.n, n, dtype=np.int32)
        self.n, self.used = n, used
        return new

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entries, or -1."""
        at = (hashes & self.mask).astype(np.int64)
        out = self.entry[at]
        wrong = np.flatnonzero((self.keys[at] != hashes) & (out >= 0))
        at = at[wrong]
        while len(wrong):
            at = (at + 1) & int(self.mask)
            got, same = self.entry[at], self.keys[at] == hashes[wrong]
            out[wrong] = np.where(same, got, -1)
            go = ~same & (got >= 0)
            wrong, at = wrong[go], at[go]
        return out

    def put(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        at = (hashes & self.mask).astype(np.int64)
        while len(at):
            free = np.flatnonzero(self.entry[at] < 0)
            self.entry[at[free]] = entries[free]
            won = self.entry[at] == entries
            self.keys[at[won]] = hashes[won]
            at, hashes, entries = (at[~won] + 1) & int(self.mask), hashes[~won], entries[~won]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a slice, each followed by the end id, and where each text's begin."""
        w = Words(data, offsets, SPACE_WORDS, lower=self.splits)
        starts, ends, first = self._cut(w)
        h = span_hashes(w.data, starts, ends)
        if self.n + len(h) > self.runs:
            self.clear()
        entry = self.find(h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            unseen, at, of = np.unique(h[new], return_index=True, return_inverse=True)
            raw = w.data.tobytes()
            added = self.add([self.run(raw[s:e]) for s, e in zip(starts[new[at]].tolist(), ends[new[at]].tolist(), strict=True)])
            if 2 * self.n <= len(self.keys):
                self.put(unseen, added)
            entry[new] = added[of]
        entry = np.insert(entry, first[1:], 0)
        size = self.size[entry].astype(np.int64)
        upto = np.cumsum(size)
        ids = self.ids[np.repeat(self.first[entry] - (upto - size), size) + np.arange(int(upto[-1]) if len(upto) else 0)]
        return ids, np.concatenate([[0], upto])[first + np.arange(len(first))]


def encoder(path: str) -> Encoder:
    """The worker's encoder of that file, kept from one task that encodes to the next."""
    if path not in KEPT:
        KEPT[path] = Encoder(path)
    return KEPT[path]


def encoded(batch: pa.RecordBatch, enc: Encoder) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ids and beginnings of each slice of the batch's texts."""
    for lo, _, data, offsets in slices(batch.column("text")):
        yield lo, *enc.encode(data, offsets)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Training order


def feistel(index: np.ndarray, n: int, key: int, rounds: int = 4) -> np.ndarray:
    """The keyed permutation of 0..n-1 at index.

    A balanced Feistel network permutes the smallest even number of bits that
    hold n; results beyond n are put through it again until they fall below.
    """
    half = max(1, -(-max(int(n - 1).bit_length(), 1) // 2))
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix64(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key & (2**64 - 1)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> width, x & mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & mask)
        return (left << width) | right

    x = once(index.astype(np.uint64))
    while (far := x >= np.uint64(n)).any():
        x[far] = once(x[far])
    return x.astype(np.int64)


_DOCUMENT = np.dtype([("doc_id", "<i8"), ("name", "<i8"), ("n", "<i8")])


def _encode(path: str, most: int = 1 << 23):
    """Documents to their ids by group, a row for all documents of a group that came within some MB of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = encoder(path), zstandard.ZstdCompressor(level=3)
        if enc.vocabulary > 1 << 16:
            raise ValueError("ids of this tokenizer don't fit 16 bits")
        heads: list[np.ndarray] = []
        groups: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            head, grp, flat = np.concatenate(heads), np.concatenate(groups), np.concatenate(ids)
            first = np.cumsum(head["n"]) - head["n"]
            order = np.argsort(grp, kind="stable")
            cuts = np.flatnonzero(np.diff(grp[order], prepend=-1))
            rows = []
            for of in np.split(order, cuts[1:]):
                size = head["n"][of]
                at = np.repeat(first[of] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                rows.append(pack.compress(len(of).to_bytes(8, "little") + head[of].tobytes() + flat[at].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(grp[order[cuts]].astype(np.int32)), pa.array(rows, pa.binary())], names=["grp", "ids"])
            heads.clear(), groups.clear(), ids.clear()

        for b in batches:
            named = [b.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "name")]
            doc = b.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for lo, flat, begins in encoded(b, enc):
                of = slice(lo, lo + len(begins) - 1)
                head = np.empty(len(begins) - 1, dtype=_DOCUMENT)
                head["doc_id"], head["name"], head["n"] = doc[of], named[1][of], np.diff(begins)
                heads.append(head), groups.append(named[0][of]), ids.append(flat.astype("<u2"))
                held += ids[-1].nbytes
                if held >= most:
                    yield from out()
                    held = 0
        if heads:
            yield from out()

    return slim(run, keep=True)


SEQUENCES = "grp int, place long, n int, records binary"


def _cut(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """A group's documents, in order, to its sequences: ROW_SEQUENCES records a row."""
    pack, unpack = zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor()
    heads, ids = [], []
    for x in t.column("ids").to_pylist():
        x = unpack.decompress(x)
        n = int.from_bytes(x[:8], "little")
        heads.append(np.frombuffer(x, _DOCUMENT, n, 8))
        ids.append(np.frombuffer(x, "<u2", offset=8 + n * _DOCUMENT.itemsize))
    head, flat = np.concatenate(heads), np.concatenate(ids)
    del heads, ids
    first = np.cumsum(head["n"]) - head["n"]
    order = np.lexsort((head["name"], head["doc_id"]))
    head, first = head[order], first[order]
    size = head["n"]
    begins = np.cumsum(size) - size
    total = int(size.sum())
    n = -(-total // SEQUENCE)
    grp = key[0].as_py()
    rows: list[list] = [[], [], [], []]
    for place in range(0, n, ROW_SEQUENCES):
        many = min(ROW_SEQUENCES, n - place)
        lo, hi = place * SEQUENCE, min((place + many) * SEQUENCE, total)
        at = np.arange(place, place + many, dtype=np.int64) * SEQUENCE
        doc = np.searchsorted(begins, at, side="right") - 1
        last = np.searchsorted(begins, np.minimum(at + SEQUENCE, total) - 1, side="right") - 1
        own = slice(int(doc[0]), int(last[-1]) + 1)
        from_, upto = np.maximum(begins[own], lo), np.minimum(begins[own] + size[own], hi)
        here = np.repeat(first[own] - begins[own], upto - from_) + np.arange(lo, hi)
        rec = np.zeros(many, dtype=RECORD)
        ids = np.zeros(many * SEQUENCE, dtype="<u2")
        ids[: hi - lo] = flat[here]
        rec["ids"] = ids.reshape(many, SEQUENCE)
        rec["head"]["doc_id"], rec["head"]["last_doc_id"] = head["doc_id"][doc], head["doc_id"][last]
        rec["head"]["start"], rec["head"]["n_ids"] = at - begins[doc], np.minimum(SEQUENCE, total - at)
        rec["end"] = 10
        for column, x in zip(rows, (grp, place, many, pack.compress(rec.tobytes())), strict=True):
            column.append(x)
    give_back()
    return pa.table(dict(zip(("grp", "place", "n", "records"), (pa.array(x, k) for x, k in zip(rows, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)), strict=True)))


def _to_slots(n: int, key: int, shard_slots: int):
    """Rows of sequences to rows of the blocks that their slots lie in: shard, block, records."""

    block_slots = min(BLOCK_SLOTS, shard_slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for b in batches:
            for number, blob in zip(b.column("number").to_pylist(), b.column("records").to_pylist(), strict=True):
                rec = np.frombuffer(unpack.decompress(blob), dtype=RECORD).copy()
                slot = feistel(number + np.arange(len(rec)), n, key)
                rec["head"]["slot"] = slot
                order = np.argsort(slot)
                rec, block = rec[order], slot[order] // block_slots
                ids, first = np.unique(block, return_index=True)
                blobs = [pack.compress(x.tobytes()) for x in np.split(rec, first[1:])]
                shard = (ids * block_slots // shard_slots).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(ids), pa.array(blobs, pa.binary())], names=["shard", "block", "records"])

    return slim(run)


@slim
def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come by block to a row for each: its records by slot, without the last line feed, which the writer adds."""
    unpack = zstandard.ZstdDecompressor()
    held: list[np.ndarray] = []
    block = -1

    def out() -> pa.RecordBatch:
        rec = np.concatenate(held)
        return pa.RecordBatch.from_arrays([pa.array([rec[np.argsort(rec["head"]["slot"])].tobytes()[:-1]], pa.binary())], names=["value"])

    for b in batches:
        for at, blob in zip(b.column("block").to_pylist(), b.column("records").to_pylist(), strict=True):
            if at != block and held:
                yield out()
                held = []
            block = at
            held.append(np.frombuffer(unpack.decompress(blob), dtype=RECORD))
    if held:
        yield out()


def materialise(documents: DataFrame, path: str, key: int = 20240101, tokenizer: str | None = None, shard_slots: int = SHARD_SLOTS) -> int:
    """Writes the shards of documents (doc_id, text) below path, one file each; the number of sequences.

    shard_slots: a power of two. Larger corpora want larger shards, as there is a file and a task for each.
    What reaches the driver, and is broadcast, is a number for each group, that is
    some 16 bytes for GROUP_BYTES of text.
    """
    spark = documents.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    docs = pick(documents, doc_id="long", text="string")
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).collect()[0]["b"] or 0
    grp = F.pmod(F.xxhash64("doc_id", "text"), F.lit(-(-size // GROUP_BYTES) or 1)).cast("int")
    dealt = docs.select(grp.alias("grp"), F.xxhash64("text").alias("name"), "doc_id", "text").mapInArrow(_encode(tokenizer or default_path()), "grp int, ids binary")
    sequences = scratch.put(dealt.groupBy("grp").applyInArrow(_cut, SEQUENCES))
    counts = sequences.groupBy("grp").agg(F.sum("n").alias("n")).toArrow().sort_by("grp")
    n = int(np.sum(counts.column("n").to_numpy()))
    if n:
        before = np.cumsum(counts.column("n").to_numpy()) - counts.column("n").to_numpy()
        before = F.broadcast(spark.createDataFrame(pa.table({"grp": counts.column("grp"), "before": pa.array(before)})))
        numbered = sequences.join(before, "grp").select((F.col("before") + F.col("place")).alias("number"), "records")
        slots = numbered.mapInArrow(_to_slots(n, key, shard_slots), "shard int, block long, records binary")
        shards = slots.repartitionById(-(-n // shard_slots), F.col("shard")).sortWithinPartitions("block")
        rows = shards.select("block", "records").mapInArrow(_in_order, "value binary")
        with freed_shuffles(spark):
            rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(path)
    scratch.clear()
    return n


SHARD_SCHEMA = "slot long, shard int, byte_offset long, doc_id long, last_doc_id long, start long, n_ids int, ids_crc32 long"


def _read(shard_slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content"), strict=True):
                rec = np.frombuffer(content.as_buffer(), dtype=RECORD)
                at = np.arange(len(rec), dtype=np.int64)
                head = rec["head"]
                if not (head["slot"] == shard * shard_slots + at).all() or not (rec["end"] == 10).all():
                    raise ValueError(f"shard {shard} isn't in order")
                crc = [zlib.crc32(ids[:k].tobytes()) for ids, k in zip(rec["ids"], head["n_ids"].tolist(), strict=True)]
                cols = [head["slot"], np.full(len(rec), shard, np.int32), at * STRIDE, head["doc_id"], head["last_doc_id"], head["start"], head["n_ids"], np.array(crc, dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=[c.split()[0] for c in SHARD_SCHEMA.split(", ")])

    return slim(run)


def read_shards(spark: SparkSession, path: str, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per sequence, read back from the shards: its slot and place, its documents, and the crc32 of its 16-bit ids."""
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files = files.filter("length > 0").select(number.alias("shard"), "content")
    return files.mapInArrow(_read(shard_slots), SHARD_SCHEMA)
