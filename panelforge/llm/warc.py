"""WARC archives: written with revisit records, read back by boundary-chain verification.

write() puts one record per page into archives in a shared folder, through
Spark's own writer. Each record is a gzip member of its own, whose header tells
the member's length in a subfield, as block formats do; an empty member stands
after each one. So any tool that reads gzip reads an archive, and a record can
be read at its offset alone.

read() lets Spark split the files at the empty members, wherever their bytes
stand; a file may take any number of tasks. Each task emits small rows: every
piece that begins like a member is a candidate, which points to the offset after
its record. Within a split, pointer jumping finds where the chain from each
candidate leaves the split. Across splits, the candidates that some chain leaves
to are linked file by file, a row or so for each split, and pointer jumping from
the file's start keeps those on the chain of true boundaries; it must end exactly
at the end of the file. In each split, candidates on the chain from the true
entry are records. So bytes inside a payload that look like a separator or a
record are never taken for one. Records that such bytes cut into pieces are put
together in a second scan, which there is only if there are any.

Null html is an empty payload. Of records with equal payloads of at least
LEAST_BYTES, the smallest page_id is a response and the others revisit it; null
page_ids count as the largest, and rows that repeat the smallest page_id are all
responses. Blanks and controls in URLs are percent-encoded. An empty table gives
an empty archive and no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch, freed_shuffles, give_back, pick, slim, small_batches, written

MAGIC = b"WARC/1.1\r\n"
LEAST_BYTES = 100
CRLF = b"\r\n"
#: Any fixed time does; the tables carry none.
DATE = b"2024-01-01T00:00:00Z"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Formats of gzip: a member's header without and with additional fields, and an empty member.
_PLAIN, _EXTRA = b"\x1f\x8b\x08\0\0\0\0\0\0\xff", b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
EMPTY = _PLAIN + b"\x03\0" + bytes(8)
#: Length of the additional fields, name and length of the one that tells the member's length.
_FIELD = struct.pack("<H2sH", 12, b"PL", 8)
_HEAD = len(_EXTRA) + len(_FIELD) + 8
_TEXT = {"lineSep": EMPTY.decode("latin-1"), "encoding": "ISO-8859-1"}


def plan_records(pages: DataFrame) -> DataFrame:
    """pages with payload_digest, record_type and refers_to. Only ids and digests are grouped."""
    pages = pick(pages, page_id="long", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    facts = pages.select("page_id", F.sha2("html", 256).alias("payload_digest"), F.octet_length("html").alias("n"))
    long = facts.filter(F.col("n") >= LEAST_BYTES)
    first = long.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("payload_digest", "first_id")
    later = (
        long.select("page_id", "payload_digest")
        .join(first, "payload_digest")
        .filter(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("later_id"), F.col("payload_digest").alias("later_digest"), "first_id")
        .distinct()
    )
    here = pages.withColumn("payload_digest", F.sha2("html", 256))
    joined = here.join(later, here.page_id.eqNullSafe(later.later_id) & (here.payload_digest == later.later_digest), "left")
    return joined.select(
        "page_id",
        "url",
        "html",
        "payload_digest",
        F.octet_length("html").cast("long").alias("payload_bytes"),
        F.when(F.col("first_id").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("first_id").alias("refers_to"),
    )


def member(record: bytes) -> bytes:
    """The record as a gzip member that tells its own length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    return b"".join((_EXTRA, _FIELD, struct.pack("<Q", _HEAD + len(body) + 8), body, struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)))


def claimed(piece: bytes) -> int:
    """The length that a piece which begins like a member tells, else 0."""
    if not piece.startswith(_EXTRA + _FIELD) or len(piece) < _HEAD:
        return 0
    return struct.unpack_from("<Q", piece, _HEAD - 8)[0]


@slim
def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda x: b"" if x is None else b"%d" % x
    for b in batches:
        out = []
        columns = (b.column(c).to_pylist() for c in ("page_id", "url", "html", "payload_digest", "payload_bytes", "record_type", "refers_to"))
        for page, url, html, digest, size, kind, refers in zip(*columns, strict=True):
            address = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], (url or "").encode())
            fields = [b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:page:" + number(page) + b">", b"WARC-Date: " + DATE, b"WARC-Target-URI: " + address]
            fields += [b"WARC-Payload-Digest: sha256:" + digest.encode(), b"X-Payload-Length: " + number(size)]
            body = html.encode()
            if kind == "revisit":
                body = b""
                fields += [b"WARC-Refers-To: <urn:page:" + number(refers) + b">", b"WARC-Profile: " + PROFILE]
            fields.append(b"Content-Length: " + number(len(body)))
            out.append(member(MAGIC + CRLF.join(fields) + CRLF * 2 + body + CRLF * 2))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write(pages: DataFrame, path: str) -> None:
    """Archives in path, one record per row of pages. Files follow the partitions of the join, which AQE keeps even."""
    small_batches(pages.sparkSession)
    rows = plan_records(pages).mapInArrow(_members, "value binary")
    with freed_shuffles(pages.sparkSession):
        rows.select(F.col("value").cast("string").alias("value")).write.options(**_TEXT).text(path)


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
_RECORD = [(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in RECORD.split(", ")]
#: A piece: the split it begins in, its place and size there, and the place after the member that it claims to be (null: none).
PIECE = "path string, split long, place long, size long, after long, leaves long, problem string, " + RECORD
READ_SCHEMA = RECORD + ", file string, record_offset long"


def _number(x: bytes) -> int | None:
    x = x.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(x) if x else None


def parsed(data: bytes) -> tuple:
    """The fields of RECORD of a member; raises ValueError if it holds no sound record."""
    try:
        record = zlib.decompress(data, 31)
    except zlib.error as e:
        raise ValueError(f"a member can't be unpacked: {e}") from None
    end = record.find(CRLF * 2)
    if not record.startswith(MAGIC) or end < 0:
        raise ValueError("a member holds no record")
    h = dict(x.split(b": ", 1) for x in record[len(MAGIC) : end].split(CRLF) if b": " in x)
    try:
        kind, said, size = h[b"WARC-Type"].decode(), h[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode(), int(h[b"Content-Length"])
        payload = memoryview(record)[end + 4 : end + 4 + size]
        if len(record) != end + 4 + size + 4:
            raise ValueError("a record doesn't end where it says")
        refers = _number(h[b"WARC-Refers-To"]) if kind == "revisit" else None
        if kind == "response":  # of what is there, not of what the header says
            if hashlib.sha256(payload).hexdigest() != said:
                raise ValueError("a payload doesn't match its digest")
        else:
            size = int(h[b"X-Payload-Length"])
        return _number(h[b"WARC-Record-ID"]), size, said, kind, refers, h[b"WARC-Target-URI"].decode()
    except KeyError as e:
        raise ValueError(f"a record lacks {e}") from None


def leaving(place: np.ndarray, after: np.ndarray, size: int) -> np.ndarray:
    """Where the chain from each place leaves a split of so many bytes, by pointer jumping; -1: it ends between two places.

    place is sorted; after is 0 for what is no candidate. Each round doubles the
    jumps, so that a chain of n records takes about log2(n) of them.
    """
    n = len(place)
    at = np.searchsorted(place, after)
    inside = (at < n) & (place[np.minimum(at, n - 1)] == after) & (after > 0) if n else np.zeros(0, dtype=bool)
    jump = np.append(np.where(inside, np.minimum(at, n - 1), n), n)
    out = np.append(np.where(inside, 0, np.where(after >= size, after, -1)), 0)
    while (jump[:n] < n).any():
        out = np.where(jump < n, out[jump], out)
        jump = np.where(jump < n, jump[jump], jump)
    return out[:n]


def on_chain(place: np.ndarray, after: np.ndarray, start: int) -> np.ndarray:
    """Which places the chain from start visits, by pointer jumping: marks spread while the jumps double."""
    n = len(place)
    at = np.searchsorted(place, after)
    inside = (at < n) & (place[np.minimum(at, n - 1)] == after) & (after > 0) if n else np.zeros(0, dtype=bool)
    jump = np.append(np.where(inside, np.minimum(at, n - 1), n), n)
    mark = np.append((place == start) & (after > 0), False)
    while True:
        new = mark.copy()
        new[jump[mark]] = True
        if (new == mark).all() and (jump == n).all():
            return mark[:n]
        mark, jump = new, jump[jump]


@slim
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of splits, in order, to rows of PIECE. Only these small rows of a split are held."""
    held: list[tuple] = []
    split: tuple | None = None
    at = 0

    def out() -> pa.RecordBatch:
        place, size, after = (np.array([r[i] for r in held], dtype=np.int64) for i in range(3))
        leaves = leaving(place, after, at)
        fields = [pa.array([split[0]] * len(held), pa.string()), pa.array(np.full(len(held), split[1])), pa.array(place), pa.array(size)]
        fields += [pa.array(after, mask=after == 0), pa.array(leaves, mask=(after == 0) | (leaves < 0)), pa.array([r[3] for r in held], pa.string())]
        fields += [pa.array([r[4 + i] for r in held], kind) for i, (_, kind) in enumerate(_RECORD)]
        return pa.RecordBatch.from_arrays(fields, names=[c.split()[0] for c in PIECE.split(", ")])

    for b in batches:
        for path, begins, value in zip(b.column("path").to_pylist(), b.column("split").to_pylist(), b.column("value").to_pylist(), strict=True):
            if (path, begins) != split:
                if held:
                    yield out()
                held, split, at = [], (path, begins), 0
            size, told, problem, record = len(value) + len(EMPTY), claimed(value), None, (None,) * len(_RECORD)
            if told == len(value):
                try:
                    record = parsed(value)
                except ValueError as e:
                    problem = str(e)
            held.append((at, size, at + told + len(EMPTY) if told else 0, problem, *record))
            at += size
    if held:
        yield out()


def _entries(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Of a file: for each split, where the chain from the file's start enters it."""
    t = t.sort_by("offset")
    offset, leaves, total = (t.column(c).to_numpy(zero_copy_only=False) for c in ("offset", "leaves", "total"))
    leaves = np.nan_to_num(leaves.astype(np.float64), nan=0).astype(np.int64)
    mark = on_chain(offset, leaves, 0)
    if not mark.any():
        raise ValueError(f"{key[0].as_py()} doesn't begin with a record")
    if leaves[np.flatnonzero(mark)[-1]] != total[0]:
        raise ValueError(f"the chain of records of {key[0].as_py()} is broken")
    keep = t.filter(pa.array(mark))
    return pa.table({"path": keep.column("path"), "split": keep.column("split"), "entry": keep.column("place")})


def _true(key: tuple[pa.Scalar, ...], t: pa.Table, entries: pa.Table) -> pa.Table:
    """Of a split: the pieces on the chain from its entry, and with them the pieces that belong to a cut record."""
    names = ["record", *t.column_names]
    t = t.sort_by("place")
    place, size, after = (t.column(c).fill_null(0).to_numpy() for c in ("place", "size", "after"))
    mark = on_chain(place, after, entries.column("entry")[0].as_py()) if entries.num_rows else np.zeros(len(place), dtype=bool)
    for said in t.filter(pa.array(mark & (after == place + size))).column("problem").to_pylist():
        if said is not None:
            raise ValueError(f"{key[0].as_py()}: {said}")
    out = t.filter(pa.array(mark))
    return out.add_column(0, "record", out.column("place")).select(names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The true records of all archives in path, one row each."""
    small_batches(spark)
    scratch = Scratch(spark)
    files = spark.read.options(**_TEXT).option("pathGlobFilter", "part-*").text(path)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    pieces = scratch.put(files.mapInArrow(_scan, PIECE))
    # a row per split: where it begins among the pieces, which are all of the file
    sizes = pieces.groupBy("path", "split").agg(F.sum("size").alias("bytes"))
    of_file = Window.partitionBy("path")
    before = F.sum("bytes").over(of_file.orderBy("split")) - F.col("bytes")
    splits = scratch.put(sizes.select("path", "split", before.alias("begin"), F.sum("bytes").over(of_file).alias("total")))
    candidates = pieces.filter("leaves is not null").select("path", "split", "place", "leaves").join(splits, ["path", "split"])
    candidates = candidates.select("path", "split", "place", (F.col("begin") + F.col("place")).alias("offset"), (F.col("begin") + F.col("leaves")).alias("leaves"), "total")
    # the start of each file, and what the chain of another split leaves to
    aims = candidates.filter("leaves < total").select("path", F.col("leaves").alias("offset")).unionByName(splits.select("path", F.lit(0).cast("long").alias("offset"))).distinct()
    entries = splits.select("path").distinct().join(candidates.join(aims, ["path", "offset"]), "path", "left")
    entries = entries.groupBy("path").applyInArrow(_entries, "path string, split long, entry long")
    true = pieces.groupBy("path", "split").cogroup(entries.groupBy("path", "split")).applyInArrow(_true, "record long, " + PIECE)
    true = scratch.put(true.join(splits, ["path", "split"]).withColumn("record_offset", F.col("begin") + F.col("place")))
    fields = [c.split()[0] for c in RECORD.split(", ")]
    whole = F.col("after") == F.col("place") + F.col("size")
    out = true.filter(whole).select(*fields, F.col("path").alias("file"), "record_offset")
    cut = true.filter(~whole).select("path", "record_offset", (F.col("begin") + F.col("after")).alias("upto"))
    if cut.limit(1).count():
        out = out.unionByName(_together(files, pieces, splits, cut))
    out = written(out)
    scratch.clear()
    return out


def _together(files: DataFrame, pieces: DataFrame, splits: DataFrame, cut: DataFrame) -> DataFrame:
    """Records that bytes like a separator cut into pieces, from a second scan."""
    placed = pieces.join(splits, ["path", "split"]).select("path", "split", "place", (F.col("begin") + F.col("place")).alias("offset"))
    # records don't overlap, so a piece belongs to the last one that begins before it
    starts = cut.select("path", F.col("record_offset").alias("offset"), "record_offset", "upto")
    none = F.lit(None).cast("long")
    both = placed.withColumns({"record_offset": none, "upto": none, "o": F.lit(1)}).unionByName(starts.withColumns({"split": none, "place": none, "o": F.lit(0)}))
    last = Window.partitionBy("path").orderBy("offset", "o")
    both = both.withColumns({c: F.last(c, ignorenulls=True).over(last) for c in ("record_offset", "upto")})
    wanted = both.filter("o = 1 and offset < upto").select("path", "split", "place", "offset", "record_offset")
    numbered = files.mapInArrow(_placed, "path string, split long, place long, value binary")
    rows = numbered.join(wanted, ["path", "split", "place"])
    return rows.groupBy("path", "record_offset").applyInArrow(_joined, READ_SCHEMA)


@slim
def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their places in their splits, as _scan() counts them."""
    split, at = None, 0
    for b in batches:
        places = []
        for path, begins, n in zip(b.column("path").to_pylist(), b.column("split").to_pylist(), [len(x) for x in b.column("value").to_pylist()], strict=True):
            if (path, begins) != split:
                split, at = (path, begins), 0
            places.append(at)
            at += n + len(EMPTY)
        yield pa.RecordBatch.from_arrays([b.column("path"), b.column("split"), pa.array(places, pa.int64()), b.column("value")], names=["path", "split", "place", "value"])


def _joined(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """One record of its pieces."""
    row = parsed(EMPTY.join(t.sort_by("offset").column("value").to_pylist()))
    give_back()
    return pa.table({n: pa.array([v], k) for (n, k), v in zip(_RECORD, row, strict=True)} | {"file": pa.array([key[0].as_py()]), "record_offset": pa.array([key[1].as_py()], pa.int64())})
