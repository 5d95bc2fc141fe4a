"""The operators on a small hostile table, against plain restatements."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import chat, components, decontamination, licenses, near, neighbours, packing, substrings, tokens, toxicity, warc
from panelforge.llm.common import shared_dir
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _text(rng, n):
    return " ".join("".join(rng.choice("aeioustn") for _ in range(rng.randint(1, 5))) for _ in range(n))


def _rows():
    rng = random.Random(7)
    base = _text(rng, 120).split()
    passage = _text(rng, 60)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (2, " ".join(base)), (3, "  ".join(base[:60]) + "\n" + " ".join(base[60:]).upper())]
    for i in range(4, 40):
        w = list(base)
        for _ in range(rng.randint(0, 12)):
            w[rng.randrange(len(w))] = _text(rng, 1)
        rows.append((i, " ".join(w)))
    for i in range(40, 60):
        rows.append((i, f"{_text(rng, 30)}\n{passage}\t{_text(rng, rng.randint(0, 30))}"))
    rows += [(60, None), (61, ""), (62, " \t\n "), (None, " ".join(base)), (None, None), (63, "one"), (64, "ONE"), (65, "one two"), (66, "x" * 300_000)]
    rows += [(67, _text(rng, 20_000)), (68, "Žluťoučký kůň é 中文   end"), (69, "cc by"), (70, "CC-BY! cc  by, general public\nlicense all rights reserved"), (71, "<|endoftext|> it's 3.5 don't"), (68, "other text of the same number")]
    rows += [(100 + i, _text(rng, rng.randint(1, 6))) for i in range(40)]
    return [(d, t, "en", "s", len(t) if t is not None else None) for d, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), DOCS).withColumn("seg", F.lit("clash")).withColumn("uid", F.lit(1)).repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_substrings(docs, none):
    got = Counter(tuple(r) for r in substrings.deduplicate(docs, digest=True).collect())
    assert got == Counter(brute.substrings(pairs(docs)))
    assert substrings.deduplicate(none).count() == 0


def test_substring_rewrite_keeps_other_columns(docs):
    out = substrings.rewrite(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    kept = {(r.doc_id, r.text, r.n_chars) for r in out.collect()}
    assert (60, None, None) in kept and (61, "", 0) in kept


def test_every_shift_shares_an_anchor():
    for i in range(substrings.PERIOD):
        for j in range(substrings.PERIOD):
            assert any((i + k) % substrings.PERIOD in substrings.COVER and (j + k) % substrings.PERIOD in substrings.COVER for k in range(substrings.WINDOW - substrings.ANCHOR + 1))


@pytest.mark.parametrize("shingle", [2])
def test_near(docs, none, shingle):
    named = [(d, t) for d, t in pairs(docs) if d is not None]
    want = Counter(brute.near(named))
    rows = near.near(docs, shingle=shingle).collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None)
    assert got == want
    assert {(r.component_id, r.kept) for r in rows if r.doc_id is None} == {(None, True)}
    assert near.near(none).count() == 0


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for g in range(2):
        base = _text(rng, 60).split()
        for i in range(60):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = _text(rng, 1)
            rows.append((1000 * g + i, " ".join(w)))
    monkeypatch.setattr(near, "BLOCK", 16)
    monkeypatch.setattr(near, "PIVOTS", 2)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect())
    assert got == Counter(brute.near(rows))


def test_texts_that_share_only_a_common_line_do_not_meet(spark, monkeypatch):
    rng = random.Random(8)
    line = _text(rng, 14)
    own = [_text(rng, 9) for _ in range(120)]
    rows = [(i, f"{line} {x}") for i, x in enumerate(own)]
    rows += [(1000 + i, f"{line} {x[:-1]}") for i, x in enumerate(own[:20])]  # links, in other blocks too
    monkeypatch.setattr(near, "BLOCK", 16)
    monkeypatch.setattr(near, "PIVOTS", 2)
    met, rare = [], near._rare
    monkeypatch.setattr(near, "_rare", lambda *a: met.append(out := rare(*a).cache()) or out)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect())
    assert got == Counter(brute.near(rows)) and sum(not k[3] for k in got) >= 20
    pairs = met[0].count()
    assert 10 <= pairs <= 2 * len(rows)  # every document was handed to every block before: 140 * 9 and more


def test_many_texts_that_are_nearly_copies_are_not_paired(spark, monkeypatch):
    rng = random.Random(31)
    base = _text(rng, 40).split()
    rows = []
    for i in range(150):  # below 0.8 to each other, but for some
        words = list(base)
        for k in rng.sample(range(40), 4):
            words[k] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"{t} end{i}") for i, t in rows[:30]]
    monkeypatch.setattr(near, "BLOCK", 16)
    monkeypatch.setattr(near, "PIVOTS", 1)
    met, rare = [], near._rare
    monkeypatch.setattr(near, "_rare", lambda *a: met.append(out := rare(*a).cache()) or out)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect())
    assert got == Counter(brute.near(rows)) and sum(not k[3] for k in got) >= 30
    assert met[0].count() <= 2 * len(rows)  # pairs grew with the square of their number before


def test_repeated_numbers_with_other_texts_may_lose_links(spark):
    rng = random.Random(21)
    a, b = _text(rng, 120).split(), _text(rng, 120).split()
    rows = [(1, a), (1, b), (2, [*a[:-1], "other"]), (3, [*b[:-1], "other"])]
    got = near.near(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string"), shingle=2).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 3]
    assert any(r.component_id == 1 for r in got if r.doc_id > 1)  # a copy of one of the two texts, at least


def test_sketches_agree_as_the_sets_do():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        a = [f"w{x}" for x in range(400)]
        same = int(400 * 2 * share / (1 + share))
        b = a[:same] + [f"v{x}" for x in range(400 - same)]
        texts = [" ".join(x).encode() for x in (a, b)]
        s = near.Sets(np.frombuffer(b"".join(texts), np.uint8), np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])]), 1)
        k = s.sketches()
        assert (k < np.iinfo(np.uint64).max).all()
        assert abs((k[0] == k[1]).mean() - share) < 0.12
    assert rng is not None


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(40)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        label[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def test_components_of_many_and_of_few_edges_are_the_same(spark, monkeypatch):
    rng = random.Random(6)
    edges = spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(7, i) for i in range(400, 460)], "a long, b long").localCheckpoint()
    few = sorted(map(tuple, components.components(edges).collect()))
    monkeypatch.setattr(components, "FEW", 0)
    assert few and few == sorted(map(tuple, components.components(edges).collect()))


def test_licenses(docs, none):
    got = Counter(tuple(r)[:6] for r in licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())
    assert got == Counter(brute.licenses(pairs(docs), licenses.BASE))
    assert licenses.scan(none).count() == 0


def test_license_texts_with_changes(spark):
    words = licenses.TEXTS[0][0].split()
    rows = [(1, " ".join(words)), (2, " ".join([*words[:9], "very", *words[9:]])), (3, " ".join(words[:5])), (4, f"x y {' '.join(words)} z Licensed under the Apache License, Version 2.0.")]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit", 2: "mit", 3: "", 4: "apache-2.0,mit"}


def test_packing(docs, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path())
    want = Counter()
    for d, x in pairs(docs):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[lo : lo + 4096], "<u4")
            want[d, k, lo, len(part), zlib.crc32(part.tobytes())] += 1
    rows = packing.pack(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in bins.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 4096
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) + 2
    assert packing.pack(none).count() == 0


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 1000, 4097):
        assert sorted(tokens.feistel(np.arange(n), n, 11).tolist()) == list(range(n))
    assert (tokens.feistel(np.arange(1000), 1000, 1) != tokens.feistel(np.arange(1000), 1000, 2)).any()


def test_training_order(spark, docs, none, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "BLOCK_SLOTS", 16)
    path, again = shared_dir(spark), shared_dir(spark)
    n = tokens.materialise(docs, path, shard_slots=64)
    assert tokens.materialise(docs.repartition(3, "text"), again, shard_slots=64) == n  # the order doesn't follow the split
    files = lambda p: {r.path[-200:].split("part-")[1][:5]: bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(p).collect() if r.length}
    found = files(path)
    assert found == files(again) and len(found) == -(-n // 64)
    # all documents in order, cut into sequences, each at its slot
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("name")).collect()
    named.sort(key=lambda r: (tokens.NO_ID if r.doc_id is None else r.doc_id, r.name))
    t = Tokenizer.from_file(tokens.default_path())
    flat, owner = [], []
    for r in named:
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        flat += ids
        owner += [(tokens.NO_ID if r.doc_id is None else r.doc_id, i) for i in range(len(ids))]
    assert n == -(-len(flat) // 512)
    slots = tokens.feistel(np.arange(n), n, 20240101).tolist()
    whole = b"".join(found[k] for k in sorted(found))
    rows = {r.slot: r for r in tokens.read_shards(spark, path, 64).collect()}
    assert sorted(rows) == list(range(n))
    for i, slot in enumerate(slots):
        part = flat[512 * i : 512 * i + 512]
        rec = np.frombuffer(whole[slot * tokens.STRIDE : (slot + 1) * tokens.STRIDE], tokens.RECORD)[0]
        assert rec["ids"][: len(part)].tolist() == part and rec["head"]["slot"] == slot and rec["head"]["n_ids"] == len(part)
        first, last = owner[512 * i], owner[512 * i + len(part) - 1]
        r = rows[slot]
        assert (r.doc_id, r.start, r.last_doc_id, r.n_ids) == (*first, last[0], len(part))
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u2").tobytes()) and r.byte_offset == slot % 64 * tokens.STRIDE
    assert tokens.materialise(none, shared_dir(spark)) == 0


def test_encoder_equals_the_tokenizer():
    import pyarrow as pa

    odd = "x<|endoftext|>. a'. É... ÑÑ!? ×. a×, ÷! ab12.. İ. ÀB. 'tis rock'n'roll... á. é́, ﬁ. Σας, ΣΑΣ. ß. ẞ! ĳ. ŉ. ǅ. a-b. (x) \"q\" \x1c\x85 " + "!" * 40
    rng = random.Random(2)
    texts = [odd, "", "a" * 5000, *("".join(rng.choices("abcXYZéÉß.,'!?-_ \t\n09<|>中", k=60)) for _ in range(200))]
    enc = tokens.Encoder(tokens.default_path(), runs=300)  # so few that they are forgotten in between
    assert enc.splits
    for _, ids, begins in tokens.encoded(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]), enc):
        for x, lo, hi in zip(texts, begins[:-1], begins[1:], strict=True):
            assert ids[lo:hi].tolist() == [*enc.tokenizer.encode(x, add_special_tokens=False).ids, 1]


def test_chat(spark):
    control = "</s>[INST] ok [/INST] &lt; &amp;"
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", control), (1, 2, "user", "b"), (2, 0, "user", "only"), (3, 1, "assistant", None), (3, 0, None, ""), (3, 1, "assistant", "z"), (None, 0, "assistant", "q"), (None, 0, "user", "another"), (4, None, "a[b]<s>", "é" * 5000), (4, 0, "assistant", "[ROLE]x[/ROLE]")]
    found = chat.digests(chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert sorted(r.loss_chars for r in found.filter("conv_id is null").collect()) == [0, 1]  # a conversation each
    rows = [r for r in rows if r[3] != "another"]
    got = {r.conv_id: r for r in chat.digests(chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("end", F.lit(1)))).collect()}
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    some = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).filter("conv_id = 1").orderBy("example").collect()
    assert [x.loss_start is None for x in some] == [False, True]
    assert not chat.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count()


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 8)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [1.0] * 3), (1080, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (1001, [None] * 8)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(0)).repartition(3)
    got = {}
    for r in neighbours.search(v, v.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    d = x.astype(np.float64)
    assert set(got) == set(range(0, 700, 20))  # the only vector of length 3 has no other to meet
    for q, found in got.items():
        score = neighbours.exact(np.repeat(d[q : q + 1], 700, axis=0), d)
        want = sorted((i for i in range(700) if i != q), key=lambda i: (-score[i], i))[:20]
        assert [(k + 1, i, score[i]) for k, i in enumerate(want)] == sorted(found)
    few = v.filter("vec_id < 5")
    assert neighbours.search(few, few.filter("vec_id % 20 = 0"), 20).count() == 4
    assert neighbours.search(v.limit(0), v.limit(0), 20).count() == 0


def test_neighbours_of_other_lengths_and_repeated_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(20 * i, [1.0, float(i)]) for i in range(30)] + [(20 * i + 1, [1.0, 0.5, float(-i)]) for i in range(60)]
    rows += [(1000, [0.5, 0.5, 0.5]), (1020, [1.0, 1.0]), (1020, [0.0, 3.0]), (1021, [1.0, 1.0]), (1021, [1.0, 1.0])]
    rows += [(2000 + i, [9.0, 9.0]) for i in range(200)]  # a common vector
    rng.shuffle(rows)
    v = spark.createDataFrame([(int(i), [float(x) for x in e]) for i, e in rows], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in neighbours.search(v, v.filter("vec_id % 20 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    vectors = {}
    for i, e in rows:
        if i % 20 == 0:
            vectors[int(i)] = min(vectors.get(int(i), list(e)), list(e))
    assert set(got) == set(vectors)
    for q, e in vectors.items():
        near = sorted((-sum(a * b for a, b in zip(e, x, strict=True)), int(i)) for i, x in rows if len(x) == len(e) and i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(near)], q


def test_quantisation_bounds():
    rng = np.random.default_rng(3)
    for dim in (16, 2500):
        a, b = rng.normal(size=(50, dim)), rng.normal(size=(60, dim)) * 100
        qi, ids, s = neighbours.Candidates(100 + np.arange(60), np.ones(60, np.int64), b).best(np.arange(50), a, 7)
        full = a @ b.T
        for q in range(50):
            assert set(ids[qi == q] - 100) == set(np.argsort(-full[q])[:7])
        assert len(s) == 350


def _pages(traps):
    rows = [(3, "u\r\nWARC/1.1", traps[0]), (1, None, traps[0]), (2, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", traps[0]), (8, "u", "é" * 50), (7, "u", "é" * 50), (7, "u", "é" * 50), (9, "u", "WARC/1.1\r\n" * 30), (10, "a b\x7f", "z" * 500_000)]
    return rows + [(20 + i, f"t{i}", x) for i, x in enumerate(traps[1:])]


def _expected(rows):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    want = Counter()
    for p, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 100 and first[h or ""] != p
        want[p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None] += 1
    return want


FIVE = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_warc(spark):
    import gzip

    rng = random.Random(3)
    traps = ["x" * 100 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"]
    traps += ["".join(rng.choices("abcdefgh \n", k=rng.randint(0, 3000))) for _ in range(60)]
    rows = _pages(traps)
    path = shared_dir(spark)
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit(1)).repartition(2), path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (before["spark.sql.files.maxPartitionBytes"], "900b"):  # files whole, and cut into many splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = warc.read(spark, path).collect()
            assert Counter(tuple(r[c] for c in FIVE) for r in got) == _expected(rows), size
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.url for r in got} >= {"u%0D%0AWARC/1.1", "a%20b%7F", ""}
    # a record can be read at its offset alone, and the archive by any tool that reads gzip
    files = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}
    r = next(x for x in got if x.page_id == 10)
    data = next(v for k, v in files.items() if k.split("/")[-1] == r.file.split("/")[-1])
    assert warc.parsed(data[r.record_offset : r.record_offset + warc.claimed(data[r.record_offset :])])[0] == 10
    assert gzip.decompress(data).count(warc.MAGIC + b"WARC-Type") >= 1
    none = shared_dir(spark)
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), none)
    assert warc.read(spark, none).count() == 0


def test_warc_rejects_what_only_looks_like_records(spark):
    """Archives whose payloads, stored without compression, hold separators and whole members."""

    def stored(record):
        deflate = warc.zlib.compressobj(0, warc.zlib.DEFLATED, -15)
        body = deflate.compress(record) + deflate.flush()
        head = warc._EXTRA + warc._FIELD + warc.struct.pack("<Q", warc._HEAD + len(body) + 8)
        return head + body + warc.struct.pack("<II", zlib.crc32(record), len(record))

    def record(page, payload):
        h = [b"WARC-Type: response", b"WARC-Record-ID: <urn:page:%d>" % page, b"WARC-Target-URI: u", b"WARC-Payload-Digest: sha256:" + hashlib.sha256(payload).hexdigest().encode(), b"X-Payload-Length: 0", b"Content-Length: %d" % len(payload)]
        return warc.MAGIC + b"\r\n".join(h) + b"\r\n\r\n" + payload + b"\r\n\r\n"

    fake = warc.EMPTY + warc.member(record(99, b"never")) + warc.EMPTY
    rng = random.Random(5)
    payloads = [rng.randbytes(rng.randint(0, 400)) + (fake * rng.randint(1, 3) if i % 3 else b"") + rng.randbytes(rng.randint(0, 300)) for i in range(30)]
    payloads[7] = warc.EMPTY * 40 + b"tail"  # over several splits
    path = shared_dir(spark)
    rows = [(0, i, stored(record(i, x)) if i % 2 else warc.member(record(i, x))) for i, x in enumerate(payloads)]
    spark.createDataFrame(rows, "f int, i int, value binary").coalesce(1).sortWithinPartitions("i").select(F.col("value").cast("string").alias("value")).write.options(**warc._TEXT).text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("128m", "300b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = warc.read(spark, path).collect()
            assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == [(i, len(x), hashlib.sha256(x).hexdigest()) for i, x in enumerate(payloads)], size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    broken = shared_dir(spark)
    spark.createDataFrame([(warc.member(record(1, b"a")) + b"rubbish",)], "value binary").select(F.col("value").cast("string").alias("value")).write.options(**warc._TEXT).text(broken)
    with pytest.raises(Exception, match="chain|record"):
        warc.read(spark, broken).count()


def test_pointer_jumping():
    place, after = np.array([0, 5, 10, 12, 30]), np.array([10, 7, 30, 30, 45])
    assert warc.leaving(place, after, 40).tolist() == [45, -1, 45, 45, 45]
    assert warc.on_chain(place, after, 0).tolist() == [True, False, True, False, True]
    assert warc.on_chain(place, after, 12).tolist() == [False, False, False, True, True]
    assert warc.leaving(np.zeros(0, int), np.zeros(0, int), 0).tolist() == []
    n = 1000
    line = np.arange(n) * 7
    assert (warc.leaving(line, line + 7, 7 * n) == 7 * n).all() and warc.on_chain(line, line + 7, 0).all()


def test_toxicity(spark, docs, none):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 6 == 0
        w = _text(rng, 80).split()
        if toxic:
            for _ in range(6):
                w[rng.randrange(80)] = rng.choice(["idiot", "moron,", "Gruglo", "sc0nk"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(d, lab)
    got = toxicity.score(d, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) > 0.97 * len(held)
    odd = toxicity.score(docs, model)
    assert odd.count() == docs.count() and odd.filter("score is null").count() == 0
    assert toxicity.score(none, model).count() == 0
    bare = toxicity.train(d, lab.limit(0))
    assert toxicity.score(d, bare).filter("score < 0 or score > 1").count() == 0
    kept = toxicity.keep_clean(docs, bare)
    assert kept.columns == docs.columns


def test_isotonic():
    at, value = toxicity.isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(value) >= 0).all() and value[0] == 0 and value[-1] == 1 and len(at) == len(value)


def test_leaks(spark, docs, none):
    rng = random.Random(9)
    items = [(i, _text(rng, rng.randint(3, 40)).capitalize() + ". " + _text(rng, rng.randint(1, 20)).capitalize() + "?") for i in range(30)] + [(90, ""), (91, None), (92, "solo")]
    rows = [(i, f"{_text(rng, rng.randint(0, 80))} {t} {_text(rng, rng.randint(0, 80))}") for i, t in items[:15]]
    rows += [(50 + i, t.upper().replace(" ", "  ") if t else t) for i, t in items[15:30]] + [(200, " ".join(items[3][1].split()[:4])), (201, None), (None, items[4][1]), (202, "solo solo")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(d, bench).collect()}
    assert got == brute.leaks(rows, items)
    assert {(i, i) for i in range(15)} | {(50 + i, i) for i in range(15, 30)} <= got
    assert decontamination.leaks(none, bench).count() == 0 and decontamination.leaks(d, bench.limit(0)).count() == 0
    clean = decontamination.keep_clean(d, bench)
    assert clean.columns == d.columns and {r.doc_id for r in clean.collect()} == {x for x, _ in rows} - {x for x, _ in got}


def test_edited_items_are_leaks(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    items = [(i, " ".join(word() for _ in range(n)) + ". " + " ".join(word() for _ in range(5)) + ".") for i, n in enumerate((11, 17, 23, 29, 40))]
    around = " ".join(word() for _ in range(60))
    rows = []
    for i, text in items:
        w = text.split()
        rows.append((1000 * i, f"{around} {' '.join(w[:-1])} {around}"))
        rows += [(1000 * i + 1 + j, f"{around} {' '.join([*w[:j], word(), *w[j + 1 :]])} {around}") for j in range(len(w))]
    rows += [(9000 + i, f"{around} {' '.join(t.split()[:-5])} {around}") for i, t in items]  # no answer
    rows += [(9100 + i, f"{around} {' '.join(t.split()[-5:])} {around}") for i, t in items]  # no question
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(d, d // 1000) for d, _ in rows if d < 9000}


def test_search_equals_exhaustive_scoring():
    rng = random.Random(4)
    vocabulary = [_text(rng, 1) for _ in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(50)]
    frequency = Counter(x for _, t in items for x in set(decontamination._words(t)[1].tolist()))
    index = decontamination.Index(items, decontamination.Corpus(50, 6.0, frequency))
    for _ in range(100):
        query = sorted(set(rng.choices(range(len(index.terms)), k=8)))
        score = Counter()
        for t in query:
            for i, v in zip(*index.lists[t], strict=True):
                score[i] += v
        bound = index.bounds(np.zeros(len(query), int), np.array(query), 1)[0]
        got = index.search(query, 0.4, np.flatnonzero(bound >= 0.4).tolist())
        assert sorted(i for i, _ in got) == sorted(i for i, v in score.items() if v >= 0.4 - 1e-9)


def test_words_are_those_of_the_patterns():
    texts = ["", "a b c", "É x\x0by", "A1-b_c\x1cd", "中 文"]
    from panelforge.llm.common import ALNUM_WORDS, SPACE_WORDS, Words

    data = b"".join(t.encode() for t in texts)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    for table, pattern in ((SPACE_WORDS, brute.SPACE), (ALNUM_WORDS, brute.ALNUM)):
        w = Words(np.frombuffer(data, np.uint8), offsets, table, lower=True)
        got = [[w.data[s:e].tobytes() for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        assert got == [re.findall(pattern, brute.lower(t)) for t in texts]
