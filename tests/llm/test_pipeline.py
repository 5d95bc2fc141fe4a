"""The corpus pipeline, stage by stage."""

import random

import pytest

from panelforge.llm import packing, toxicity
from tests.llm import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]


def test_stages_keep_columns_on_odd_tables(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (None, "x"), (4, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for start in (docs, docs.limit(0)):
        kept = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == docs.columns
        pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
        assert pieces.count() == kept.count()
        if start is docs:
            assert {r.doc_id for r in kept.collect()} == {1, 3, 4, None}


def test_run_drops_what_is_planted(spark, tmp_path):
    rng = random.Random(5)
    words = lambda n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(n)]
    text = {i: words(120) for i in range(1, 8)}
    passage, item = words(40), words(30)
    text[2] = [*text[1][:-1], *words(1)]  # near copy
    text[3][10:40:6] = ["idiot", "moron", "stupid", "loser", "trash"]
    text[4] = [*text[4], *passage]
    text[6] = [*text[5][:50], *words(1), *passage, *text[6]]  # repeats passages of 4 and 5
    text[7] = [*text[7], *item[:12], *words(1), *item[13:], *text[7][:5]]  # an item with one word changed
    docs = [(i, " ".join(w), "en", "s", len(" ".join(w))) for i, w in text.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows, kind in (("documents", docs, schema), ("labels", [], "doc_id long, quality int, toxic int"), ("benchmark", [(1, " ".join(item))], "item_id long, text string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    left = {1: text[1], 4: text[4], 5: text[5], 6: [text[6][50], *text[6][91:]]}
    want = packing.pack(spark.createDataFrame([(i, " ".join(w)) for i, w in left.items()], "doc_id long, text string"))
    pieces = lambda df: sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert pieces(corpus_pipeline.run(spark, str(tmp_path))) == pieces(want)


def _pieces(docs):
    """Every text's ids with an end id, in pieces of 4096, as the tokenizer itself gives them."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from panelforge.llm import tokens

    t = Tokenizer.from_file(tokens.default_path())
    for d, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[lo : lo + 4096], "<u4")
            yield d, k, lo, len(part), zlib.crc32(part.tobytes())


def _without_passages(docs):
    kept = {d: n for d, _, n, _ in brute.substrings(docs)}
    words = {d: brute.SPACE.findall((t or "").encode()) for d, t in docs}
    least = {}
    for d, w in words.items():
        for i in range(len(w) - 12):
            least[tuple(w[i : i + 13])] = min(d, least.get(tuple(w[i : i + 13]), d))
    out = []
    for d, t in docs:
        gone = {i + j for i in range(len(words[d]) - 12) if least[tuple(words[d][i : i + 13])] < d for j in range(13)}
        assert len(gone) == kept[d]
        out.append((d, b" ".join(w for i, w in enumerate(words[d]) if i not in gone).decode() if gone else t))
    return out


def test_run_equals_the_chained_restatements(spark, tmp_path):
    rng = random.Random(17)
    words = lambda n: ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n)]
    docs = [(i, " ".join(words(rng.randint(1, 200)))) for i in range(40)]
    docs += [(100 + i, docs[i % 10][1]) for i in range(30)]  # exact copies
    for i in range(40):  # near and less near copies
        w = docs[i % 20][1].split()
        for _ in range(rng.randint(0, 1 + len(w) // 12)):
            w[rng.randrange(len(w))] = words(1)[0]
        docs.append((200 + i, " ".join(w)))
    items = [(i, " ".join(words(rng.randint(8, 40)))) for i in range(8)]
    passages = [words(rng.randint(10, 60)) for _ in range(4)]
    for i in range(40):
        extra = [rng.choice(passages), rng.choice(items)[1].split(), rng.choice(passages), ["you", "idiot", "moron"] * rng.randint(0, 1)]
        rng.shuffle(extra)
        docs.append((300 + i, "  ".join([*words(30), *extra[0], *words(20), *extra[1], *words(9)])))
    docs += [(400, None), (401, ""), (402, " \t"), (403, " ".join(words(6000)))]
    rng.shuffle(docs)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(d, t, "en", "s", len(t) if t is not None else None) for d, t in docs]
    for name, data, kind in (("documents", rows, schema), ("labels", [], "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    # without labels the score is the density of insults over itself and SEED_RATE
    seeds = {x.encode() for x in toxicity.INSULTS}
    share = lambda t: sum(w in seeds for w in brute.lower(t).split()) / max(1, len(brute.lower(t).split()))
    left = [(d, t) for d, t in docs if share(t) / (share(t) + toxicity.SEED_RATE) < 0.5]
    assert len(left) < len(docs)
    kept = {d for d, _, _, keep in brute.near(left, size=5) if keep}
    assert len(kept) < len(left)
    left = _without_passages([(d, t) for d, t in left if d in kept])
    leaks = {d for d, _ in brute.leaks(left, items)}
    assert leaks
    want = sorted(_pieces([(d, t) for d, t in left if d not in leaks]))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want
