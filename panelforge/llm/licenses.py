"""License scans by diagonal voting.

Templates are the base phrases, found wherever their words stand one after the
other, and, found also where words differ, single sentences of our choice and
the published texts of license_texts. All rolling
hashes of k words of the documents are joined with the templates' positions
(k is the phrase's length, GRAM words for the texts). Matches are summed by
diagonal, the offset between document and template. Neighbouring diagonals, as
an added or a lost word makes them, merge if they are at most DRIFT, or one word
in DRIFT_SHARE of the template, apart and their places meet. A merged span is verified by the share of the template's
grams it holds (LEAST) and by its length.

Rolling hashes that no template has are dropped before they leave the worker,
by a look-up in the templates' few hashes; those of base phrases are compared
byte by byte. The score is 1 where a base phrase stands, else the best verified
share, else 0. Null and empty texts have no words. Repeated rows are scanned each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import ALNUM_WORDS, Words, pick, slices, slim, small_batches
from panelforge.llm.license_texts import PUBLISHED

#: Phrases and labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Sentences of our own choice, as words after lower-casing.
SENTENCES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may obtain a copy of the license at http www apache org licenses license 2 0", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl-notice"),
    ("this work is licensed under a creative commons attribution", "creative-commons"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "cc0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
)
GRAM = 3
TEXTS = SENTENCES + tuple((text.lower(), label) for label, text in PUBLISHED)
LEAST = 0.7
DRIFT, DRIFT_SHARE = 2, 20

HITS = "uid long, doc_id long, n_words long, hits array<struct<pos: long, gram: long>>"


def _as_words(text: str) -> Words:
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), ALNUM_WORDS)


def _grams() -> list[tuple[int, int, int, int, int, int, str]]:
    """(gram, template, its place, k, words and grams of the template, label); base templates have negative numbers."""
    rows = []
    for base, templates in ((True, BASE), (False, TEXTS)):
        for number, (text, label) in enumerate(templates):
            w = _as_words(text)
            k = len(w) if base else GRAM
            at, keys = w.windows(w.hashes(), k, seed=100 + k if base else 200 + k)
            rows += [(int(g), -1 - number if base else number, int(p), k, len(w), len(at), label) for p, g in zip(at, keys.view(np.int64), strict=True)]
    return rows


@slim
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = _grams()
    base = {}
    for g, number, _, k, *_ in grams:
        if number < 0:
            base.setdefault(k, {})[g] = BASE[-1 - number][0].encode().split()
    texts = np.unique(np.array([g[0] for g in grams if g[1] >= 0], dtype=np.int64))
    uid = TaskContext.get().partitionId() << 33
    kind = pa.list_(pa.struct([("pos", pa.int64()), ("gram", pa.int64())]))
    for b in batches:
        for lo, hi, data, offsets in slices(b.column("text")):
            w = Words(data, offsets, ALNUM_WORDS, lower=True)
            h = w.hashes()
            places, keys = [], []
            for k, phrases in base.items():
                at, gram = w.windows(h, k, seed=100 + k)
                gram = gram.view(np.int64)
                for g, words in phrases.items():
                    for i in at[gram == g].tolist():
                        if [w.data[s:e].tobytes() for s, e in zip(w.starts[i : i + k], w.ends[i : i + k], strict=True)] == words:
                            places.append([i]), keys.append([g])
            at, gram = w.windows(h, GRAM, seed=200 + GRAM)
            gram = gram.view(np.int64)
            hit = texts[np.minimum(np.searchsorted(texts, gram), len(texts) - 1)] == gram
            places.append(at[hit]), keys.append(gram[hit])
            place, gram = np.concatenate(places).astype(np.int64), np.concatenate(keys).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, gram = place[order], gram[order]
            owner = w.owner[place]
            cuts = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(place - w.first[owner]), pa.array(gram)], names=["pos", "gram"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + hi - lo)), b.column("doc_id").slice(lo, hi - lo), pa.array(w.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(cuts), values).cast(kind)],
                names=["uid", "doc_id", "n_words", "hits"],
            )
            uid += hi - lo


def scan(documents: DataFrame) -> DataFrame:
    """One row per row of documents (doc_id, text): words, base places and labels, all labels, spans of the texts, and the score."""
    spark = documents.sparkSession
    small_batches(spark)
    templates = spark.createDataFrame(_grams(), "gram long, template int, place int, k int, words int, grams int, label string")
    found = pick(documents, doc_id="long", text="string").mapInArrow(_scan, HITS)
    each = found.select("uid", "doc_id", "n_words", F.explode_outer("hits").alias("hit")).select("uid", "doc_id", "n_words", F.col("hit.pos").alias("pos"), F.col("hit.gram").alias("gram"))
    votes = each.join(F.broadcast(templates), "gram", "left")  # a row per place of the templates, some thousands
    doc = ["uid", "doc_id", "n_words"]
    which = ["template", "words", "grams", "label"]
    lines = votes.repartition("uid").groupBy(*doc, *which, (F.col("pos") - F.col("place")).alias("diagonal")).agg(F.count("pos").alias("votes"), F.min("pos").alias("lo"), F.max(F.col("pos") + F.col("k")).alias("hi"))
    at = Window.partitionBy("uid", "template").orderBy("diagonal")
    before = lambda c: F.lag(c).over(at)
    drift = F.greatest(F.lit(DRIFT), F.ceil(F.col("words") / DRIFT_SHARE))
    meets = (F.col("diagonal") - before("diagonal") <= drift) & (F.col("lo") <= before("hi") + F.col("words")) & (before("lo") <= F.col("hi") + F.col("words")) & (F.col("template") >= 0)
    spans = lines.withColumn("new", F.when(meets, 0).otherwise(1)).withColumn("span", F.sum("new").over(at))
    spans = spans.groupBy(*doc, *which, "span").agg(F.sum("votes").alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    share = F.least(F.col("votes") / F.col("grams"), F.lit(1.0))
    fine = (share >= LEAST) & (F.col("hi") - F.col("lo") <= F.col("words") + F.greatest(F.lit(2), F.ceil(F.col("words") / 4)))
    base, own = F.col("template") < 0, (F.col("template") >= 0) & fine
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    place = F.struct(F.col("lo").alias("first"), F.col("hi").alias("last"), F.col("label").alias("label"), share.alias("share"))
    return spans.groupBy(*doc).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("lo"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("lo"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(base | own, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(base, 1.0).when(own, share)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(own, place))).alias("spans"),
    ).drop("uid")
