"""Cross-parsing against a direct count of longest matches, and held-out accuracy."""

import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from airtrack.llm import language, queries

SCHEMA = "doc_id long, text string, lang string, id string, score int"


def phrases(text, sample):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in sample:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


def test_phrases_equal_longest_matches():
    rng = random.Random(5)
    samples = [bytes(rng.choice(b"abc ") for _ in range(300)), bytes(rng.choice(b"bcd ") for _ in range(200))]
    texts = [bytes(rng.choice(b"abcdx ") for _ in range(rng.choice((1, 5, 80, 1024, 3000)))) for _ in range(40)]
    _, code, table, columns = language._model((("a", samples[0]), ("b", samples[1])))
    got = language.phrases(texts, code, table, columns[:, 0]) - 1
    for text, row in zip(texts, got):
        for sample, n in zip(samples, row):
            want = 0
            for at in range(0, len(text), language.BLOCK):
                block = text[at : at + language.BLOCK]
                known = re.split(b"[^%s]" % re.escape(bytes(set(sample))), block)
                # a byte that the sample does not hold ends a phrase; the one that the block cuts off is not counted
                want += len(known) - 1 + sum(phrases(part, sample) - 1 for part in known if part)
            assert n == want


def test_letters():
    assert language.letters("  Ab-C1d“É”x_y  ") == "ab c d é x y".encode()
    assert language.letters(None) == language.letters("") == language.letters("12 !? 💡") == language.letters("½ ² 123 Ⅷ ①") == b""


def test_held_out_accuracy(spark):
    found = queries.op5_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = found.join(docs, "doc_id").filter("lang is not null").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in unseen]) > 0.98
    assert np.mean([r.lang == r.lang_pred for r in unseen if len(r.text) > 100]) == 1


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert language.sample(empty) == {} and language.predict(empty, {}).count() == 0 and language.known(empty).count() == 0
    rows = [(i, f"the water of {i} and the other things", "en", "x", 1) for i in range(30)]
    rows += [(100 + i, f"das wasser von {i} und die anderen dinge", "de", "x", 1) for i in range(30)]
    rows += [(200, None, "en", "x", 1), (201, "12 34", "fr", "x", 1), (202, "", None, "x", 1), (203, "the other water " * 20_000, None, None, None)]
    rows += [(204, "und das andere", None, "x", 1)] * 3 + [(None, "the water", "en", "x", 1), (None, None, "en", "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    samples = language.sample(docs)
    assert set(samples) == {"en", "de"} and samples == language.sample(docs.repartition(3))
    found = {}
    for r in language.predict(docs, samples).collect():
        found.setdefault(r.id, []).append((r.lang_pred, r.score))
    assert found[200] == found[201] == found[202] == [("und", 0.0)]
    assert found[203][0][0] == "en" and [x[0] for x in found[204]] == ["de"] * 3 and len(found[None]) == 2
    kept = language.known(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    nothing = language.predict(docs, {})
    assert {r.lang_pred for r in nothing.select("lang_pred").distinct().collect()} == {"und"}
    one = language.predict(docs.filter(F.col("doc_id") == 0), {"en": samples["en"]}).first()
    assert (one.lang_pred, one.score) == ("en", 1.0)
