"""The Kneser-Ney model against the textbook recursion, and labelled documents."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from airtrack.llm import quality, queries

DOCS = "doc_id long, text string, lang string, loss int, model string"
LABELS = "doc_id long, quality int, toxic int, text string"


class Textbook:
    def __init__(self, texts, order):
        self.order = order
        self.counts = {order: Counter()}
        for t in texts:
            t = b"\n" * (order - 1) + t
            self.counts[order].update(t[i : i + order] for i in range(len(t) - order + 1))
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.v = len(self.counts[1]) + 1
        self.cut = {}
        for k, c in self.counts.items():
            n = [0, *(sum(x == i for x in c.values()) for i in (1, 2, 3, 4))]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
            self.cut[k] = [0] + [
                min(0.95 * i, max(0.1, i - (i + 1) * y * n[i + 1] / n[i]) if y is not None and n[i] else 0.5 * i) for i in (1, 2, 3)
            ]

    def p(self, context, byte):
        if not context and byte is None:
            return 1 / self.v
        k = len(context) + 1
        own = {g[-1]: c for g, c in self.counts[k].items() if g[:-1] == context}
        shorter = self.p(context[1:], byte) if context else 1 / self.v
        if not own:
            return shorter
        total, cut = sum(own.values()), self.cut[k]
        left = sum(cut[min(3, c)] for c in own.values()) / total
        c = own.get(byte, 0)
        return max(c - cut[min(3, c)], 0) / total + left * shorter


def test_model_equals_textbook(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aaab cé") for _ in range(200)) for _ in range(5)]
    packed = quality.model(spark.createDataFrame([("x", t) for t in texts], "lang string, text string"))
    (scorer,) = quality._scorers(packed).values()
    book = Textbook([t.encode() for t in texts], quality.ORDER)
    seen = sorted({b for t in texts for b in t.encode()})
    for context in (b"\n\n\n", b"aaa", b"ab ", b"c\xc3\xa9", b"zzz", b"azz", "é".encode() + b"b"):
        total = sum(book.p(context[-3:], b) for b in seen) + book.p(context[-3:], 0)
        assert total == pytest.approx(1)
    for t in ("abc aab", "z", "éa zb", "aaaaaaaa"):
        raw = t.encode()
        padded = b"\n" * 3 + raw
        want = -sum(math.log(book.p(padded[i : i + 3], padded[i + 3])) for i in range(len(raw)))
        assert scorer.losses([raw])[0] == pytest.approx(want, rel=1e-5)
    many = [t.encode() for t in texts] + [b"z", b"ab"]
    assert np.allclose(scorer.losses(many), [scorer.losses([t])[0] for t in many])


def test_model_counts_whole_texts_of_all_trusted_documents(spark):
    rng = random.Random(4)
    texts = ["ab" * 800 + "".join(rng.choice("xyzé ") for _ in range(30)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x", 1, "m") for i, t in enumerate([*texts, "qqqq" * 500])], DOCS)
    labels = spark.createDataFrame([(i, 1, 0, "t") for i in range(300)] + [(300, 0, 0, "t")], LABELS)
    (scorer,) = quality._scorers(quality.model(quality.training_text(docs, labels))).values()
    book = Textbook([t.encode() for t in texts], quality.ORDER)
    raw = texts[0].encode()[1590:] + b"q"
    padded = b"\n" * 3 + raw
    want = -sum(math.log(book.p(padded[i : i + 3], padded[i + 3])) for i in range(len(raw)))
    assert scorer.losses([raw])[0] == pytest.approx(want, rel=1e-5)


def test_labelled_documents(spark):
    found = {r.doc_id: r for r in queries.op3_quality(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    kept = defaultdict(list)
    for r in labels:
        if r.doc_id in found and r.quality is not None:
            kept[r.quality].append(found[r.doc_id].kept)
    assert len(found) == 10_000 and np.mean(kept[1]) > 0.99 and np.mean(kept[0]) < 0.3


def test_edges(spark):
    docs = spark.createDataFrame(
        [(i, "the water of the other things " * (1 + i % 5), "en", 1, "m") for i in range(60)]
        + [(100, None, "en", 1, "m"), (101, "", "en", 1, "m"), (102, "&&%%$$ qqzzxx " * 30, "en", 1, "m"), (103, "the water of things " * 5, None, 1, "m"),
           (104, "the other water " * 5, "xx", 1, "m"), (104, "the other water " * 5, "xx", 1, "m"), (None, "the water", "en", None, None), (105, "the water of " * 20_000, "en", 1, "m")],
        DOCS,
    )
    labels = spark.createDataFrame([(i, 1, 0, "t") for i in range(60)] + [(3, 1, 0, "t"), (None, 1, 0, "t"), (5, None, None, None), (102, 0, 0, "t")], LABELS)
    found = {}
    for r in quality.judged(docs, labels).collect():
        found.setdefault(r.id, []).append(r)
    assert sum(map(len, found.values())) == docs.count()
    assert all(found[i][0].kept for i in range(60)) and not found[102][0].kept
    assert not found[100][0].kept and found[101][0].perplexity is None and len(found[104]) == 2 and found[103][0].model == "en"
    kept = quality.filtered(docs, labels)
    assert kept.columns == docs.columns and 3 in {r.doc_id for r in kept.collect()}
    none = labels.filter("false")
    assert not any(r.kept for r in quality.judged(docs, none).collect())
    assert quality.judged(docs.filter("false"), labels).count() == 0
