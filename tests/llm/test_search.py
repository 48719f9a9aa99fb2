import math
import random
import re
from collections import Counter

from airtrack.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(text):
    return Counter(t.translate(LOWER) for t in TERM.findall(text or ""))


def brute(docs, items, listed=20):
    """Every document scored for every query."""
    counts = [(i, counted(t)) for i, t in docs]
    n, total = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df, out = Counter(t for _, c in counts for t in c), []
    queries = {}
    for item, text in items:
        if item is not None:
            queries.setdefault(item, Counter()).update(counted(text))
    for item, terms in queries.items():
        scores = []
        for i, c in counts:
            if i is None or not c:
                continue
            m = 100 - 25 + 25 * c.total() * n // total
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                for t, r in terms.items() if c[t]
            )
            scores += [(-score, i)] * (score > 0)
        out += [(item, k, i, -s) for k, (s, i) in enumerate(sorted(scores)[:listed], 1)]
    return sorted(out)


def result(spark, docs, items, parts=5, **more):
    docs = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item long, rank string").repartition(parts)
    items = spark.createDataFrame([(*i, 2, "y") for i in items], "item_id long, text string, id long, score string")
    return sorted(map(tuple, search.search(docs, items, **more).collect()))


def corpus(seed, n=400):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(600)] + ["The", "the", "THE", "été", "Ünder", "9", "x1y2"]
    weights = [1 / (k + 1) for k in range(len(words))]

    def text(size):
        return draw.choice([" ", "-", ", "]).join(draw.choices(words, weights, k=size))

    docs = [(i, text(draw.randrange(1, 120))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "... !"), (None, text(40)), (n + 3, text(60_000)), (7, docs[7][1]), (9, text(30))]
    docs += [(n + 10 + i, docs[3][1]) for i in range(60)]
    items = [(i, text(draw.randrange(1, 60))) for i in range(12)]
    items += [(50, docs[3][1]), (51, None), (52, "unheard"), (53, "w0 w0 the"), (None, "w1"), (54, ""), (50, "w5"), (55, docs[4][1][:50])]
    return docs, items


def test_equals_scoring_everything(spark, monkeypatch):
    docs, items = corpus(0)
    want = brute(docs, items)
    assert result(spark, docs, items) == want
    # few places and few first candidates: bounds are loose and several turns are needed; queries in several batches
    monkeypatch.setattr(search, "PLACES", 16)
    monkeypatch.setattr(search, "FIRST", 2)
    monkeypatch.setattr(search, "GROWTH", 8)
    monkeypatch.setattr(search, "BATCH_TERMS", 250)
    assert result(spark, docs, items) == want


def test_few_documents_and_empty_tables(spark):
    docs, items = [(1, "a b"), (2, "a"), (3, None)], [(1, "a"), (2, "b a"), (3, "z")]
    assert result(spark, docs, items) == brute(docs, items)
    assert result(spark, docs, []) == result(spark, [], items) == result(spark, [(1, None), (2, "")], items) == []


def test_bounds_are_never_below_scores(spark):
    docs, items = corpus(5, 80)
    docs = [d for d in docs if d[0] is not None]
    counts = {i: counted(t) for i, t in docs}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    n, total = sum(1 for i, t in docs if counted(t)), sum(counted(t).total() for _, t in docs)
    rows = [{"item": i, "term": t.encode(), "repeats": r} for i, text in enumerate(x[1] for x in items) for t, r in counted(text).items()]
    queries = search._Batch(rows, {r["term"]: 1000 for r in rows}, frame.schema["doc_id"].dataType)
    found = search.candidates(search.index(frame).filter("n > 0"), queries, n, total, beat={}).collect()
    bounds = {(r["item"], r["id"]): r["bound"] for r in found}
    for i, c in counts.items():
        for item, parts in queries.plain.items():
            score = sum(w * search.impact(c[t.decode()], search.normalised(c.total(), n, total)) for t, w in parts if c[t.decode()])
            assert bounds.get((item, i), 0) >= score
