"""The n-gram join against comparing all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from airtrack.llm import shingle_join
from airtrack.llm.components import components


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids, holders = sorted(sets), {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for i in ids:
        for j in {j for s in sets[i] for j in holders[s] if j > i}:
            both = len(sets[i] & sets[j])
            if both * 100 >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(frame):
    return {r.id: (r.n_shingles, r.component) for r in frame.collect()}


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    """Families of near copies around the thresholds, passages shared by unlike texts, short and empty texts."""
    rng, rows = random.Random(seed), []
    passage = [f"p{k}" for k in range(60)]
    for family in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice((8, 9, 12, 15, 20, 30, 60, 150, 400)))]
        for _ in range(rng.choice((2, 4, 12))):
            rows.append(edited(base, rng, rng.randrange(0, max(2, len(base) // 12))))
    for _ in range(30):
        rows.append(" ".join([*(f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 40))), *passage]))
    rows += ["", None, "one", "one two", "ONE  two", "one two\tthree", "É a b c", "é a b c"]
    return list(enumerate(rows))


@pytest.mark.parametrize("n, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 80, 3)])
def test_equals_all_pairs(spark, n, percent, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(shingle_join.similar_components(docs, n=n, percent=percent)) == brute(rows, n, percent)


@pytest.mark.parametrize("edits", [3, 6, 10])
def test_large_group_of_near_copies(spark, edits):
    """Members are similar to some of the group only, and linked through others."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, edited(base, rng, rng.randrange(0, edits))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(shingle_join.similar_components(docs, n=3, percent=90)) == brute(rows, 3, 90)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(shingle_join.similar_components(docs, n=3, percent=90)) == brute(rows, 3, 90)


def test_edges(spark):
    schema = "doc_id long, text string, sig long, a long, n_shingles string"
    empty = spark.createDataFrame([], schema)
    assert shingle_join.similar_components(empty).count() == 0
    rows = [(1, "a b c d e f", 0, 0, ""), (1, "a b c d e f", 0, 0, ""), (None, "a b c d e f", 0, 0, ""), (3, "a b c d e f", 0, 0, None), (4, None, 0, 0, "")]
    docs = spark.createDataFrame(rows, schema)
    found = sorted(shingle_join.similar_components(docs).collect(), key=str)
    assert [tuple(r) for r in found] == [(1, 2, 1), (1, 2, 1), (3, 2, 1), (4, 0, 4), (None, 2, None)]
    kept = shingle_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "4", "None"]


def test_long_text_and_signatures():
    text = b" ".join(b"w%d" % (k % 5000) for k in range(200_000))
    (grams,) = shingle_join.shingle_sets([text], 3)
    assert len(grams) == 5000
    marks, filled = shingle_join.Cuts(90).signatures(grams)
    assert filled[0] > 2 * 0.0526 * 5000


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 300)] + [(1000 - k, 500) for k in range(0, 300)]
    random.Random(1).shuffle(chain)
    found = components(spark.createDataFrame(chain, "a long, b long"))
    assert {r.component for r in found.filter(F.col("id") <= 300).collect()} == {0}
    assert {r.component for r in found.filter(F.col("id") > 300).collect()} == {500}
    assert found.count() == 602
