"""Pigeonhole matching against the full edit-distance table."""

import random

from airtrack.llm import decontaminate, queries

DOCS = "doc_id long, text string, item_id string, edits int, id int"
ITEMS = "item_id long, text string, doc_id long, start int"


def distance(pattern, text):
    """Fewest edits between the pattern and any substring of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def spoiled(text, rng, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[at : at + 1] = [] if kind == 0 else [rng.choice("xyz")] if kind == 1 else [out[at], rng.choice("xyz")]
    return "".join(out)


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8)))
    items = [" ".join(word() for _ in range(rng.choice((1, 4, 12, 30)))) for _ in range(12)]
    docs = []
    for k in range(60):
        body = [" ".join(word() for _ in range(rng.randrange(40)))]
        for _ in range(rng.randrange(3)):
            item = rng.choice(items)
            body += [spoiled(item, rng, rng.randrange(0, len(item) // 8 + 1)), word()]
        docs.append(("! ".join(body)).title())
    return items, docs


def test_equals_edit_distance(spark):
    items, docs = corpus()
    found = decontaminate.matches(
        spark.createDataFrame([(i, t, str(i), 0, 0) for i, t in enumerate(docs)], DOCS),
        spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(items)], ITEMS), block_chars=300,
    ).collect()
    want = {}
    for i, doc in enumerate(docs):
        for k, item in enumerate(items):
            pattern = decontaminate.normal(item)
            if (d := distance(pattern, decontaminate.normal(doc))) <= int(len(pattern) * decontaminate.ERROR_RATE):
                want[i, k] = d
    assert {(r.id, r.item_id): r.edits for r in found} == want and len(found) == len(want) > 20
    for r in found:
        assert distance(decontaminate.normal(items[r.item_id]), decontaminate.normal(docs[r.id][r.start : r.end])) == r.edits


def test_leaks_of_real_documents(spark):
    found = {(r.doc_id, r.item_id) for r in queries.op1_decontaminate(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    texts = {d.doc_id: decontaminate.normal(d.text) for d in docs}
    assert {(d, i.item_id) for d, t in texts.items() for i in items if decontaminate.normal(i.text) in t} <= found
    assert len({d for d, _ in found}) < 0.05 * len(docs)


def test_edges(spark):
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    docs = spark.createDataFrame([
        (1, None, "a", 1, 1), (2, "", "a", 1, 1), (3, "The quick brown fox jumps!", "a", 1, 1), (3, "The quick brown fox jumps!", "a", 1, 1),
        (None, "the quick brown fox jumps", None, None, None), (4, "pad " * 60_000 + "the qu1ck brown fox jumps", "", 0, 0), (5, "clean text", "", 0, 0),
    ], DOCS)
    items = spark.createDataFrame([(1, "the quick, brown fox jumps", 1, 1), (1, "the quick, brown fox jumps", 1, 1), (2, None, 1, 1), (None, "?!", 1, 1), (None, "", 1, 1)], ITEMS)
    assert decontaminate.matches(no_docs, items).count() == decontaminate.matches(docs, no_items).count() == 0
    found = sorted(((r.id, r.item_id, r.edits) for r in decontaminate.matches(docs, items).collect()), key=str)
    assert found == [(3, 1, 0), (3, 1, 0), (4, 1, 1), (None, 1, 0)]
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, None], key=str)
