"""Targets against filling level by level, copies against their bounds and expectations."""

import random
import re

from airtrack.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target int, p double"


def filled(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, stop sources at their limit, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        rest = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def corpus(seed, n=3000):
    rng, rows = random.Random(seed), []
    for i in range(n):
        source = rng.choices(["a", "b", "B", "é", None, "tiny"], [30, 5, 3, 2, 2, 0.2])[0]
        rows.append((i, " ".join(["w"] * int(rng.lognormvariate(3, 1))), source, None, None, None))
    return rows


def check(rows, found):
    size_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + size_of(r[1])
    target = filled(sizes)
    assert len(found) == len(rows)
    for s, total in sizes.items():
        own = [r for r in found if r.source == s]
        assert {r.source_size for r in own} == {total}
        assert all(abs(r.target - target[s]) < 1e-6 * max(1, total) for r in own)
        assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in own)
        assert all(abs(r.copies - target[s] / total) < 1 for r in own if r.size and total)
        assert abs(sum(r.taken for r in own) - target[s]) <= max(r.size for r in own) / 2 + 1e-6
    return sizes


def test_many_documents(spark):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.mix(docs.repartition(5)).collect()
    check(rows, found)
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted((r.id, r.copies) for r in found) == sorted((r.id, r.copies) for r in again)


def test_expected_copies(spark):
    """Over many seeds a document is taken as often as its source's rate says."""
    rows = [(i, "w " * (1 + i % 7), "a" if i % 3 else "b", None, None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    counts, rates, runs = {}, {}, 25
    for seed in range(runs):
        for r in mixing.mix(docs, seed=seed, chunk=8).collect():
            counts[r.id] = counts.get(r.id, 0) + r.copies
            rates[r.id] = r.target / r.source_size
    assert abs(sum(counts.values()) / runs - sum(rates.values())) < 1.5
    assert sum(abs(counts[i] / runs - rates[i]) for i in rates) / len(rates) < 0.15


def test_edges(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, "a", "s", 1, 0.5), (2, "", "a", "s", 1, 0.5), (None, "x y", None, None, None, None)]
    rows += [(7, "w w w", "hot", "s", 1, 0.5)] * 50 + [(8, "one\ttwo  three", "hot", "s", 1, 0.1), (9, "long " * 50_000, "z", "", 1, 1.0)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes = {"a": 0, None: 2, "hot": 153, "z": 50_000}
    target = filled(sizes)
    assert len(found) == len(rows) and {r.source: r.source_size for r in found} == sizes
    assert all(abs(r.target - target[r.source]) < 1e-3 and r.copies <= 3 for r in found)
    assert abs(sum(r.taken for r in found if r.source == "hot") - target["hot"]) <= 3
    only_empty = spark.createDataFrame(rows[:2], SCHEMA)
    assert [r.taken for r in mixing.mix(only_empty).collect()] == [0, 0]
