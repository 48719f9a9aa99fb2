"""Refinement against grouping whole texts."""

import hashlib

import duckdb
import pytest

from airtrack.llm import exact_dedup, oracles, queries
from checks import compare

SCHEMA = "doc_id long, text string, length string, head int, keep_id long, id string"
ROWS = [
    (1, "same", None, 1, 1, "x"), (5, "same", None, 1, 1, "x"), (3, "same", None, 1, 1, "x"), (4, "sam3", None, 1, 1, "x"),
    (6, None, "a", 1, 1, "x"), (7, "", "a", 1, 1, "x"), (8, "p" * 300 + "a", "a", 1, 1, "x"), (9, "p" * 300 + "b", "a", 1, 1, "x"),
    (None, "same", None, 1, 1, "x"), (10, "alone", None, 1, 1, "x"), (11, "é" * 300, "", 2, 2, ""), (12, "é" * 300, "", 2, 2, ""),
    (12, "é" * 300, "", 2, 2, ""), (13, "w " * 100_000, "", 2, 2, ""), (14, "w " * 100_000, "", 2, 2, ""),
]


def wanted(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("digests", [True, False])
def test_groups(spark, digests):
    found = exact_dedup.duplicates(spark.createDataFrame(ROWS, SCHEMA).repartition(3), digests=digests).collect()
    want = wanted(ROWS)
    if digests:
        assert sorted(map(tuple, found), key=str) == want
    else:
        assert sorted(map(tuple, found), key=str) == sorted((w[:4] for w in want if w[2] > 1), key=str)


def test_kept_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([5, 4, 7, 8, 9, None, 10, 12, 12, 14], key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.deduplicated(empty).count() == exact_dedup.duplicates(empty, digests=True).count() == 0


def test_query(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    assert compare.difference(queries.op6_exact_dedup(spark, "/root/testdata/sf0.01"), con, oracles.OP6) is None
