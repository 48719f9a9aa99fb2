"""Patience alignment and the removal of repeated blocks."""

import random

from airtrack.llm import line_dedup, queries

DOCS = "doc_id long, text string, line string, hashes int, id string"


def brute(docs, least, anchor):
    """Align every later document with the first holder of each of its shared lines."""
    first = {}
    for i in sorted(docs):
        for line in docs[i].split("\n"):
            first.setdefault(line, i)
    out = {}
    for i in docs:
        b = docs[i].split("\n")
        gone = set()
        for p in {first[x] for x in b if len(x) >= anchor and first[x] != i}:
            gone |= set(line_dedup.common_lines(docs[p].split("\n"), b, [len(x) for x in b], least))
        out[i] = "\n".join(x for k, x in enumerate(b) if k not in gone)
    return out


def test_patience():
    rng = random.Random(7)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(30))]
        b = [rng.randrange(12) for _ in range(rng.randrange(30))]
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(line_dedup.patience(a, a)) == len(a)
    assert line_dedup.patience([1, 2, 3, 9, 4], [7, 2, 3, 4, 1]) == [(1, 1), (2, 2), (4, 3)]


def corpus(seed):
    rng = random.Random(seed)
    line = lambda: f"line {rng.randrange(10**9)} " + "x" * rng.randrange(0, 40)
    passages = [[line() for _ in range(rng.randrange(1, 5))] for _ in range(8)]
    docs = {}
    for i in range(60):
        lines = [line() for _ in range(rng.randrange(0, 8))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = rng.choice(passages)
        docs[i] = "\n".join([*lines, rng.choice(["", "short", "---"])])
    docs |= {100 + k: docs[5] for k in range(30)}
    return docs


def test_equals_brute_force(spark):
    docs = corpus(1)
    rows = [(i, t, "l", 1, "x") for i, t in docs.items()]
    found = line_dedup.deduplicated(spark.createDataFrame(rows, DOCS).repartition(3))
    assert found.columns == ["doc_id", "text", "line", "hashes", "id"]
    got = {r.doc_id: r.text for r in found.collect()}
    assert got == brute(docs, line_dedup.MIN_BLOCK_CHARS, line_dedup.MIN_ANCHOR_CHARS) and got != docs


def test_edges(spark):
    assert line_dedup.deduplicated(spark.createDataFrame([], DOCS)).count() == 0
    long = "\n".join(f"line number {k} of the long text" for k in range(20_000))
    block = "the first line of the block\nthe second line of the block"
    rows = [(1, None, None, None, None), (2, "", "l", 1, "x"), (None, block, "l", 1, "x"), (3, block, "l", 1, "x"), (3, block, "l", 1, "x")]
    rows += [(4, "own\n" + block, "l", 1, "x"), (5, long, "l", 1, "x"), (6, long + "\nmore", "l", 1, "x"), (7, "the first line of the block", "l", 1, "x")]
    got = {}
    for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got == {1: [None], 2: [""], None: [block], 3: [block, block], 4: ["own"], 5: [long], 6: ["more"], 7: [rows[-1][1]]}


def all_pairs(docs, least):
    """Every common block of lines of every two documents."""
    texts, out = {i: t.split("\n") for i, t in docs.items()}, {}
    for i, b in texts.items():
        gone = set()
        for a in (t for p, t in texts.items() if p < i):
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                        n += 1
                    if sum(map(len, b[y : y + n])) >= least:
                        gone |= set(range(y, y + n))
        out[i] = "\n".join(t for k, t in enumerate(b) if k not in gone)
    return out


def test_every_repeated_block_goes(spark):
    rng = random.Random(5)
    docs = corpus(1)
    first, second, third = "the first line that is held by several texts", "a second line that is held by several texts", "third line of 25 characters"
    verse = "\n".join(f"verse {k} of a" for k in range(6))
    docs |= {200: f"{first}\nx\n{second}", 201: f"{second}\ny\n{first}", 202: f"{first}\nz\n{first}", 203: "25 characters of line one\nD", 204: third}
    docs |= {205: f"b\n25 characters of line one\n{third}", 206: f"c\n25 characters of line one\n{third}", 207: verse, 208: "own\n" + verse}
    docs |= {300 + k: "\n".join(rng.choice(["", "ten chars.", "twenty characters ..", "a", "line of forty characters or some more ..."]) for _ in range(12)) for k in range(25)}
    rows = [(i, t, "l", 1, "x") for i, t in docs.items()]
    got = {r.doc_id: r.text for r in line_dedup.without_repeats(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert got == all_pairs(docs, line_dedup.MIN_BLOCK_CHARS)
    assert got[201] == "y" and got[202] == "z" and got[206] == "c" and got[208] == "own"
    edges = [(1, None, None, None, None), (2, "", "l", 1, "x"), (None, first, "l", 1, "x"), (3, first, "l", 1, "x"), (3, first, "l", 1, "x"), (4, "own\n" + first, "l", 1, "x")]
    kept = sorted((r.doc_id or 0, r.text) for r in line_dedup.without_repeats(spark.createDataFrame(edges, DOCS)).collect())
    assert kept == [(0, first), (1, None), (2, ""), (3, first), (3, first), (4, "own")]
    assert line_dedup.without_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_query_removes_crossed_and_short_lines(spark, tmp_path):
    long, other = "the first line that is held by several texts", "a second line that is held by several texts"
    verse = "\n".join(f"verse {k} of a" for k in range(6))
    rows = [(1, f"{long}\nx\n{other}"), (2, f"{other}\ny\n{long}"), (3, verse), (4, "own\n" + verse)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: rows[0][1], 2: "y", 3: verse, 4: "own"}
