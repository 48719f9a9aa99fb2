"""Base spans against Python's regular expressions, disclosing terms against counting by hand."""

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airtrack.llm import queries, sanitise


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def digits(value):
    return re.sub("[^0-9]", "", value)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
)


def brute(text):
    return [
        (kind, m.start(), m.end()) for kind, pattern, keep in BASE for m in re.finditer(pattern, text or "") if keep(m.group())
    ]


def spans(frame):
    return {r.id: [(s.kind, s.start, s.stop) for s in r.spans] for r in frame.collect()}


def test_base_spans(spark):
    rng = random.Random(8)
    parts = ["a", "Z9", "@", ".", "_", "%", "+", "-", " ", "é", "😀", "1", "25", "255", "256", "\n", "(", ")", "4111 1111 1111 1111", "0", "x@y.z", "+1 (386) 555-3733", "10.0.0.1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["", None, "a@b.c_d@e.f", "x@y@z.com", "1.2.3.4.5", "00000000001.2.3.4", "4111111111111111", "+12345678901234567", "1" * 50_000, "1 " * 20_000, "a" * 50_000, "+" * 50_000, "a." * 30_000 + "@b.c", "b.c" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert spans(sanitise.find(docs)) == {i: brute(t) for i, t in enumerate(texts)}


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r for r in queries.op8_sanitise(spark, "/root/testdata/sf0.01").collect()}
    assert {i: ",".join(f"{k}:{a}:{b}" for k, a, b in brute(t)) for i, t in texts.items()} == {
        i: ",".join(x for x in r.spans.split(",") if not x.startswith("term")) for i, r in found.items()
    }


def disclosing(texts, disclosure, support):
    lines = [x for t in texts for x in t.split("\n")]
    n, n_t, n_e, n_te, entity_lines, pair_lines = len(lines), defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set), defaultdict(set)

    def terms(text):
        words = re.findall(r"[^\W\d_]{4,}", text.lower())
        return set(words) | {w[: sanitise.STEM] + "*" for w in words}

    for line in lines:
        for t in terms(line):
            n_t[t] += 1
        found = {(k, line[a:b]) for k, a, b in brute(line)}
        blank = line
        for _, v in found:
            blank = blank.replace(v, " ")
        for e in {(k, v.lower() if k == "email" else re.sub("[^0-9.]", "", v)) for k, v in found}:
            n_e[e] += 1
            entity_lines[e].add(line)
            for t in terms(blank):
                n_te[t, e] += 1
                pair_lines[t, e].add(line)
    flagged = {
        t for (t, e), k in n_te.items() if len(pair_lines[t, e]) >= support and len(entity_lines[e]) >= support
        and math.log(k * n / (n_t[t] * n_e[e])) / math.log(n / n_e[e]) >= disclosure
    }
    return {t: None if t[: sanitise.STEM] + "*" in flagged else t[: sanitise.STEM] + "*" for t in flagged if t[-1] != "*"}


def test_disclosing_terms(spark):
    rng = random.Random(9)
    filler = [f"{a}{b}{c}" for a in ("bar", "fol", "gim") for b in ("da", "lo", "tu") for c in ("nek", "sor")]
    line = lambda *more: " ".join([*(rng.choice(filler) for _ in range(6)), *more])
    texts = [line() for _ in range(300)]
    texts += [f"{line('Zorblatt')} mail kim@corp.example today\n{line()}" for _ in range(6)]
    texts += [f"{line('bardaxyl')} or kim@corp.example" for _ in range(6)]
    texts += [f"{line('onecopy')} 10.1.2.3"] * 20
    texts += ["the ZORBLATT again", "zorblatt@corp.example", "zorblatts"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.select(F.col("text"), sanitise.base_spans(F.col("text")).alias("spans"))
    found = {r.term: r.general for r in sanitise.disclosing_terms(rows).collect()}
    assert found == disclosing(texts, sanitise.DISCLOSURE, sanitise.SUPPORT)
    assert "zorblatt" in found and found["zorblatt"] is None and found.get("bardaxyl") == "bard*" and "onecopy" not in found
    marked = sanitise.find(docs)
    held = spans(marked)
    assert held[len(texts) - 3] == [("term", 4, 12)] and ("term", 0, 8) not in held[len(texts) - 2] and held[len(texts) - 1] == []
    clean = {r.id: r.text for r in sanitise.sanitised(marked).collect()}
    assert clean[len(texts) - 3] == "the  again" and clean[len(texts) - 2] == "[EMAIL]" and clean[0] == texts[0]
    assert "zorblatt" not in clean[300].lower() and "[EMAIL]" in clean[300] and "bard*" in clean[306]


def test_edges(spark):
    schema = "doc_id long, text string, spans string, kind int, value string"
    empty = spark.createDataFrame([], schema)
    assert sanitise.find(empty).count() == 0 and sanitise.sanitised(sanitise.find(empty)).count() == 0
    rows = [(None, None, None, None, None), (1, "", "x", 1, ""), (1, "", "x", 1, ""), (2, "a@b.cd", None, 2, "v")]
    found = sanitise.find(spark.createDataFrame(rows, schema))
    assert found.columns == ["id", "text", "spans"] and sorted(len(r.spans) for r in found.collect()) == [0, 0, 0, 1]


if __name__ == "__main__":
    pytest.main([__file__])
