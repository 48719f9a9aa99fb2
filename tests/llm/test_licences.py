"""Licence digests against normalising in Python."""

import re

from airtrack.llm import licences, queries

DOCS = "doc_id long, text string, licence string, digest string, unit int"


def canonical(text):
    text = re.sub(r"^[^\w\n]*(?:copyright(?!\s+(?:holder|notice))|\(c\)|©|all rights reserved)[^\n]*$", "", text, flags=re.I | re.M)
    text = re.sub(r"[\W_]+", " ", text.lower()).strip()
    for other, usual in licences.SPELLINGS:
        text = re.sub(rf"\b{other}\b", usual, text)
    return text


KNOWN = {}
for _name, _text in licences.LICENCES:
    KNOWN.setdefault(canonical(_text), _name)


def brute(text):
    out = {}
    units = [("text", [text]), ("paragraph", re.split(r"\n[ \t]*\n\s*", text)), ("line", text.split("\n"))]
    seen = {}
    for unit, parts in units:
        for part in parts:
            if (key := canonical(part)) in KNOWN:
                seen.setdefault(key, {}).setdefault(unit, 0)
                seen[key][unit] += 1
    for key, by in seen.items():
        unit = next(u for u, _ in units if u in by)
        n = by["line"] if unit == "line" else max(by.get("line", 0), 1)
        out[KNOWN[key], unit] = out.get((KNOWN[key], unit), 0) + n
    return out


def collected(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r[0], {})[r.licence, r.unit] = r.n
    return out


def test_every_known_text_can_be_found():
    assert all(re.search(licences.HINT, t) for _, t in licences.LICENCES)


def test_variants(spark):
    mit = dict(licences.LICENCES[::-1])["MIT"]
    texts = [
        mit, "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + mit.upper(), mit.replace(", ", ",\n   ").replace("sublicense", "sublicence"),
        "Intro\n\n" + mit + "\n\nmore text", "a\nLicensed under CC BY-NC 4.0.\nb\n* licenced under cc-by-nc 4.0\nc", mit[:-10], "x " + mit, "", None, "no hints", "permission",
        "Licensed under CC BY 4.0.", "filler\n" * 20_000 + "Released under the MIT Licence!",
    ]
    docs = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in enumerate(texts)], DOCS)
    assert collected(licences.scan(docs)) == {i: b for i, t in enumerate(texts) if (b := brute(t or ""))}
    assert collected(licences.scan(docs))[1] == {("MIT", "text"): 1}
    assert licences.scan(docs.filter("false")).count() == 0
    twice = docs.unionByName(docs).filter("doc_id = 11 or doc_id is null")
    assert collected(licences.scan(twice)) == {11: {("CC-BY-4.0", "text"): 2}}


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert collected(queries.op4_licences(spark, "/root/testdata/sf0.01")) == {d.doc_id: b for d in docs if (b := brute(d.text))}
