import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from airtrack.llm import packing, queries
from tests.conftest import SCALE

PATH = public_tokenizers.path("word_bpe_49k.json")
MODEL = Tokenizer.from_file(PATH)
STRANGE = [
    None, "", " ", "\n\n \t", "one", "It's   the end. Don't\tstop", "a ́b é ́", "x" * 9000, "ΣΑΣ σας <|endoftext|> <|startoftext|>9",
    "中文 文字\x0bvt\x1ffs\x85nel", "İstanbul ﬁne ½ ² Ⅷ", "word " * 30000, "same text", "same text", "Été, ÀÉÎ-à ÿß! naïve... don't l'été <b> <|x a<|endoftext|>b (HELLO) [ok] co-op «q» e\u0301te\u0301 ﬀ ŒUVRE ",
    "😀 emoji 👩‍👩‍👧 1234567",
]


def expected(text, end=2):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [end]


def check(rows, texts, capacity):
    """Every token lies in exactly one piece, pieces of a sequence follow each other from 0, ids are those of the whole text."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert docs.keys() == texts.keys()
    for key, parts in docs.items():
        parts.sort(key=lambda r: r["start"])
        want = expected(texts[key])
        assert [r["start"] for r in parts] == list(np.cumsum([0] + [r["length"] for r in parts[:-1]]))
        assert b"".join(r["ids"] for r in parts) == np.array(want, "<u4").tobytes()
        assert {r["doc_tokens"] for r in parts} == {len(want)}
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0] + [p[1] for p in parts[:-1]])) and sum(p[1] for p in parts) <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(capacity - sum(p[1] for p in parts) for parts in sequences.values()), len(sequences)


def test_cuts_are_reciprocal_and_whole():
    sizes = set(packing.reciprocal_sizes(4096))
    for n in range(0, 20000, 7):
        parts = packing.cut(n)
        assert sum(parts) == n and sizes.issuperset(parts) and len(parts) <= n // 4096 + 8
        assert n % 4096 < 16 or min(parts) >= 16


@pytest.mark.parametrize("seed", range(20))
def test_last_bins_hold_all_pieces(seed):
    draw = random.Random(seed)
    left = {s: draw.randrange(4096 // s) for s in packing.reciprocal_sizes(4096)}
    runs = packing.last_bins(left, 4096)
    for length, n in left.items():
        assert sorted(x for r in runs if r[0] == length for x in range(r[1], r[1] + r[2])) == list(range(n))
    bins = {}
    for length, _, count, place, at in runs:
        bins.setdefault(place, []).append((at, length * count))
    for parts in bins.values():
        assert [p[0] for p in parts] == list(np.cumsum([0] + [p[1] for p in parts[:-1]])) and sum(p[1] for p in parts) <= 4096
    assert len(bins) <= -(-sum(s * n for s, n in left.items()) // 4096) + 1


def test_strange_texts_and_clashing_columns(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(STRANGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, number long").repartition(3)
    for capacity in (4096, 64):
        check(packing.pack(docs, PATH, capacity=capacity).collect(), {i: t for i, t, _, _ in rows}, capacity)


def test_empty_table_null_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema), PATH).count() == 0
    found = packing.pack(spark.createDataFrame([(None, "a b"), (None, None), (1, "c"), (1, "c")], schema), PATH).collect()
    assert sorted((r["id"] or 0, r["doc_tokens"]) for r in found) == [(0, 1), (0, 3), (1, 2), (1, 2)]
    assert {r["sequence_id"] for r in found} == {0}


def test_query_is_whole_and_tight(spark):
    docs = spark.read.parquet(f"{SCALE}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    whole = packing.pack(docs.repartition(8), PATH).collect()
    padding, sequences = check(whole, texts, 4096)
    assert padding <= 0.005 * 4096 * sequences + 4096
    found = queries.op13_packing(spark, SCALE).collect()
    assert sum(r["length"] for r in found) == sum(r["length"] for r in whole)
    for r in found:
        part = expected(texts[r["doc_id"]])[r["start"]: r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
