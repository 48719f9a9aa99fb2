import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from airtrack.llm import divergence

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, listed):
    """The contract, term by term."""
    holders, counts, groups = defaultdict(set), defaultdict(Counter), set()
    for i, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in LETTERS.findall(text or ""):
            term = term.translate(LOWER)
            holders[lang, term].add(i)
            counts[lang, source][term] += 1
    out = []
    for lang, source in groups:
        kept = [t for (x, t), docs in holders.items() if x == lang and len(docs) >= min_docs]
        others = [s for x, s in groups if x == lang]

        def price(count, total):
            return 1 + 10**9 * (count + 5) // (total + 5 * len(kept))

        totals = {s: sum(counts[lang, s][t] for t in kept) for s in others}
        of = {t: sum(counts[lang, s][t] for s in others) for t in kept}
        pairs = [
            (-sum(abs(price(counts[lang, source][t], totals[source]) - price(counts[lang, s][t], totals[s])) for t in kept), s.encode(), s)
            for s in others if s != source
        ]
        rows_of = [
            (price(of[t], sum(of.values())) - price(counts[lang, source][t], totals[source]), t.encode(), t) for t in kept if counts[lang, source][t]
        ]
        ranked = [("pair", sorted(pairs)), ("term", sorted(x for x in rows_of if x[0] < 0)[:listed])]
        out += [(lang, source, part, item, -value, k) for part, found in ranked for k, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def result(spark, rows, min_docs, listed, block):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(divergence, "BLOCK_TERMS", block)
        found = divergence.audit(docs.repartition(4), min_docs=min_docs, listed=listed)
        return sorted(map(tuple, found.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_equals_brute_force(spark):
    draw = random.Random(3)
    names = ["Alpha", "beta", "GAMMA", "délta", "Éa", "中文", "x", "yy", "Σ", "w1w", "don't", "a_b"]
    rows = []
    for _ in range(250):
        skew = draw.randrange(1, len(names))
        rows.append((
            " ".join(draw.choice(names[:skew]) for _ in range(draw.randrange(0, 30))), draw.choice(["en", "en", "de", None]),
            draw.choice(["a", "b", "b", "c", "é", "", None]),
        ))
    rows += [(None, "en", "empty"), ("", "fr", "only"), ("", "fr", "none"), ("rare words", "it", "lone"), ("long " * 400_000, "de", "a")]
    rows += [rows[0]] * 3
    for min_docs, listed, block in ((5, 50, 2), (20, 3, 1024)):
        assert result(spark, rows, min_docs, listed, block) == brute(rows, min_docs, listed)


def test_ties_and_empty_table(spark):
    rows = [("same", "en", s) for s in ("c", "a", "b")]
    assert result(spark, rows, 1, 50, 4) == brute(rows, 1, 50)
    assert result(spark, [], 1, 50, 4) == []


@pytest.mark.parametrize("seed", range(40))
def test_gallop(seed):
    draw = np.random.default_rng(seed)
    a, b = (np.unique(draw.integers(0, 10 ** draw.integers(1, 5), draw.integers(0, 400))) for _ in "ab")
    ours, theirs = divergence.gallop(a, b)
    assert a[ours].tolist() == b[theirs].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_prices_are_exact():
    counts = np.array([0, 1, 12345678, 10**12, 5 * 10**15], np.int64)
    for total in (5 * 10**15, 8 * 10**15):
        assert divergence.prices(counts, total, 7).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 35) for c in counts]
