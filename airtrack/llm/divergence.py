"""How far the sources of a language are from each other, and which terms set a source apart.

Kept terms get places in blocks of bounded size; a source's counts are one sorted array of places per block.  Every unordered pair
of sources meets once per block and prices all terms of the block both ways: those that both hold are found by galloping through
the longer array, those that one or none holds cost a subtraction.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airtrack.lineage import pin
from airtrack.llm.common import in_small_batches, pin_counted, sized, term_table, terms

#: Documents of a language that must hold a term, occurrences added to every count, and the unit of prices.
MIN_DOCS, SMOOTHING, UNIT = 30, 5, 1_000_000_000
#: Ranks of terms that are listed.
LISTED = 50
#: Kept terms per block, on average, and terms that a task counts before it hands them on.
BLOCK_TERMS, COUNTED = 1024, 400_000

_TERM = term_table(lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)


def _plain(docs: DataFrame, col: str):
    return F.coalesce(docs[col].cast("string"), F.lit("")).alias(col)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of every term and documents that hold it."""
    def run(batches):
        held, size = {}, 0

        def rows():
            for (lang, source), (counts, holders) in held.items():
                yield pa.record_batch([
                    pa.array([lang] * len(counts)), pa.array([source] * len(counts)), pa.array([t.decode() for t in counts]),
                    pa.array(list(counts.values()), pa.int64()), pa.array([holders[t] for t in counts], pa.int64()),
                ], schema=layout)

        for batch in batches:
            for text, *group in zip(*(column.to_pylist() for column in batch.columns)):
                counts, holders = held.setdefault(tuple(group), (Counter(), Counter()))
                before, own = len(counts), set()
                for words in terms(text, _TERM):
                    counts.update(words)
                    own.update(words)
                holders.update(own)
                size += len(counts) - before
                if size > COUNTED:
                    yield from rows()
                    held, size = {}, 0
        yield from rows()

    schema = T.StructType([
        *(T.StructField(x, T.StringType()) for x in ("lang", "source", "term")), *(T.StructField(x, T.LongType()) for x in ("n", "docs"))
    ])
    layout = to_arrow_schema(schema)
    raw = docs.select(F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary"), _plain(docs, lang_col), _plain(docs, source_col))
    counted = in_small_batches(raw).mapInArrow(run, schema)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def prices(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * kept))``, exact for totals below 9 * 10**15."""
    of, rest = total + SMOOTHING * kept, counts.astype(np.int64) + SMOOTHING
    out = rest // of
    for _ in range(3):  # three decimal digits of the quotient at a time
        rest = rest % of * 1000
        out = out * 1000 + rest // of
    return out + 1


def gallop(few: np.ndarray, many: np.ndarray, stride: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``few`` and in ``many`` of the values that both sorted arrays hold.

    For every stretch of ``few`` the end of its values in ``many`` is found by steps that double, and only what they enclose is
    searched.
    """
    ours, theirs, low = [], [], 0
    for first in range(0, len(few), stride):
        part, step = few[first: first + stride], 1
        while low + step < len(many) and many[low + step] <= part[-1]:
            step *= 2
        window = many[low: low + step + 1]
        at = np.searchsorted(window, part)
        hit = np.flatnonzero(window[np.minimum(at, len(window) - 1)] == part) if len(window) else at[:0]
        ours.append(hit + first)
        theirs.append(at[hit] + low)
        low = min(low + int(at[-1]), len(many))
    return (np.concatenate(ours), np.concatenate(theirs)) if ours else (np.zeros(0, np.int64),) * 2


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], total_a: int, total_b: int, kept: int, here: int) -> int:
    """Sum of the differences of both sources' prices over the ``here`` terms of a block."""
    if len(a[0]) > len(b[0]):
        a, b, total_a, total_b = b, a, total_b, total_a
    none_a, none_b = (int(prices(np.zeros(1, np.int64), n, kept)[0]) for n in (total_a, total_b))
    price_a, price_b = prices(a[1], total_a, kept), prices(b[1], total_b, kept)
    in_a, in_b = gallop(a[0], b[0])
    one = np.abs(price_a - none_b)
    two = np.abs(price_b - none_a)
    both = np.abs(price_a[in_a] - price_b[in_b])
    absent = here - len(a[0]) - len(b[0]) + len(in_a)
    return int(one.sum() - one[in_a].sum() + two.sum() - two[in_b].sum() + both.sum()) + absent * abs(none_a - none_b)


def _differences(pairs: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of every pair and block."""
    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            lists = {}
            for side in "ab":
                for name in ("places", "counts"):
                    column = batch.column(f"{name}_{side}")
                    flat = column.flatten().to_numpy(zero_copy_only=False)
                    ends = np.cumsum([0, *(0 if x is None else len(x) for x in rows[f"{name}_{side}"])])
                    lists[name, side] = [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]
            sides = [list(zip(lists["places", s], lists["counts", s])) for s in "ab"]
            value = [
                difference(*x) for x in zip(*sides, rows["total_a"], rows["total_b"], rows["kept"], rows["here"])
            ]
            yield pa.record_batch([*(batch.column(x) for x in ("lang", "a", "b")), pa.array(value, pa.int64())], schema=layout)

    schema = T.StructType([*(T.StructField(x, T.StringType()) for x in ("lang", "a", "b")), T.StructField("value", T.LongType())])
    layout = to_arrow_schema(schema)
    return in_small_batches(pairs).mapInArrow(run, schema)


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
    listed: int = LISTED,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every source of every language.

    Part ``pair`` ranks the other sources of the language by the sum of differences of prices over all kept terms; part ``term`` ranks
    the terms whose price in the source is above their price in the language, up to rank ``listed``.  Terms are runs of ASCII letters
    and characters beyond ASCII, A-Z in lower case; a language keeps those that ``min_docs`` of its documents hold.  A term's price is
    its smoothed share in billionths, in whole numbers throughout.

    A null text, language or source counts as an empty one.  A source without kept terms has pairs only, and in a language without
    kept terms their value is 0.  Equal values rank by the item's UTF-8.  Repeated rows count as often as they occur, an empty table
    gives an empty result, and other columns are ignored, whatever their names.
    """
    counts = pin(term_counts(docs, text_col, lang_col, source_col))
    kept, n = pin_counted(
        counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).filter(F.col("docs") >= min_docs).drop("docs")
    )
    kept = kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(n // BLOCK_TERMS + 1)).cast("int"))
    kept = kept.withColumn("place", F.expr("row_number() over (partition by lang, block order by term) - 1"))
    kept = sized(kept)
    blocks = sized(kept.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("here")))
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all").alias("total"))
    found = pin(counts.drop("docs").join(kept, ["lang", "term"]))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(_plain(docs, lang_col), _plain(docs, source_col)).toDF("lang", "source").distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(languages.drop("total"), "lang", "left")
    groups = pin(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")))

    vectors = pin(found.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("v")).select(
        "lang", "source", "block", F.col("v.place").alias("places"), F.col("v.n").alias("counts")
    ))
    one, two = (groups.select("lang", F.col("source").alias(s), F.col("total").alias(f"total_{s}"), "kept") for s in "ab")
    pairs = pin(one.join(two.drop("kept"), "lang").filter("a < b"))
    tasks = pairs.join(blocks, "lang")
    for s in "ab":
        tasks = tasks.join(vectors.toDF("lang", s, "block", f"places_{s}", f"counts_{s}"), ["lang", s, "block"], "left")
    sums = _differences(tasks.drop("block")).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    priced = pairs.select("lang", "a", "b").join(sums, ["lang", "a", "b"], "left").fillna(0, ["value"])
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    others = priced.select("lang", ways.alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")

    def price(count: str, total: str) -> str:
        return f"(1 + cast({UNIT} as decimal(10)) * ({count} + {SMOOTHING}) div ({total} + {SMOOTHING} * kept))"

    held = found.join(sized(groups), ["lang", "source"]).join(sized(languages.select("lang", F.col("total").alias("of_lang"))), "lang")
    apart = held.withColumn("value", F.expr(f"{price('n', 'total')} - {price('all', 'of_lang')}")).filter("value > 0")
    typical = apart.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = "row_number() over (partition by lang, source, part order by value desc, item)"
    return others.withColumn("rank", F.expr(rank)).unionByName(typical.withColumn("rank", F.expr(rank)).filter(F.col("rank") <= listed))
