"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtrack.lineage import pin
from airtrack.llm.common import WORD, sized

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
#: Fractional documents that one fold settles on average.
CHUNK = 64

#: One step of the fold.  ``a`` holds the open document (or none) and what is settled, ``x`` is the next document.
#: Words move from one to the other until one of them has probability 0 or 1; the expected copies of both and the sum
#: of their expected words stay as they are.
_STEP = """
(a, x) -> if(a.open is null, named_struct('open', x, 'settled', a.settled), element_at(transform(transform(
  array(named_struct(
    'rise', least(a.open.size * (1 - a.open.p), x.size * x.p),
    'fall', least(a.open.size * a.open.p, x.size * (1 - x.p)),
    'u', shiftrightunsigned(xxhash64({seed}, {level}, a.open.draw, x.draw), 11) / 9007199254740992D)),
  m -> if(m.u * (m.rise + m.fall) < m.fall,
    named_struct(
      'p', if(a.open.size * (1 - a.open.p) <= x.size * x.p, 1D, a.open.p + m.rise / a.open.size),
      'q', if(a.open.size * (1 - a.open.p) >= x.size * x.p, 0D, x.p - m.rise / x.size)),
    named_struct(
      'p', if(a.open.size * a.open.p <= x.size * (1 - x.p), 0D, a.open.p - m.fall / a.open.size),
      'q', if(a.open.size * a.open.p >= x.size * (1 - x.p), 1D, x.p + m.fall / x.size)))),
  n -> named_struct(
    'open', case
      when n.p > 0 and n.p < 1 then named_struct('size', a.open.size, 'draw', a.open.draw, 'id', a.open.id, 'm', a.open.m, 'whole', a.open.whole, 'p', n.p)
      when n.q > 0 and n.q < 1 then named_struct('size', x.size, 'draw', x.draw, 'id', x.id, 'm', x.m, 'whole', x.whole, 'p', n.q)
    end,
    'settled', concat(a.settled,
      if(n.p > 0 and n.p < 1, filter(array(a.open), z -> false), array(named_struct('size', a.open.size, 'draw', a.open.draw, 'id', a.open.id, 'm', a.open.m, 'whole', a.open.whole, 'p', n.p))),
      if(n.q > 0 and n.q < 1, filter(array(x), z -> false), array(named_struct('size', x.size, 'draw', x.draw, 'id', x.id, 'm', x.m, 'whole', x.whole, 'p', n.q)))))), 1))
"""


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, units, target`` for rows of ``source, size, m``: one row per source.

    Weights repeat in the order of the sources' code points, null last.  Sources share all words by weight; a source
    that would get more than ``max_copies`` times its size stops there and the rest share what is left, which is the
    level ``max((all - limits before) / weights from here)`` over sources in the order of limit per weight.
    """
    sums = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("m")).cast("long").alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    limited = sums.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(max_copies)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    levels = limited.withColumn("_level", (F.sum("source_size").over(everything) - before) / onward)
    level = F.max("_level").over(everything)
    return levels.withColumn("target", F.least(F.col("limit"), level * F.col("weight"))).select(
        "source", "source_size", "units", "target"
    )


def _settle(open_rows: DataFrame, buckets: Column, seed: int, level: int) -> DataFrame:
    """Fold each chunk of open documents from the largest to the smallest; at most one stays open per chunk."""
    item = F.struct("size", "draw", "id", "m", "whole", "p")
    chunk = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "draw", "id"), buckets)
    lists = open_rows.withColumn("_chunk", chunk).groupBy("source", "_chunk", "buckets").agg(
        F.sort_array(F.collect_list(item), asc=False).alias("items")
    )
    start = "named_struct('open', if(size(items) < 0, items[0], null), 'settled', filter(items, z -> false))"
    return lists.select(
        "source", "buckets", F.expr(f"aggregate(items, {start}, {_STEP.format(seed=seed, level=level)})").alias("fold")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 11, chunk: int = CHUNK,
) -> DataFrame:
    """``id, source, size, source_size, target, copies, taken`` of every row.

    A document of a source is wanted ``target / source_size`` times: the whole part is certain, the fraction is a
    probability.  Pivotal rounding settles fractions in pairs: words move between two documents of a source until one
    of them is certain, so that every document keeps its expected number of copies and the words of the source stay
    what they are.  Chunks of about ``chunk`` documents are folded independently, each leaves at most one open
    document, and those meet in the next level of the tree, down to one document per source, which is rounded.  The words
    taken from a source therefore differ from its target by at most half the size of that one document; folds run from
    large to small documents, so that large ones meet the most partners.

    Draws are hashes of the documents, so reruns agree.  A null text has size 0; documents of size 0 get the certain
    copies.  A null source is a source of its own.  Rows with the same id, source and size count as one document with as
    many times the expectation, and their copies are dealt evenly, so that none exceeds ``max_copies``.  An empty
    table gives an empty result.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    units = pin(
        docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), size.alias("size"))
        .groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
    )
    wanted = sized(targets(units, weights, max_copies))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)) * F.col("m")
    near = F.abs(rate - F.round(rate)) < 1e-9
    joined = units.join(wanted, units["source"].eqNullSafe(wanted["source"])).select(
        units["source"], "id", "size", "m", F.when(near, F.round(rate)).otherwise(F.floor(rate)).cast("long").alias("whole"),
        F.when(near | (F.col("size") == 0), F.lit(0.0)).otherwise(rate - F.floor(rate)).alias("p"),
        F.xxhash64(F.lit(seed), "id", "size").alias("draw"), F.ceil(F.col("units") / F.lit(chunk)).alias("buckets"),
    )
    settled = [joined.filter("p = 0").select("source", "id", "size", "m", F.col("whole").alias("total"))]
    open_rows = joined.filter("p > 0")
    largest = wanted.agg(F.max("units")).first()[0] or 0
    level, buckets = 0, -(-largest // chunk)
    while largest:
        folds = pin(_settle(open_rows, F.col("buckets"), seed, level))
        done = folds.select("source", F.explode("fold.settled").alias("d")).select("source", "d.*")
        settled.append(done.select("source", "id", "size", "m", (F.col("whole") + F.col("p").cast("long")).alias("total")))
        open_rows = folds.filter("fold.open is not null").select(
            "source", "fold.open.*", F.ceil(F.col("buckets") / F.lit(chunk)).alias("buckets")
        )
        level += 1
        if buckets <= 1:
            last = (F.col("p") >= 0.5).cast("long")
            settled.append(open_rows.select("source", "id", "size", "m", (F.col("whole") + last).alias("total")))
            break
        buckets = -(-buckets // chunk)
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    extra = (F.col("_k") <= F.col("total") % F.col("m")).cast("long")
    copies = F.floor(F.col("total") / F.col("m")).cast("long") + extra
    return rows.join(wanted, rows["source"].eqNullSafe(wanted["source"])).select(
        "id", rows["source"], "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
