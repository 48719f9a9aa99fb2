"""Connected components of links between ids by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtrack.lineage import pin


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links`` (columns ``a``, ``b``); the component is the smallest id in it.

    Every node hangs its larger neighbours on its smallest one (large star), then every node and its smaller neighbours
    hang on the smallest of them (small star), until nothing changes; turns grow with the logarithm of the longest path.
    Minima are aggregated before the shuffle, so a node with very many links costs no more than others.
    """
    edges = pin(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*").filter("a <> b").distinct()
        edges, before = pin(small), state
        state = _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.unionByName(roots).toDF("id", "component").distinct()
