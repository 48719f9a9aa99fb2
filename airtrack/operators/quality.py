"""Cluster quality: mean similarity inside the clusters of a second."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtrack.lineage import pin
from airtrack.operators.similarity import DIMENSIONS

_KEYS = ["timestamp", "cluster", "_low", "_high"]


def cluster_quality(members: DataFrame, block_vectors: int = 2000) -> DataFrame:
    """``(timestamp, clusters, quality)``: mean over clusters of the mean similarity of all member pairs.

    Equal feature vectors are counted once with their multiplicity and written, because sizes and blocks read them.
    The vectors of a large cluster are dealt to blocks; a task sums the similarities of one pair of blocks as a
    matrix, so no pair is ever a row and no task holds more than two blocks.
    """
    vectors = pin(members.groupBy("timestamp", "cluster", *DIMENSIONS).agg(F.count(F.lit(1)).alias("_copies")))
    sizes = vectors.groupBy("timestamp", "cluster").agg(
        F.count(F.lit(1)).alias("_vectors"), F.sum("_copies").alias("_members")
    )
    blocks = F.ceil(F.col("_vectors") / block_vectors)
    dealt = (
        vectors.join(sizes.filter(F.col("_members") > 1), ["timestamp", "cluster"])
        .withColumn("_own", F.pmod(F.xxhash64(*DIMENSIONS), blocks))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .select(
            "timestamp", "cluster", "_own",
            F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"),
            "_copies", *[F.col(name).cast("double").alias(name) for name in DIMENSIONS],
        )
    )
    sums = (
        dealt.repartition(*_KEYS)
        .sortWithinPartitions(*_KEYS)
        .mapInPandas(_sum_blocks, "timestamp bigint, cluster string, _weight double")
        .groupBy("timestamp", "cluster")
        .agg(F.sum("_weight").alias("_weight"))
    )
    pairs = F.col("_members") * (F.col("_members") - 1) / 2
    mean = F.coalesce(F.col("_weight") / F.nullif(pairs, F.lit(0.0)), F.lit(0.0))
    return (
        sizes.join(sums, ["timestamp", "cluster"], "left")
        .groupBy("timestamp")
        .agg(F.count(F.lit(1)).alias("clusters"), F.avg(mean).alias("quality"))
    )


def _sum_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def weigh(group: pd.DataFrame) -> float:
        points, copies = group[list(DIMENSIONS)].to_numpy(float), group["_copies"].to_numpy(float)
        low, high = group["_low"].iloc[0], group["_high"].iloc[0]
        own = group["_own"].to_numpy()
        left, right = own == low, own == high

        def total(a, b, ca, cb):
            out = 0.0
            for start in range(0, len(a), 256):
                square = 0.0
                for x, y in zip(a[start:start + 256].T, b.T):
                    gap = np.subtract.outer(x, y)
                    square = square + np.multiply(gap, gap, out=gap)
                out += ca[start:start + 256] @ (1.0 / (1.0 + np.sqrt(square))) @ cb
            return out

        all_pairs = total(points[left], points[right], copies[left], copies[right])
        return all_pairs if low != high else (all_pairs - copies.sum()) / 2

    waiting = None
    for batch in batches:
        if waiting is not None:
            batch = pd.concat([waiting, batch], ignore_index=True)
        starts = np.flatnonzero((batch[_KEYS] != batch[_KEYS].shift()).any(axis=1).to_numpy())
        waiting = batch.iloc[starts[-1]:]
        yield _weights([batch.iloc[a:b] for a, b in zip(starts[:-1], starts[1:])], weigh)
    if waiting is not None:
        yield _weights([waiting], weigh)


def _weights(groups: list[pd.DataFrame], weigh) -> pd.DataFrame:
    return pd.DataFrame(
        [(g["timestamp"].iloc[0], g["cluster"].iloc[0], weigh(g)) for g in groups],
        columns=["timestamp", "cluster", "_weight"],
    )
