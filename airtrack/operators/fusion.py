"""Stable identities of fused signals over time.

In every second each cluster takes over the earliest start it knows: the earliest start its members remember from
their last cluster, or the earliest start of a member itself if that is strictly earlier.  All members then
remember the result.  That rule is sequential in time, but it is solved here for all seconds at once:

1. The start a cluster ends up with is the minimum over everything that reaches it forward in time.  Every cluster
   points to the earliest start its members have met (any distance back in their lives), and pointers are followed
   twice as far in every turn, so turns grow with the logarithm of the signals a start was handed through.
2. With the starts known, each cluster either begins an identity or points to the one earlier cluster it takes its
   identity from.  Following the pointers twice as far in every turn leads to the origin.

Every step is partitioned by signal and second or by cluster; nothing is ordered globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airtrack.functions import text
from airtrack.lineage import pin, pin_and_test
from airtrack.operators.kinematics import NODE, SIGNAL
from airtrack.operators.ranking import numbered

_CLUSTER = ["timestamp", "cluster"]
_PLACE = ["longitude", "latitude", "height"]
_BEFORE = -(1 << 62)  # the second, before all others, in which remembered identities enter


def _earliest_member() -> Column:
    return F.min(
        F.struct(
            F.col("intrusion_start_time").alias("start"), "drone_uuid", "batch_num",
            F.col("start_longitude").alias("longitude"),
            F.col("start_latitude").alias("latitude"),
            F.col("start_height").alias("height"),
        )
    )


def fusion_id(start: str, longitude: str, latitude: str, height: str) -> Column:
    """Hash of the identity's start time and place."""
    place = [text.plain_number(F.col(c)) for c in (longitude, latitude, height)]
    return F.md5(F.concat_ws("_", F.col(start).cast("string"), *place))


def cluster_start(members: DataFrame) -> DataFrame:
    """Earliest member of each cluster and its start place, without memory."""
    return members.groupBy(*_CLUSTER).agg(_earliest_member().alias("_m")).select(
        *_CLUSTER,
        F.col("_m.start").alias("start_time"),
        F.col("_m.drone_uuid").alias("drone_uuid"),
        F.col("_m.batch_num").alias("batch_num"),
        *[F.col(f"_m.{name}").alias(f"start_{name}") for name in _PLACE],
    )


def cluster_members(members: DataFrame) -> DataFrame:
    """Rows ``(timestamp, cluster_index, signal_id)``: clusters of a second counted from 0 in member order."""
    firsts = (
        members.groupBy(*_CLUSTER)
        .agg(F.min(F.struct(*SIGNAL)).alias("_first"))
        .select(*_CLUSTER, "_first.drone_uuid", "_first.batch_num")
    )
    indexed = numbered(firsts, ["timestamp"], SIGNAL, "_n").select(
        *_CLUSTER, (F.col("_n") - 1).cast("int").alias("cluster_index")
    )
    return members.select(*_CLUSTER, "signal_id").join(indexed, _CLUSTER).select(
        "timestamp", "cluster_index", "signal_id"
    )


def _doubled(state: DataFrame, done: Column, carried: list[str]) -> DataFrame:
    """Follow ``(from_timestamp, from_cluster)`` until ``done``, twice as far in every turn; ``carried`` comes from the end."""
    state, waiting = pin_and_test(state, ~done)
    while waiting:
        ahead = state.select(
            F.col("timestamp").alias("from_timestamp"), F.col("cluster").alias("from_cluster"),
            F.col("from_timestamp").alias("_next_timestamp"), F.col("from_cluster").alias("_next_cluster"),
            *(F.col(c).alias(f"_{c}") for c in carried),
        )
        kept = [c for c in state.columns if c not in (*_CLUSTER, "from_timestamp", "from_cluster", *carried)]
        moved = state.filter(~done).join(ahead, ["from_timestamp", "from_cluster"]).select(
            *_CLUSTER, *kept, F.col("_next_timestamp").alias("from_timestamp"), F.col("_next_cluster").alias("from_cluster"),
            *(F.col(f"_{c}").alias(c) for c in carried),
        )
        state, waiting = pin_and_test(state.filter(done).unionByName(moved), ~done)
    return state


def _spread_starts(members: DataFrame) -> DataFrame:
    """Members with ``start``: the start their cluster ends up with, the least of all that reach it forward in time.

    In every phase a cluster points to where the earliest start that its members have met before was first held, however long ago
    that is in their lives, and the pointers are doubled: a start that is handed on from signal to signal any number of times arrives
    in one phase, in a number of turns that grows with the logarithm of the hand-overs.  A further phase is needed only where a start
    that came from far undercuts one that a cluster had preferred to point to.
    """
    life = Window.partitionBy(*SIGNAL).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, -1)
    held = pin(members.groupBy(*_CLUSTER).agg(F.min("intrusion_start_time").alias("start")))
    rows = members.select(*NODE, "cluster")
    while True:
        known = rows.join(held, _CLUSTER)
        met = known.select(*_CLUSTER, F.min(F.struct("start", *_CLUSTER)).over(life).alias("_met"))
        best = met.filter(F.col("_met").isNotNull()).groupBy(*_CLUSTER).agg(F.min("_met").alias("_best"))
        points = F.col("_best.start") <= F.col("start")
        pointers, lowered = pin_and_test(
            held.join(best, _CLUSTER, "left").select(
                *_CLUSTER, "start", F.when(points, F.col("_best.timestamp")).alias("from_timestamp"),
                F.when(points, F.col("_best.cluster")).alias("from_cluster"), (F.col("_best.start") < F.col("start")).alias("_lower"),
            ),
            F.col("_lower"),
        )
        if not lowered:
            return rows.join(held, _CLUSTER)
        held = _doubled(pointers.drop("_lower"), F.col("from_cluster").isNull(), ["start"]).select(*_CLUSTER, "start")


def _origins(pointers: DataFrame) -> DataFrame:
    """Follow ``(from_timestamp, from_cluster)`` to the cluster that holds a ``place``."""
    return _doubled(pointers, F.col("place").isNotNull(), ["place"])


def fused(members: DataFrame, memory: DataFrame | None = None) -> DataFrame:
    """``fusion_*`` and ``pre_fusion_*`` of every (signal, second).

    ``members`` has one row per (signal, second) with ``cluster``, ``intrusion_start_time`` and ``start_*``.
    ``memory`` is what earlier runs remember (see :func:`remembered`); it enters as a second before all others
    in which every signal was alone.
    """
    members = members.select(
        *NODE, "cluster", "intrusion_start_time", "start_longitude", "start_latitude", "start_height"
    )
    if memory is not None:
        known_signals = memory.join(members.select(*SIGNAL).distinct(), SIGNAL, "left_semi")
        members = members.unionByName(
            known_signals.select(
                *SIGNAL,
                F.lit(_BEFORE).cast("bigint").alias("timestamp"),
                F.concat_ws("_", *SIGNAL).alias("cluster"),
                F.col("fusion_start_time").alias("intrusion_start_time"),
                *[F.col(f"fusion_{name}").alias(f"start_{name}") for name in _PLACE],
            )
        )
    members = pin(members)
    known = _spread_starts(members)
    by_time = Window.partitionBy(*SIGNAL).orderBy("timestamp")
    remembering = known.select(
        *NODE, "cluster", "start",
        F.lag("timestamp").over(by_time).alias("_timestamp"),
        F.lag("cluster").over(by_time).alias("_cluster"),
        F.lag("start").over(by_time).alias("_start"),
    )
    memory = remembering.filter(F.col("_start").isNotNull()).groupBy(*_CLUSTER).agg(
        F.min(F.struct(F.col("_start").alias("start"), *SIGNAL, "_timestamp", "_cluster")).alias("_pre")
    )
    current = members.groupBy(*_CLUSTER).agg(_earliest_member().alias("_cur"))
    begins = F.col("_pre").isNull() | (F.col("_cur.start") < F.col("_pre.start"))
    pointers = current.join(memory, _CLUSTER, "left").select(
        *_CLUSTER,
        F.when(begins, F.col("_cur.start")).otherwise(F.col("_pre.start")).alias("start"),
        F.when(~begins, F.col("_pre._timestamp")).alias("from_timestamp"),
        F.when(~begins, F.col("_pre._cluster")).alias("from_cluster"),
        F.when(begins, F.struct(*[F.col(f"_cur.{name}").alias(name) for name in _PLACE])).alias("place"),
    )
    identities = _origins(pointers).select(
        *_CLUSTER,
        F.col("start").alias("fusion_start_time"),
        *[F.col(f"place.{name}").alias(f"fusion_{name}") for name in _PLACE],
    )
    named = members.select(*NODE, "cluster").join(
        identities.withColumn(
            "fusion_id", fusion_id("fusion_start_time", "fusion_longitude", "fusion_latitude", "fusion_height")
        ),
        _CLUSTER,
    )
    fields = ["fusion_id", "fusion_start_time", *[f"fusion_{name}" for name in _PLACE]]
    return named.select(
        *NODE, "cluster", *fields, *[F.lag(name).over(by_time).alias(f"pre_{name}") for name in fields]
    ).filter(F.col("timestamp") > _BEFORE)


def remembered(identities: DataFrame, memory: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """Last identity of every signal: what a later run has to know.  Signals not seen ``since`` are forgotten."""
    columns = [*NODE, "fusion_id", "fusion_start_time", *[f"fusion_{name}" for name in _PLACE]]
    rows = identities.select(*columns)
    if memory is not None:
        rows = rows.unionByName(memory.select(*columns))
    if since is not None:
        rows = rows.filter(F.col("timestamp") >= since)
    rest = [c for c in columns if c not in SIGNAL]
    return rows.groupBy(*SIGNAL).agg(F.max(F.struct(*rest)).alias("_last")).select(*SIGNAL, "_last.*")


def attach_fusion(rows: DataFrame, identities: DataFrame) -> DataFrame:
    """Give every row of a (signal, second) that second's identity."""
    return rows.join(identities.drop("cluster"), NODE)
