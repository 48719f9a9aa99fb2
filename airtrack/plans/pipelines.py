"""The composite jobs: table layer, fused detections, tracks.  Each maps a message table to its result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrack.lineage import pin
from airtrack.operators import components, decode, fusion, kinematics, pairing, track
from airtrack.settings import COMPANY_ID, SIMILARITY_THRESHOLD, UTM_ZONE


def ods_jm(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drone rows and remote rows.  A table of messages is parsed once, into a written table that both read."""
    rows = decode.ods_jm(messages)
    return decode.split_by_type(rows if messages.isStreaming else pin(rows))


def ods_jm_parts(messages: DataFrame) -> dict[str, DataFrame]:
    """All rows that the messages become: ``drones``, ``remotes``, ``old`` messages, and ``quarantined`` elements with a reason.

    The text is parsed once, into a written table that all four read.
    """
    parsed = pin(decode.parse_jm(messages))
    elements = parsed.filter(F.col("old").isNull()).drop("old")
    drones, remotes = decode.split_by_type(decode.usable_jm(elements))
    carried = [c for c in messages.columns if c != "value"]
    old = parsed.filter(F.col("old").isNotNull()).select(*carried, F.col("old").alias("value"))
    return {
        "drones": drones, "remotes": remotes, "old": decode.old_rows(old.withColumn("route", F.lit(decode.OLD))),
        "quarantined": pairing.quarantined(elements),
    }


def ods_aoa_parts(messages: DataFrame, now_ms: Column | int | None = None) -> dict[str, DataFrame]:
    """``usable`` rows, ``old`` messages as they are, and ``quarantined`` rows with a reason."""
    routed = decode.route_aoa(messages)
    return {
        "usable": decode.ods_aoa(messages, now_ms), "old": routed.filter(F.col("route") == decode.OLD).drop("route"),
        "quarantined": pairing.quarantined(decode.typed_aoa(routed, now_ms)),
    }


def ods_aoa(messages: DataFrame, now_ms: Column | int | None = None) -> DataFrame:
    return decode.ods_aoa(messages, now_ms)


def fuse_rows(
    rows: DataFrame,
    mode: str = kinematics.CAUSAL,
    threshold: float = SIMILARITY_THRESHOLD,
    zone: int = UTM_ZONE,
) -> DataFrame:
    """Typed detections with kinematics, features, slice rank and fusion identity."""
    nodes = pin(components.clustered(pin(kinematics.node_features(rows, mode, zone)), threshold))
    identities = fusion.fused(nodes).drop("cluster")
    fields = [c for c in identities.columns if c not in kinematics.NODE]
    ranked = kinematics.slice_rank(rows).drop("curr_batch_time")
    return kinematics.attach_kinematics(ranked, nodes.join(identities, kinematics.NODE), zone, fields)


def dwd(messages: DataFrame, **options) -> DataFrame:
    """Sensor messages to fused detections; the text is parsed once into a written table."""
    return fuse_rows(pin(pairing.good_rows(pairing.pair_messages(messages))), **options)


def dwd_parts(messages: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Fused detections, and the rows of unusable messages with their reason; one parse for both."""
    paired = pin(pairing.pair_messages(messages))
    return fuse_rows(pairing.good_rows(paired), **options), pairing.quarantined(paired)


def dws_parts(messages: DataFrame, company: int = COMPANY_ID, zone: int = UTM_ZONE) -> tuple[DataFrame, DataFrame]:
    """Filtered tracks, and the rows of unusable records with their reason; one parse for both."""
    records = pin(track.parse_fused(messages))
    return track.kalman(track.project_tracks(pairing.good_rows(records), company), zone=zone), pairing.quarantined(records)


def balance(jm: DataFrame, aoa: DataFrame) -> DataFrame:
    """``job, outcome, n``: what became of every message or element; nothing is left out."""
    routed = decode.route_jm(jm)
    reason = F.coalesce("reason", F.lit("usable")).alias("outcome")
    parts = {
        "ods_jm elements": decode.explode_jm(routed).select(reason),
        "ods_jm messages": routed.select(F.col("route").alias("outcome")),
        "ods_aoa messages": routed_aoa(aoa),
        "dwd messages": pairing.pair_messages(jm).select(reason),
    }
    counts = [rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).withColumn("job", F.lit(job)) for job, rows in parts.items()]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total.select("job", "outcome", "n")


def routed_aoa(messages: DataFrame) -> DataFrame:
    """``outcome`` of every direction message."""
    routed = decode.route_aoa(messages)
    new = decode.typed_aoa(routed, 0).select(F.coalesce("reason", F.lit("usable")).alias("outcome"))
    return new.unionByName(routed.filter(F.col("route") == decode.OLD).select(F.lit(decode.OLD).alias("outcome")))


def to_text(records: DataFrame) -> DataFrame:
    """Records as JSON text, ready for a topic."""
    fields = [c for c in records.columns if c != "offset"]
    return records.select(
        *[c for c in ("offset",) if c in records.columns], F.to_json(F.struct(*fields)).alias("value")
    )


def dws(messages: DataFrame, company: int = COMPANY_ID, zone: int = UTM_ZONE) -> DataFrame:
    """Fused records (JSON text) to filtered tracks; the text is parsed once, into a written table.

    The range partitioning of the filter reads its input twice, for its bounds and for the rows.
    """
    records = pairing.good_rows(track.parse_fused(messages))
    return track.kalman(pin(track.project_tracks(records, company)), zone=zone)
