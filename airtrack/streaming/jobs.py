"""The composite jobs on streams, built from the batch operators and the stateful processors."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrack.functions import clock
from airtrack.functions.geo import with_lonlat, with_utm
from airtrack.lineage import pin, scratch
from airtrack.operators import components, decode, fusion, kinematics, pairing, track
from airtrack.operators.similarity import DIMENSIONS
from airtrack.plans import pipelines
from airtrack.settings import COMPANY_ID, SIMILARITY_THRESHOLD, UTM_ZONE, WATERMARK_DELAY_MS, WINDOW_SECONDS
from airtrack.sources import tables, topics
from airtrack.streaming import memory
from airtrack.streaming.processors import BUCKETS, FILTER_OUTPUT, LATE, WINDOW_OUTPUT, SignalWindowFrames, TargetFilterFrames

STATE_TTL_SECONDS = None  # nothing is forgotten unless a caller asks for it


def configure(spark: SparkSession) -> None:
    """State lives in RocksDB, off the JVM heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


@contextlib.contextmanager
def adaptive(session: SparkSession, like: SparkSession) -> Iterator[None]:
    """Plan the batch steps of a micro-batch as adaptively as the session ``like`` does.

    Spark turns that off for a stream with state, whose partitions must not change; the stream has it off again afterwards.
    """
    name = "spark.sql.adaptive.enabled"
    before = session.conf.get(name)
    session.conf.set(name, like.conf.get(name))
    try:
        yield
    finally:
        session.conf.set(name, before)


def ods_jm(messages: DataFrame, locations: dict[str, str], checkpoint_root: str, trigger: dict | None = None) -> list:
    """Streaming inserts from one message stream: drones, remotes, and old messages when they have a location.

    Every table is a stream of its own, which can stop and go on apart from the others and parses all messages;
    :func:`ods_jm_by_target` and :func:`ods_jm_together` parse them once.
    """
    drones, remotes = pipelines.ods_jm(messages)
    targets = {"ods_jm_drone": drones, "ods_jm_remote": remotes}
    if "ods_jm_old" in locations:
        targets["ods_jm_old"] = decode.ods_jm_old(messages)
    return [
        tables.insert_stream(rows, name, locations[name], checkpoint_root, trigger) for name, rows in targets.items()
    ]


def ods_jm_by_target(messages: DataFrame, location: str, checkpoint_root: str, trigger: dict | None = None):
    """Streaming insert of drones and remotes from one parse: ``target=drone`` and ``target=remote`` in ``location`` are the folders
    of the two tables, and one log of the sink makes a micro-batch visible in both at once (``tables.read_target``)."""
    rows = decode.ods_jm(messages).withColumn("target", decode.target())
    return tables.insert_stream(rows, "ods_jm", location, checkpoint_root, trigger, ("target", "dt", "hr"))


def ods_jm_together(
    messages: DataFrame, bad: str, checkpoint_root: str, database: str = "ods", trigger: dict | None = None
):
    """All tables of the drone messages from one stream and one parse, each micro-batch visible in all of them or in none.

    The tables are those of ``tables.create_fan_out``; elements that cannot be used go to the folder ``bad`` as JSON text.
    """
    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with scratch(session):
            parts = pipelines.ods_jm_parts(batch)
            pipelines.to_text(parts["quarantined"]).write.mode("overwrite").json(f"{bad}/batch={number}")
            kept = {"ods_jm_drone": parts["drones"], "ods_jm_remote": parts["remotes"], "ods_jm_old": parts["old"]}
            tables.write_batch(kept, number, database)

    return topics.start(messages.writeStream.foreachBatch(write), "ods_jm_together", checkpoint_root, trigger)


def ods_aoa(
    messages: DataFrame, location: str, checkpoint_root: str, trigger: dict | None = None, now_ms: int | None = None
):
    return tables.insert_stream(decode.ods_aoa(messages, now_ms), "ods_aoa", location, checkpoint_root, trigger)


def quarantine(rows: DataFrame, name: str, folder: str, checkpoint_root: str, trigger: dict | None = None):
    """Keep the rows of a parsed stream that cannot be used, with their reason, as JSON text in ``folder/name``."""
    bad = pipelines.to_text(pairing.quarantined(rows))
    return topics.write_topic(bad, name, folder=folder, checkpoint=checkpoint_root, trigger=trigger)


def _whole_as_text(*names: str) -> list[Column]:
    """Whole numbers for a processor that is fed in frames, in which a null would make them floats."""
    return [F.col(name).cast("string").alias(name) for name in names]


def signal_windows(
    rows: DataFrame, ttl_seconds: int | None = STATE_TTL_SECONDS, zone: int = UTM_ZONE, mode: str = kinematics.CAUSAL
) -> DataFrame:
    """Stream of detections with kinematics, features and slice rank, given out as their window closes.

    A signal that was silent for more than ``ttl_seconds``, which must not be shorter than a window, is forgotten and starts anew,
    as with ``gap_seconds`` of ``kinematics.node_features``.

    Rows with a ``reason`` are given out at once, with all their fields as JSON text in ``payload``; they are dealt by offset.  So
    are rows that come after their window, with the reason ``late``: the column that carries the watermark ends before the stateful
    operator, so that Spark drops nothing and the operator sees late rows, too.
    """
    if ttl_seconds is not None and ttl_seconds < WINDOW_SECONDS:
        raise ValueError(f"state must be kept {WINDOW_SECONDS} seconds at least")
    fields = [c for c in rows.columns if c != "offset"]
    others = [c for c in fields if c not in (*kinematics.NODE, "reason")]
    reason = F.col("reason") if "reason" in rows.columns else F.lit(None).cast("string")
    speed = F.col("speed") if "speed" in rows.columns else F.lit(0.0)
    bad, dealt = reason.isNotNull(), F.hash(*kinematics.SIGNAL)
    keyed = with_utm(rows, zone=zone).select(
        F.pmod(F.when(bad, F.col("offset")).otherwise(dealt), F.lit(BUCKETS)).cast("int").alias("bucket"),
        *kinematics.SIGNAL, *_whole_as_text("timestamp", "offset"),
        "latitude", "longitude", "height", F.coalesce(speed.cast("double"), F.lit(0.0)).alias("speed"), "utm_x", "utm_y",
        F.to_json(F.struct(*fields)).alias("payload"), reason.alias("reason"),
        F.when(~bad, F.timestamp_seconds("timestamp")).alias("event_ts"),
    )
    windows = (
        keyed.withWatermark("event_ts", f"{WINDOW_SECONDS * 1000 + WATERMARK_DELAY_MS} milliseconds")
        .drop("event_ts")
        .groupBy("bucket")
        .transformWithStateInPandas(SignalWindowFrames(ttl_seconds, mode == kinematics.LOOKAHEAD), WINDOW_OUTPUT, "Append", "EventTime")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in others)
    kept = [F.col(f"_p.{c}").alias(c) for c in others if c not in ("speed",)]
    return windows.withColumn("_p", F.from_json("payload", schema)).select(
        *kinematics.NODE, "offset", *kept, "utm_x", "utm_y", "speed", "heading",
        "start_latitude", "start_longitude", "start_height", "curr_batch_first", *DIMENSIONS, "reason", "payload",
    )


def late_rows(windows: DataFrame) -> DataFrame:
    """Rows of :func:`signal_windows` that came after their window, with the first and last start of the windows they missed."""
    late = windows.filter(F.col("reason") == LATE)
    return late.select(
        *kinematics.NODE, "offset", (F.col("timestamp") - WINDOW_SECONDS + 1).alias("window_from"), F.col("timestamp").alias("window_to"), "payload"
    )


def fuse_closed_seconds(rows: DataFrame, memory: DataFrame | None, threshold: float = SIMILARITY_THRESHOLD):
    """Fuse the rows of closed seconds, a written table that is read several times; returns the rows with identities, and the identities."""
    rows = rows.withColumn("signal_id", kinematics.signal_id())
    nodes = rows.filter(F.col("curr_batch_first") == 1).select(
        *kinematics.NODE, "signal_id", "intrusion_start_time",
        "start_latitude", "start_longitude", "start_height", *DIMENSIONS,
    )
    identities = pin(fusion.fused(components.clustered(nodes, threshold), memory))
    out = (
        fusion.attach_fusion(rows, identities)
        .withColumn("feature", kinematics.feature_struct())
        .withColumn("curr_batch_time", clock.batch_label(F.col("timestamp")))
        .drop(*DIMENSIONS)
    )
    return out, identities


def dwd(
    messages: DataFrame,
    folder: str,
    checkpoint_root: str,
    topic: str = "dwd_jm_drone",
    servers: str | None = None,
    ttl_seconds: int | None = STATE_TTL_SECONDS,
    threshold: float = SIMILARITY_THRESHOLD,
    trigger: dict | None = None,
    mode: str = kinematics.CAUSAL,
):
    """Sensor messages to a topic of fused detections.

    A second is complete when the watermark closes its window, and all signals of that second are given out in
    the same micro-batch; the batch operators then fuse it, spread over the cluster.  What signals remember is dealt into
    buckets (:mod:`airtrack.streaming.memory`): a micro-batch reads and writes those of its own signals, and a repeated one
    starts from the same memory and overwrites its own result, so recovery repeats nothing downstream.  Messages that cannot be
    used go to ``<topic>_bad``, and those that come too late to ``<topic>_late``, in the same micro-batch, from the same parse.
    """
    spark = messages.sparkSession
    configure(spark)
    rows = signal_windows(pairing.pair_messages(messages), ttl_seconds, mode=mode)
    memory_root = f"{checkpoint_root}/memory"

    def send(text: DataFrame, name: str, number: int) -> None:
        if servers is None:
            topics.write_compressed(text, f"{folder}/{name}/batch={number}", "overwrite")
        else:
            topics.write_topic(text, name, servers, key=F.col("key"))

    def fuse(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with scratch(session), adaptive(session, spark):
            given = pin(batch.withColumn("payload", F.when(F.col("reason").isNotNull(), F.col("payload"))))
            for name, rows_of in ((f"{topic}_late", F.col("reason") == LATE), (f"{topic}_bad", F.col("reason") != LATE)):
                aside = given.filter(rows_of)
                send(aside.select(F.col("payload").alias("value"), "offset", F.col("offset").alias("key")), name, number)
            closed = given.filter(F.col("reason").isNull()).drop("reason", "payload")
            versions, buckets = memory.manifest(session, memory_root, number - 1), memory.touched(closed)
            if buckets:
                known = memory.read(session, memory_root, versions, buckets)
                out, identities = fuse_closed_seconds(closed, known, threshold)
                key = F.concat_ws("|", "signal_id", "timestamp", "offset").alias("key")
                fields = [c for c in out.columns if c != "offset"]
                send(out.select("offset", F.to_json(F.struct(*fields)).alias("value"), key), topic, number)
                newest = identities.agg(F.max("timestamp")).first()[0]
                since = None if ttl_seconds is None or newest is None else newest - ttl_seconds
                memory.write(memory_root, number, versions, buckets, identities, known, since)
            else:  # no second is complete yet
                memory.keep(session, memory_root, number, versions)
        memory.forget(session, memory_root, number - memory.KEPT)

    return topics.start(rows.writeStream.outputMode("append").foreachBatch(fuse), topic, checkpoint_root, trigger)


def signal_state(spark: SparkSession, checkpoint_root: str, topic: str = "dwd_jm_drone") -> DataFrame:
    """Last position that every signal of a fused stream has given out, read from the stream's checkpoint."""
    configure(spark)
    state = spark.read.format("statestore").option("path", f"{checkpoint_root}/{topic}").option("stateVarName", "last").load()
    return state.select("user_map_key.*", "user_map_value.*")


def filtered_targets(tracks: DataFrame, ttl_seconds: int | None = STATE_TTL_SECONDS, zone: int = UTM_ZONE) -> DataFrame:
    """Stream of track rows with their filtered position."""
    others = [c for c in tracks.columns if c not in ("fusion_id", "timestamp", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tracks.schema.fields if f.name in others)
    keyed = tracks.select(
        "fusion_id", *_whole_as_text("timestamp", "offset"), "utm_x", "utm_y", F.to_json(F.struct(*others)).alias("payload")
    )
    out = keyed.groupBy("fusion_id").transformWithStateInPandas(
        TargetFilterFrames(None if ttl_seconds is None else ttl_seconds * 1000),
        FILTER_OUTPUT,
        "Append",
        "ProcessingTime" if ttl_seconds else "None",
    )
    rows = out.withColumn("_p", F.from_json("payload", schema)).select(
        "offset", "fusion_id", "timestamp", *[F.col(f"_p.{c}").alias(c) for c in others], "fused_x", "fused_y"
    )
    return with_lonlat(rows, "fused_x", "fused_y", "fused_longitude", "fused_latitude", zone)


def dws(messages: DataFrame, company: int = COMPANY_ID, ttl_seconds: int | None = STATE_TTL_SECONDS) -> DataFrame:
    """Stream of fused records (JSON text) to filtered tracks."""
    configure(messages.sparkSession)
    records = pairing.good_rows(track.parse_fused(messages))
    return filtered_targets(track.project_tracks(records, company), ttl_seconds)
