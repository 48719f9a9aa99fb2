"""Named queries over the tables of a folder.  Every query runs over the whole ``events`` table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrack.functions.geo import with_lonlat, with_utm
from airtrack.lineage import pin, scratch, shared_folder
from airtrack.operators import components, decode, fusion, kinematics, pairing, quality, similarity, track
from airtrack.plans import pipelines
from airtrack.settings import TOPIC_FILE_ROWS
from airtrack.sources import fixtures, tables, topics
from airtrack.streaming import jobs

_ONCE = {"availableNow": True}
GAP_SECONDS = 6  # silence after which a signal starts anew, in the queries that cut flights
NOW_MS = 1_700_000_000_000  # fill-in time of direction messages without one, fixed for repeatable results


def _detections(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.detections(spark, folder).drop("event_type")


def _jm(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.jm_messages(fixtures.detections(spark, folder))


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    return kinematics.node_features(_detections(spark, folder))


def _clusters(spark: SparkSession, folder: str) -> DataFrame:
    return components.clustered(pin(_nodes(spark, folder)))


def _fused(spark: SparkSession, folder: str) -> DataFrame:
    """Fused detections with the fields a parsed message would add."""
    target = F.floor(F.substr("drone_uuid", F.lit(4)).cast("bigint") / 3)
    rows = _detections(spark, folder).withColumns({
        "model": F.concat(F.lit("M"), target.cast("string")),
        "scanID": F.array(F.struct(F.lit(fixtures.DEVICE).alias("id")), F.struct(F.lit("7").alias("id"))),
        "driverlongitude": F.col("longitude") - 0.001,
        "driverlatitude": F.col("latitude") - 0.001,
        "station_id": F.lit(fixtures.STATION),
    })
    return pipelines.fuse_rows(pin(rows))


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


def jm_decode_route(spark: SparkSession, folder: str) -> DataFrame:
    return decode.route_jm(_jm(spark, folder)).select("offset", "route")


def jm_explode_typed(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode.explode_jm(decode.route_jm(_jm(spark, folder)))
    return rows.filter(F.col("reason").isNull()).drop("reason").withColumnRenamed("scanID", "scanid")


def jm_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    drones, remotes = pipelines.ods_jm(_jm(spark, folder))
    return (
        drones.select(F.lit("drone").alias("target"))
        .unionByName(remotes.select(F.lit("remote").alias("target")))
        .groupBy("target")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def ods_partition_rows(spark: SparkSession, folder: str) -> DataFrame:
    return decode.ods_jm(_jm(spark, folder))


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/airtrack/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def ods_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The table layer as a stream over a topic folder, read back from both tables."""
    place = _new_folder(spark)
    topics.write_topic(_jm(spark, folder), "jm", folder=place)
    stream = topics.read_topic(spark, "jm", folder=place)
    jobs.ods_jm_by_target(stream, f"{place}/ods_jm", f"{place}/checkpoints", _ONCE).awaitTermination()
    drones, remotes = (tables.read_target(spark, f"ods_jm_{target}", target, f"{place}/ods_jm") for target in ("drone", "remote"))
    return drones.unionByName(remotes)


def fan_out_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same two tables, filled together by one stream in several micro-batches and read through their views."""
    place, database = _new_folder(spark), f"together_{uuid.uuid4().hex}"
    _jm(spark, folder).select("value", "offset").repartition(_FILES).write.json(f"{place}/jm")
    tables.create_fan_out(spark, ["ods_jm_drone", "ods_jm_remote", "ods_jm_old"], f"{place}/tables", database)
    stream = topics.read_topic(spark, "jm", folder=place, maxFilesPerTrigger="2")
    jobs.ods_jm_together(stream, f"{place}/bad", f"{place}/checkpoints", database, _ONCE).awaitTermination()
    drones, remotes = (spark.table(f"{database}.{name}") for name in ("ods_jm_drone", "ods_jm_remote"))
    return drones.unionByName(remotes)


def aoa_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Direction messages as a stream over a topic folder, read back from their table."""
    place = _new_folder(spark)
    topics.write_topic(fixtures.aoa_messages(fixtures.detections(spark, folder)), "aoa", folder=place)
    stream = topics.read_topic(spark, "aoa", folder=place)
    jobs.ods_aoa(stream, f"{place}/ods_aoa", f"{place}/checkpoints", _ONCE, NOW_MS).awaitTermination()
    return spark.read.schema(tables.TABLES["ods_aoa"]).parquet(f"{place}/ods_aoa")


def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Drone rows inserted into a partitioned table, and the partitions of one day read back."""
    place, database = _new_folder(spark), f"roundtrip_{uuid.uuid4().hex}"
    table = tables.create_table(spark, "ods_jm_drone", database, f"{place}/ods_jm_drone")
    tables.insert(pipelines.ods_jm(_jm(spark, folder))[0], table)
    tables.commit_partitions(spark, table, delay_seconds=0)
    return spark.table(table).filter("dt >= '2024-12-06'")


def jm_legacy_fallback(spark: SparkSession, folder: str) -> DataFrame:
    messages = decode.route_jm(_jm(spark, folder)).withColumn("message", F.col("value"))
    rows = decode.legacy_jm(messages)
    fallback = F.col("droneUK").isNull()
    return rows.select(
        "offset",
        fallback.alias("fallback"),
        (F.col("batch_num") == F.col("message")).alias("text_kept"),
        F.when(~fallback, F.col("batch_num")).alias("batch_num"),
        "target_type", "droneUK", "latitude", "timestamp",
    )


def aoa_route_fill(spark: SparkSession, folder: str) -> DataFrame:
    return decode.ods_aoa(fixtures.aoa_messages(fixtures.detections(spark, folder)), NOW_MS)


def pair_pilot_drone(spark: SparkSession, folder: str) -> DataFrame:
    paired = pairing.pair_messages(_jm(spark, folder))
    good = F.col("reason").isNull()
    fields = ("signal_id", "driverlongitude", "driverlatitude", "height", "model")
    return paired.select(
        "offset", "reason",
        F.when(good, F.col("event_time")).otherwise(0).alias("event_time"),
        *[F.when(good, F.col(name)).alias(name) for name in fields],
    )


def message_balance(spark: SparkSession, folder: str) -> DataFrame:
    return pipelines.balance(_jm(spark, folder), fixtures.aoa_messages(fixtures.detections(spark, folder)))


def utm_forward(spark: SparkSession, folder: str) -> DataFrame:
    placed = with_utm(_detections(spark, folder).select("offset", "longitude", "latitude"))
    return _rounded(placed.select("offset", "utm_x", "utm_y"), utm_x=3, utm_y=3)


def utm_inverse(spark: SparkSession, folder: str) -> DataFrame:
    placed = with_utm(_detections(spark, folder).select("offset", "longitude", "latitude"))
    back = with_lonlat(placed.select("offset", "utm_x", "utm_y"))
    return _rounded(back.select("offset", "longitude", "latitude"), longitude=9, latitude=9)


def _kinematics(spark: SparkSession, folder: str, mode: str, gap_seconds: int | None = None) -> DataFrame:
    rows = kinematics.kinematics(_detections(spark, folder), mode, gap_seconds=gap_seconds)
    return _rounded(
        rows.select(
            "offset", "signal_id", "timestamp", "utm_x", "utm_y", "speed", "heading",
            "start_latitude", "start_longitude", "start_height",
        ),
        utm_x=3, utm_y=3, speed=3, heading=2,
    )


def kinematics_causal(spark: SparkSession, folder: str) -> DataFrame:
    return _kinematics(spark, folder, kinematics.CAUSAL)


def kinematics_lookahead(spark: SparkSession, folder: str) -> DataFrame:
    return _kinematics(spark, folder, kinematics.LOOKAHEAD)


def start_position(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, folder).select("signal_id", "start_latitude", "start_longitude", "start_height").distinct()


def slice_rank(spark: SparkSession, folder: str) -> DataFrame:
    ranked = kinematics.slice_rank(_detections(spark, folder))
    return ranked.select("offset", kinematics.signal_id().alias("signal_id"), "curr_batch_time", "curr_batch_first")


def window_features(spark: SparkSession, folder: str) -> DataFrame:
    features = _nodes(spark, folder).select("signal_id", "timestamp", *similarity.DIMENSIONS)
    return _rounded(features, lat_range=9, lon_range=9, avg_speed=3, avg_height=6)


def window_features_lookahead(spark: SparkSession, folder: str) -> DataFrame:
    nodes = kinematics.node_features(_detections(spark, folder), kinematics.LOOKAHEAD)
    features = nodes.select("signal_id", "timestamp", *similarity.DIMENSIONS)
    return _rounded(features, lat_range=9, lon_range=9, avg_speed=3, avg_height=6)


def _windows(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Kinematics and features of every usable message by the stream."""
    place = _new_folder(spark)
    steps, files = _jm_steps(spark, folder, place)
    for send in steps:
        send()
    source = topics.read_topic(spark, "jm", folder=place, maxFilesPerTrigger=str(files))
    jobs.configure(spark)
    rows = jobs.signal_windows(pairing.good_rows(pairing.pair_messages(source)), **options).select(
        "offset", "timestamp", "speed", "heading", "start_latitude", "curr_batch_first", "time_range", "avg_speed", "avg_height"
    )
    sink = rows.writeStream.format("parquet").option("path", f"{place}/windows")
    topics.start(sink, "windows", f"{place}/checkpoints", _ONCE).awaitTermination()
    given = spark.read.schema(rows.schema).parquet(f"{place}/windows")
    return _rounded(given, speed=3, heading=2, avg_speed=3, avg_height=6)


def window_stream_lookahead(spark: SparkSession, folder: str) -> DataFrame:
    """With values of the seconds ahead."""
    return _windows(spark, folder, mode=kinematics.LOOKAHEAD)


def expiry_stream(spark: SparkSession, folder: str) -> DataFrame:
    """With signals that start anew after six seconds of silence."""
    return _windows(spark, folder, ttl_seconds=GAP_SECONDS)


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that a sensor sends again a minute late, as the stream sets them aside."""
    place, held = _new_folder(spark), F.col("offset") % 100 == 59
    found = pin(fixtures.detections(spark, folder))
    timed = pin(fixtures.jm_messages(found).join(found.select("offset", "timestamp"), "offset"))
    closing = _jm_steps(spark, folder, f"{place}/closing")[0][-1]
    steps, files = _sent(timed.filter(~held), place, "jm")
    for send in steps:
        send()
    closing()
    spark.read.schema("value string, offset bigint").json(f"{place}/closing/jm").repartition(_FILES).write.mode("append").json(f"{place}/jm")
    source = topics.read_topic(spark, "jm", folder=place, maxFilesPerTrigger=str(files))
    jobs.configure(spark)
    late = jobs.late_rows(jobs.signal_windows(pairing.good_rows(pairing.pair_messages(source))))
    for more in (None, timed.filter(held)):
        if more is not None:
            more.select("value", "offset").repartition(_FILES).write.mode("append").json(f"{place}/jm")
        sink = late.writeStream.format("parquet").option("path", f"{place}/late")
        topics.start(sink, "late", f"{place}/checkpoints", _ONCE).awaitTermination()
    rows = spark.read.schema(late.schema).parquet(f"{place}/late")
    return rows.select("offset", "timestamp", "window_from", "window_to", F.get_json_object("payload", "$.signal_id").alias("signal_id"))


def kinematics_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The batch form of the same cut, over all detections."""
    return _kinematics(spark, folder, kinematics.CAUSAL, GAP_SECONDS)


def sliding_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    return kinematics.sliding_counts(_detections(spark, folder))


def similarity_edges(spark: SparkSession, folder: str) -> DataFrame:
    return similarity.similar_pairs(pin(_nodes(spark, folder)), digits=4)


def signal_components(spark: SparkSession, folder: str) -> DataFrame:
    return _clusters(spark, folder).select("timestamp", "signal_id", "cluster")


def cluster_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(quality.cluster_quality(_clusters(spark, folder)), quality=4)


def cluster_members(spark: SparkSession, folder: str) -> DataFrame:
    return fusion.cluster_members(pin(_clusters(spark, folder)))


def cluster_start(spark: SparkSession, folder: str) -> DataFrame:
    return fusion.cluster_start(_clusters(spark, folder))


_FUSED = (
    "offset", "signal_id", "timestamp", "fusion_id", "fusion_start_time", "fusion_longitude", "fusion_latitude",
    "fusion_height", "pre_fusion_id",
)


def fusion_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = _detections(spark, folder)
    identities = fusion.fused(_clusters(spark, folder))
    return fusion.attach_fusion(
        rows.select("offset", *kinematics.NODE, kinematics.signal_id().alias("signal_id")), identities
    ).select(*_FUSED)


def _track_columns(tracks: DataFrame) -> DataFrame:
    return _rounded(tracks, utm_x=3, utm_y=3, speed=3, heading=2, driverlongitude=9, driverlatitude=9)


def track_projection(spark: SparkSession, folder: str) -> DataFrame:
    return _track_columns(track.project_tracks(_fused(spark, folder)))


_FILTERED = {"fused_x": 3, "fused_y": 3, "fused_longitude": 8, "fused_latitude": 8}


def kalman_track(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_utm(_detections(spark, folder).select("offset", *kinematics.NODE, "longitude", "latitude"))
    identities = fusion.fused(_clusters(spark, folder))
    tracks = fusion.attach_fusion(rows, identities.select(*kinematics.NODE, "fusion_id"))
    filtered = track.kalman(pin(tracks.select("offset", "fusion_id", "timestamp", "utm_x", "utm_y")))
    return _rounded(filtered.select("offset", "fusion_id", *_FILTERED), **_FILTERED)


def push_payload(spark: SparkSession, folder: str) -> DataFrame:
    payload = track.push_payload(track.project_tracks(_fused(spark, folder)))
    fields = F.json_tuple("payload", "fusion_id", "utm_x", "latitude").alias("fusion_id", "utm_x", "latitude")
    return payload.select("offset", F.size(F.json_object_keys("payload")).alias("fields"), fields).select(
        "offset", "fusion_id", "fields",
        F.round(F.col("utm_x").cast("double"), 3).alias("utm_x"),
        F.round(F.col("latitude").cast("double"), 6).alias("latitude"),
    )


def _dwd_columns(rows: DataFrame) -> DataFrame:
    rows = rows.select(
        *_FUSED, "utm_x", "utm_y", "speed", "heading", "curr_batch_first",
        F.col("feature.time_range").alias("time_range"), F.col("feature.avg_speed").alias("avg_speed"),
    )
    return _rounded(rows, utm_x=3, utm_y=3, speed=3, heading=2, avg_speed=3)


def dwd_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return _dwd_columns(pipelines.dwd(_jm(spark, folder)))


def dwd_pipeline_lookahead(spark: SparkSession, folder: str) -> DataFrame:
    return _dwd_columns(pipelines.dwd(_jm(spark, folder), mode=kinematics.LOOKAHEAD))


_SLICES, _FILES = 2, 4


def _sent(rows: DataFrame, place: str, topic: str, closing: DataFrame | None = None) -> tuple[list[Callable[[], None]], int]:
    """Steps that send ``value, offset`` rows with a ``timestamp`` to a topic folder, one stretch of time each, and in how many files
    each does so: a micro-batch takes as many, and grows in files, not in rows of a file."""
    seconds = pin(rows.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n")))
    low, high = seconds.agg(F.min("timestamp"), F.max("timestamp")).first()
    width = (high - low) // _SLICES + 1
    stretch = F.floor((F.col("timestamp") - low) / width)
    most = seconds.groupBy(stretch.alias("stretch")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    files = max(_FILES, -(-most // TOPIC_FILE_ROWS))

    def step(part: DataFrame) -> Callable[[], None]:
        return lambda: topics.write_compressed(part.select("value", "offset").repartition(files), f"{place}/{topic}", "append")

    return [step(rows.filter(stretch == k)) for k in range(_SLICES)] + ([step(closing)] if closing is not None else []), files


def _jm_steps(spark: SparkSession, folder: str, place: str) -> tuple[list[Callable[[], None]], int]:
    """All messages in time order, then one of another drone a minute later, which closes all windows but its own."""
    found = pin(fixtures.detections(spark, folder))
    timed = fixtures.jm_messages(found).join(found.select("offset", "timestamp"), "offset")
    late = F.col("high") - F.col("last.timestamp") + F.col("last.lasting_time") + 60
    last = found.agg(F.max_by(F.struct(*found.columns), "offset").alias("last"), F.max("timestamp").alias("high")).select(
        "last.*", late.cast("int").alias("_lasting")
    )
    after = last.withColumns({
        "offset": F.floor(F.col("offset") / 20) * 20 + 28, "drone_uuid": F.lit("UAV9999999"), "lasting_time": F.col("_lasting"),
    })
    return _sent(timed, place, "jm", fixtures.jm_messages(after.drop("_lasting")))


def _dwd_text(spark: SparkSession, folder: str, place: str) -> DataFrame:
    """The columns of :func:`dwd_pipeline` from what the stream has sent."""
    numbers = "speed double, heading double, utm_x double, utm_y double, fusion_longitude double, fusion_latitude double, fusion_height double"
    schema = (
        f"signal_id string, timestamp bigint, fusion_id string, fusion_start_time string, pre_fusion_id string, {numbers}, "
        "curr_batch_first int, feature struct<time_range:int,avg_speed:double>"
    )
    text = spark.read.schema("value string, offset bigint").json(f"{place}/dwd_jm_drone")
    rows = text.select("offset", F.from_json("value", schema).alias("j")).select("offset", "j.*")
    return _dwd_columns(rows)


def _streamed(spark: SparkSession, files: int, place: str) -> None:
    """Run the job until all that was sent is read, and leave its checkpoint for the next run."""
    source = topics.read_topic(spark, "jm", folder=place, maxFilesPerTrigger=str(files))
    jobs.dwd(source, place, f"{place}/checkpoints", trigger=_ONCE).awaitTermination()


def dwd_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Fused detections by the stream, in several micro-batches."""
    place = _new_folder(spark)
    with scratch(spark):  # what the messages are made from is not kept while the stream runs
        steps, files = _jm_steps(spark, folder, place)
        for send in steps:
            send()
    _streamed(spark, files, place)
    return _dwd_text(spark, folder, place)


def recovery_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a job that stops while windows are open and is started again from its checkpoint."""
    place = _new_folder(spark)
    with scratch(spark):
        (first, *others), files = _jm_steps(spark, folder, place)
        first()
        _streamed(spark, files, place)
        for send in others:
            send()
    _streamed(spark, files, place)
    return _dwd_text(spark, folder, place)


def dws_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Tracks by the stream over the text of fused detections."""
    place = _new_folder(spark)
    with scratch(spark):
        fused = pipelines.dwd(_jm(spark, folder))
        fields = [c for c in fused.columns if c != "offset"]
        text = pin(fused.select("offset", "timestamp", F.to_json(F.struct(*fields)).alias("value")))
        steps, files = _sent(text, place, "dwd_jm_drone")
        for send in steps:
            send()
    tracks = jobs.dws(topics.read_topic(spark, "dwd_jm_drone", folder=place, maxFilesPerTrigger=str(files)))
    sink = tracks.writeStream.format("parquet").option("path", f"{place}/tracks")
    topics.start(sink, "dws", f"{place}/checkpoints", _ONCE).awaitTermination()
    return _rounded(_track_columns(spark.read.schema(tracks.schema).parquet(f"{place}/tracks")), **_FILTERED)


def dws_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    fused_text = pin(pipelines.to_text(pipelines.dwd(_jm(spark, folder))))
    return _rounded(_track_columns(pipelines.dws(fused_text)), **_FILTERED)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        jm_decode_route, jm_explode_typed, jm_split_counts, ods_partition_rows, jm_legacy_fallback, aoa_route_fill,
        ods_stream, fan_out_stream, aoa_stream, table_roundtrip,
        pair_pilot_drone, message_balance, utm_forward, utm_inverse, kinematics_causal, kinematics_lookahead, start_position,
        slice_rank, window_features, window_features_lookahead, window_stream_lookahead, expiry_stream, kinematics_gaps, late_rows, sliding_window_counts, similarity_edges, signal_components, cluster_quality,
        cluster_members, cluster_start, fusion_ids, track_projection, kalman_track, push_payload,
        dwd_pipeline, dwd_pipeline_lookahead, dws_pipeline, dwd_stream, recovery_stream, dws_stream,
    )
    return {query.__name__: query for query in listed}
