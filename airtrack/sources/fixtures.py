"""Detections and sensor messages derived by Spark from the ``events`` table.

The events of one user are hours apart; the derivation compresses them into flights of 40 rows with three
sensors on each target, so that sliding windows, pair links and tracks all have work that grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrack.functions.text import json_string_literal
from airtrack.lineage import pin
from airtrack.operators.ranking import numbered
from airtrack.settings import SEPARATOR

STATION = "100094"
DEVICE = "92025"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def detections(spark: SparkSession, folder: str) -> DataFrame:
    """Typed detections, one row per event."""
    source = events(spark, folder).select("event_id", "user_id", "event_type", "ts")
    seq = F.col("_n").cast("bigint") - 1
    in_order = numbered(source, ["user_id"], ["ts", "event_id"], "_n").select(
        "event_id",
        "event_type",
        "user_id",
        F.floor(F.col("user_id") / 3).alias("target"),
        F.floor(seq / 40).alias("flight"),
        (seq % 40).alias("pos"),
    )
    placed = in_order.withColumns({
        "lasting_time": (F.floor(F.col("pos") * 9 / 10) + 7 * F.floor(F.col("pos") / 10)).cast("int"),
        "base": F.lit(1733468325) + F.col("flight") * 120 + F.col("target") % 5,
    })
    day = (F.col("base") + 28800) % 86400
    clock = F.concat(*[
        F.lpad(part.cast("int").cast("string"), 2, "0")
        for part in (F.floor(day / 3600), F.floor(day / 60) % 60, day % 60)
    ])
    started = placed.withColumn(
        "intrusion_start_time", F.concat(F.lit(f"{DEVICE}{SEPARATOR}20241206"), clock, F.lit("781"))
    )
    target, lasting, event = F.col("target"), F.col("lasting_time"), F.col("event_id")
    latitude = (
        22520713
        + (target % 50) * 1500
        + lasting * (50 + (target % 7) * 5)
        + event % 3
        + F.when(F.col("event_type") == "error", 40).otherwise(0)
    )
    longitude = 114052045 + (target % 50) * 1700 + lasting * 30 + event % 3
    return started.select(
        event.alias("offset"),
        F.concat(F.lit("UAV"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("drone_uuid"),
        F.concat("intrusion_start_time", F.lit("1")).alias("batch_num"),
        "intrusion_start_time",
        "lasting_time",
        (F.col("base") + lasting).alias("timestamp"),
        (100 + (target % 4) * 10).cast("double").alias("_tens"),
        (latitude.cast("double") / 1000000).alias("latitude"),
        (longitude.cast("double") / 1000000).alias("longitude"),
        "event_type",
    ).select(
        "offset", "drone_uuid", "batch_num", "intrusion_start_time", "lasting_time", "timestamp",
        (F.col("_tens") + (F.col("offset") % 2) * F.lit(0.1)).alias("height"),
        "latitude", "longitude", "event_type",
    )


def jm_messages(found: DataFrame) -> DataFrame:
    """Sensor messages ``(value, offset)``: double-encoded objects plus every kind of bad or old message.

    The rendered text is written once, as a topic would hold it, so that readers parse a plain column.
    """
    kind = F.col("offset") % 20
    model = F.concat(F.lit("M"), F.floor(F.substr("drone_uuid", F.lit(4)).cast("bigint") / 3).cast("string"))

    def element(number: int, shift: float, **changes) -> F.Column:
        fields = {
            "batch_num": F.col("batch_num"),
            "detect_type": F.lit(1),
            "drone_uuid": F.col("drone_uuid"),
            "frequency": F.lit(5.8),
            "height": F.col("height"),
            "intrusion_start_time": F.col("intrusion_start_time"),
            "lasting_time": F.col("lasting_time"),
            "latitude": F.col("latitude") - shift,
            "longitude": F.col("longitude") - shift,
            "model": model,
            "scanID": F.array(F.struct(F.lit(DEVICE).alias("id")), F.struct(F.lit("7").alias("id"))),
            "speed": F.lit(7.5),
            "type": F.lit(number),
        }
        fields.update(changes)
        return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))

    bad_start = F.when(kind == 5, F.lit(f"{DEVICE}{SEPARATOR}2024")).otherwise(F.col("batch_num"))
    parts = found.select(
        "*",
        element(1, 0.0, batch_num=bad_start, height=F.when(kind == 6, F.lit(0.5)).otherwise(F.col("height"))).alias("_d"),
        element(0, 0.001).alias("_r"),
    ).withColumn("_d", F.when(kind == 6, F.replace("_d", F.lit(':0.5,'), F.lit(':"abc",'))).otherwise(F.col("_d")))
    elements = (
        F.when(kind == 4, F.col("_d"))
        .when(kind == 7, F.concat_ws(",", "_r", F.replace("_d", model, F.lit("first")), "_d"))
        .otherwise(F.concat_ws(",", "_r", "_d"))
    )
    station = F.lit(f'{{"station_id":"{STATION}"')
    inner = (
        F.when(kind == 2, F.concat(station, F.lit("}")))
        .when(kind == 3, F.concat(station, F.lit(',"drone":'), "_d", F.lit("}")))
        .otherwise(F.concat(station, F.lit(',"drone":['), elements, F.lit("]}")))
    )
    old = F.to_json(
        F.struct(
            "intrusion_start_time", "latitude", F.lit(1).alias("target_type"),
            F.concat(F.lit("uk-"), F.col("offset").cast("string")).alias("droneUK"), "batch_num",
            F.lit(0.5).alias("speed"), F.lit(1.4).alias("frequency"),
            (F.col("longitude") - 0.001).alias("driver_longitude"), "lasting_time", F.lit(1).alias("data_type"),
            F.lit("Haikang").alias("model"), (F.col("latitude") - 0.001).alias("driver_latitude"),
            "longitude", "height", (F.col("timestamp") * 1000).alias("timestamp"),
        )
    )
    literal = parts.withColumn("_inner", json_string_literal(inner))
    value = F.when(kind == 0, F.lit("not json")).when(kind == 1, old).otherwise(F.col("_inner"))
    return pin(literal.select(value.alias("value"), "offset"))


def aoa_messages(found: DataFrame) -> DataFrame:
    """Single-encoded direction messages; some lack the device, the time, or are no JSON at all."""
    kind = F.col("event_type")
    value = F.when(kind == "error", F.lit("{broken")).otherwise(
        F.to_json(
            F.struct(
                F.when(kind != "click", F.lit("60104")).alias("devId"),
                F.col("batch_num").alias("batchno"),
                (F.col("offset") % 1000 / 4).alias("distance"),
                "lasting_time",
                F.lit(2.4).alias("channel"),
                F.lit("AOA").alias("model"),
                (F.col("offset") % 360 / 2).alias("direction"),
                F.when(kind != "signup", F.col("timestamp") * 1000).alias("timestamp"),
            )
        )
    )
    return pin(found.select(value.alias("value"), "offset"))
