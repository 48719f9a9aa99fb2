"""Detections from sensor messages: one drone element per message, paired with its pilot's position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrack import schemas
from airtrack.functions import clock, text
from airtrack.settings import DRONE_TYPE, ESCAPED_SEPARATOR, REMOTE_TYPE

_OPTIONAL_NUMBERS = ("frequency", "speed")
_REQUIRED_NUMBERS = ("height", "latitude", "longitude")


def _last(kind: int) -> Column:
    return F.try_element_at(
        F.filter("_elements", lambda e: e["type"].try_cast("double") == kind), F.lit(-1)
    )


def pair_messages(messages: DataFrame) -> DataFrame:
    """Detections with ``driverlongitude`` / ``driverlatitude`` / ``signal_id`` / ``timestamp`` / ``event_time``.

    The last remote-control element gives the pilot's position and the last drone element the record.
    ``reason`` names why a message is unusable and is null for good rows.
    """
    carried = [c for c in messages.columns if c != "value"]
    decoded = messages.select(
        *carried, F.replace(text.inner_json(F.col("value")), F.lit(ESCAPED_SEPARATOR), F.lit("")).alias("_inner")
    )
    parsed = decoded.withColumn("_m", F.from_json("_inner", schemas.JM_MESSAGE)).select(
        *carried,
        F.col("_inner").isNotNull().alias("_decoded"),
        F.col("_m.drone").isNotNull().alias("_has_array"),
        F.col("_m.station_id").alias("station_id"),
        F.transform("_m.drone", lambda e: F.from_json(e, schemas.JM_ELEMENT)).alias("_elements"),
    )
    picked = parsed.select(
        *carried, "_decoded", F.coalesce("_has_array", F.lit(False)).alias("_has_array"), "station_id",
        _last(DRONE_TYPE).alias("_d"), _last(REMOTE_TYPE).alias("_r"),
    )
    d = F.col("_d")
    lasting = d["lasting_time"].try_cast("double")
    typed = picked.select(
        *carried,
        d["batch_num"].alias("batch_num"),
        text.whole(d["detect_type"]).alias("detect_type"),
        d["drone_uuid"].alias("drone_uuid"),
        text.finite(d["frequency"]).alias("frequency"),
        text.finite(d["height"]).alias("height"),
        d["intrusion_start_time"].alias("intrusion_start_time"),
        text.whole(d["lasting_time"]).alias("lasting_time"),
        text.finite(d["latitude"]).alias("latitude"),
        text.finite(d["longitude"]).alias("longitude"),
        d["model"].alias("model"),
        F.from_json(d["scanID"], "array<struct<id:string>>").alias("scanID"),
        text.finite(d["speed"]).alias("speed"),
        text.whole(d["type"]).alias("type"),
        text.finite(F.col("_r.longitude")).alias("driverlongitude"),
        text.finite(F.col("_r.latitude")).alias("driverlatitude"),
        "station_id",
        F.concat(d["drone_uuid"], F.lit("_"), d["batch_num"]).alias("signal_id"),
        clock.event_seconds(d["batch_num"], lasting).alias("timestamp"),
        "_decoded", "_has_array", d.isNotNull().alias("_has_drone"), F.col("_r").isNotNull().alias("_has_pilot"),
        *[d[name].isNotNull().alias(f"_has_{name}") for name in _OPTIONAL_NUMBERS],
    )
    bad_number = F.lit(False)
    for name in _OPTIONAL_NUMBERS:
        bad_number = bad_number | (F.col(f"_has_{name}") & F.col(name).isNull())
    for name in _REQUIRED_NUMBERS:
        bad_number = bad_number | F.col(name).isNull()
    reason = (
        F.when(~F.col("_decoded"), "not a JSON text of an object")
        .when(~F.col("_has_array"), "no drone array")
        .when(F.col("station_id").isNull(), "no station_id")
        .when(~F.col("_has_drone"), "no drone element")
        .when(~F.col("_has_pilot"), "no pilot element")
        .when(F.col("driverlongitude").isNull() | F.col("driverlatitude").isNull(), "no pilot position")
        .when(F.col("signal_id").isNull() | F.col("intrusion_start_time").isNull(), "no signal id")
        .when(F.col("timestamp").isNull(), "no start time")
        .when(bad_number, "bad number")
    )
    return text.computed_once(
        typed.select(
            *[c for c in typed.columns if not c.startswith("_")],
            F.col("timestamp").alias("event_time"),
            reason.alias("reason"),
        )
    )


def good_rows(paired: DataFrame) -> DataFrame:
    return paired.filter(F.col("reason").isNull()).drop("reason")


def quarantined(paired: DataFrame) -> DataFrame:
    return paired.filter(F.col("reason").isNotNull())
