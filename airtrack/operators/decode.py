"""Decoding and routing sensor messages, and the typed rows of the table layer.

Works on any DataFrame with a text column ``value`` (batch or stream); other columns are carried along.
Nothing fails a job: rows that cannot be used get a ``reason`` and can be kept in a quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrack import schemas
from airtrack.functions import clock, text
from airtrack.settings import DRONE_TYPE

NEW, OLD = "new", "old"


def route_jm(messages: DataFrame) -> DataFrame:
    """Add ``inner`` (decoded text) and ``route``: ``new`` iff the decoded object has a ``drone`` array."""
    inner = text.inner_json(F.col("value"))
    is_array = F.from_json("inner", schemas.JM_MESSAGE)["drone"].isNotNull()
    return messages.withColumn("inner", inner).withColumn(
        "route", F.when(F.coalesce(is_array, F.lit(False)), F.lit(NEW)).otherwise(F.lit(OLD))
    )


def explode_jm(routed: DataFrame, with_old: bool = False) -> DataFrame:
    """One typed row per element of ``drone``; ``reason`` is set when the element is no object or a field is missing.

    A field is missing when its key is; an explicit null reads as 0 or as the text ``null``.  Only ``new`` messages
    have a ``drone`` array, so the outer explode followed by the null filter selects exactly that route while the
    message is parsed once (a filter on ``route`` would be pushed down and parse again).  Elements are parsed one by
    one: a bad one is one row with a reason and the others of its message stay.  ``with_old`` keeps the other messages, too: one
    row each, with its text in ``old`` and no further field.
    """
    carried = [c for c in routed.columns if c not in ("value", "inner", "route")]
    old = ["value"] if with_old else []
    wrapped = F.transform("_m.drone", lambda e: F.struct(e.alias("text"), F.lit(False).alias("empty")))
    none = F.array(F.struct(F.lit(None).cast("string").alias("text"), F.lit(True).alias("empty")))  # one row, with a reason
    each = F.when(F.size("_m.drone") == 0, none).otherwise(wrapped)
    elements = (
        routed.select(*carried, *old, F.from_json("inner", schemas.JM_MESSAGE).alias("_m"), F.json_object_keys("inner").alias("_keys"))
        .select(*carried, *old, "_keys", F.col("_m.station_id").alias("_station"), F.explode_outer(each).alias("_e"))
        .filter(F.lit(with_old) | F.col("_e").isNotNull())
        .select(
            *carried, *(F.when(F.col("_e").isNull(), F.col(c)).alias("old") for c in old), text.present(F.col("_station"), F.col("_keys"), "station_id").alias("station_id"),
            F.from_json("_e.text", schemas.JM_ELEMENT).alias("_o"), F.json_object_keys("_e.text").alias("_k"),
            F.col("_e.empty").alias("_empty"),
        )
    )
    fields = {name: text.present(F.col("_o")[name], F.col("_k"), name) for name, _ in schemas.JM_DRONE_FIELDS}
    kept = [*carried, *("old" for _ in old)]
    read = text.computed_once(
        elements.select(*kept, "station_id", "_empty", F.col("_k").isNull().alias("_none"), *(f.alias(n) for n, f in fields.items()))
    )
    missing = F.col("station_id").isNull()
    for name in fields:
        missing = missing | F.col(name).isNull()
    typed = read.select(
        *kept,
        *[text.cast_lenient(F.col(name), kind).alias(name) for name, kind in schemas.JM_DRONE_FIELDS],
        "station_id",
        F.when(F.col("_empty"), F.lit("no elements"))
        .when(F.col("_none"), F.lit("not an object"))
        .when(missing, F.lit("missing field"))
        .when(clock.after_separator(F.col("batch_num")).isNull(), F.lit("no separator in batch_num"))
        .alias("reason"),
    )
    if not with_old:
        return typed
    return typed.select(*carried, *(F.when(F.col("old").isNull(), F.col(c)).alias(c) for c in typed.columns if c not in kept), "old")


def parse_jm(messages: DataFrame) -> DataFrame:
    """All that the messages become, in one table: the columns of :func:`explode_jm` and ``old``, the text of an old message.

    Every message has a row; a reader picks its rows by ``reason`` and ``old``, so one written copy serves any number of tables.
    The text is parsed once: an old message is what has no ``drone`` array to explode.
    """
    return explode_jm(route_jm(messages), with_old=True)


def with_ods_time(rows: DataFrame) -> DataFrame:
    """Add the epoch-millisecond ``timestamp`` and its ``dt`` / ``hr`` partition values."""
    stamped = rows.withColumn("timestamp", clock.ods_event_ms(F.col("batch_num"), F.col("lasting_time")))
    return stamped.withColumns(clock.partition_columns(F.col("timestamp")))


def ods_jm(messages: DataFrame) -> DataFrame:
    """Typed, hour-partitioned rows of all usable elements, remotes and drones together."""
    return usable_jm(explode_jm(route_jm(messages)))


def usable_jm(elements: DataFrame) -> DataFrame:
    return with_ods_time(elements.filter(F.col("reason").isNull())).select(*_columns(schemas.ODS_JM_COLUMNS, {"scanid": F.col("scanID")}))


def is_drone() -> Column:
    """Row goes to the drone table; everything else, unknown types included, to the remote table."""
    return F.col("type") == DRONE_TYPE


def split_by_type(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    drone = F.coalesce(is_drone(), F.lit(False))
    return rows.filter(drone), rows.filter(~drone)


def target() -> Column:
    """Name of the table a row goes to."""
    return F.when(is_drone(), F.lit("drone")).otherwise(F.lit("remote"))


def legacy_jm(routed: DataFrame) -> DataFrame:
    """Rows of the old flat format; a message that lacks one of its keys keeps its text in ``batch_num``."""
    carried = [c for c in routed.columns if c not in ("value", "inner", "route")]
    schema = ", ".join(f"{name} string" for name, _ in schemas.JM_OLD_FIELDS)
    parsed = routed.filter(F.col("route") == OLD).withColumn("_j", F.from_json("value", schema)).withColumn(
        "_k", F.json_object_keys("value")
    )
    complete = F.lit(True)
    for name, _ in schemas.JM_OLD_FIELDS:
        complete = complete & F.array_contains("_k", name)
    parsed = parsed.withColumn("_complete", F.coalesce(complete, F.lit(False)))
    defaults = {"string": F.lit(None).cast("string"), "double": F.lit(0.0), "int": F.lit(0), "bigint": F.lit(0).cast("bigint")}
    columns = []
    for name, kind in schemas.JM_OLD_FIELDS:
        fallback = F.col("value") if name == "batch_num" else defaults[kind]
        columns.append(
            F.when(F.col("_complete"), text.cast_lenient(text.present(F.col("_j")[name], F.col("_k"), name), kind)).otherwise(fallback).alias(name)
        )
    return parsed.select(*carried, *columns)


def ods_jm_old(messages: DataFrame) -> DataFrame:
    return old_rows(route_jm(messages))


def old_rows(routed: DataFrame) -> DataFrame:
    rows = legacy_jm(routed).withColumns(clock.partition_columns(F.col("timestamp")))
    return rows.select(*_columns(schemas.ODS_JM_OLD_COLUMNS, {}))


def route_aoa(messages: DataFrame) -> DataFrame:
    """Add ``route``: ``new`` iff the message is an object with a ``devId`` key (a null value counts)."""
    keys = F.json_object_keys(F.col("value"))
    valid = F.get_json_object("value", "$").isNotNull() & F.ltrim("value").startswith("{")
    has_device = F.when(valid, F.array_contains(keys, "devId"))
    return messages.withColumn(
        "route", F.when(F.coalesce(has_device, F.lit(False)), F.lit(NEW)).otherwise(F.lit(OLD))
    )


def typed_aoa(routed: DataFrame, now_ms: Column | int | None = None) -> DataFrame:
    """Typed direction rows; a missing ``timestamp`` becomes ``now_ms`` (default: the current time), a null one 0."""
    carried = [c for c in routed.columns if c not in ("value", "inner", "route")]
    schema = ", ".join(f"{name} string" for name, _ in schemas.AOA_FIELDS)
    if now_ms is None:
        now_ms = F.unix_millis(F.current_timestamp())
    now = F.lit(now_ms).cast("bigint")
    parsed = routed.filter(F.col("route") == NEW).withColumn("_j", F.from_json("value", schema)).withColumn(
        "_k", F.json_object_keys("value")
    )
    columns = []
    missing = F.lit(False)
    for name, kind in schemas.AOA_FIELDS:
        field = text.present(F.col("_j")[name], F.col("_k"), name)
        if name == "timestamp":
            columns.append(F.when(field.isNull(), now).otherwise(text.cast_lenient(field, kind)).alias(name))
        else:
            columns.append(text.cast_lenient(field if name != "devId" else F.col("_j")[name], kind).alias(name))
            if name != "devId":
                missing = missing | field.isNull()
    return text.computed_once(
        parsed.select(*carried, *columns, F.when(missing, F.lit("missing field")).alias("reason"))
    )


def ods_aoa(messages: DataFrame, now_ms: Column | int | None = None) -> DataFrame:
    rows = typed_aoa(route_aoa(messages), now_ms).filter(F.col("reason").isNull())
    stamped = rows.withColumns(clock.partition_columns(F.col("timestamp")))
    return stamped.select(*_columns(schemas.ODS_AOA_COLUMNS, {"lasting_time": F.col("lasting_time").cast("bigint")}))


def _columns(ddl: str, replace: dict[str, Column]) -> list[Column]:
    names = [part.split()[0].strip("`") for part in ddl.split(", ")]
    return [replace.get(name, F.col(name)).alias(name) for name in names]
