"""Start-time text and partition columns.  All expressions name their zone; none reads the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airtrack.settings import DEFAULT_EVENT_MS, LOCAL_ZONE, SEPARATOR


def after_separator(text: Column) -> Column:
    """Text after the device number, null when the separator is missing."""
    return F.get(F.split(text, SEPARATOR), F.lit(1))


def _seconds(digits: Column, zone: str) -> Column:
    """Epoch seconds of 14 digits read in a fixed zone, null when they are no valid time."""
    return F.unix_seconds(F.try_to_timestamp(F.concat(digits, F.lit(f" {zone}")), F.lit("yyyyMMddHHmmss VV")))


def ods_event_ms(batch_num: Column, lasting_time: Column, zone: str = LOCAL_ZONE) -> Column:
    """Milliseconds of the 17-digit start time plus ``lasting_time`` *milliseconds* (the table layer's rule)."""
    digits = after_separator(batch_num)
    start = F.when(
        digits.rlike("^[0-9]{17}"),
        _seconds(F.substring(digits, 1, 14), zone) * 1000 + F.substring(digits, 15, 3).cast("bigint"),
    )
    return F.coalesce(start + lasting_time, F.lit(DEFAULT_EVENT_MS))


def event_seconds(batch_num: Column, lasting_time: Column, zone: str = LOCAL_ZONE) -> Column:
    """Epoch seconds of the first 14 digits after the device number plus ``lasting_time`` *seconds*."""
    digits = F.regexp_extract(F.substr(batch_num, F.lit(6)), r"([0-9]{14})", 1)
    return (_seconds(digits, zone) + lasting_time).cast("bigint")


def takeoff_text(intrusion_start_time: Column) -> Column:
    """Start time as ``yyyy-MM-dd HH:mm:ss``; plain text work, null when the digits are no valid time."""
    digits = F.substring(after_separator(intrusion_start_time), 1, 14)
    parts = [F.substring(digits, p, n) for p, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
    text = F.concat(
        parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit(" "),
        parts[3], F.lit(":"), parts[4], F.lit(":"), parts[5],
    )
    return F.when(_seconds(digits, "UTC").isNotNull(), text)


def local_text(epoch_ms: Column, zone: str = LOCAL_ZONE) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of epoch milliseconds in ``zone``."""
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.floor(epoch_ms / F.lit(1000)).cast("decimal(18,6)")
    )
    return F.substring(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("string"), 1, 19)


def partition_columns(epoch_ms: Column, zone: str = LOCAL_ZONE) -> dict[str, Column]:
    """Day and hour partition values."""
    text = local_text(epoch_ms, zone)
    return {"dt": F.substring(text, 1, 10), "hr": F.substring(text, 12, 2)}


def batch_label(second: Column) -> Column:
    """Label ``<start_ms>-<end_ms>`` of the one-second slice that starts at ``second``."""
    second = second.cast("bigint")
    return F.concat((second * 1000).cast("string"), F.lit("-"), ((second + 1) * 1000).cast("string"))
