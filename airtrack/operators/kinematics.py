"""Speed, heading, start position and five-second window features of every signal.

All rows of one signal that share a second also share their kinematics, so the work is done on one row per
(signal, second), built with map-side pre-aggregation: copies and bursts collapse before they are shuffled, and
a window over one signal is as long as its flight in seconds, however many rows it has.  Rows are joined to the
result only where row-level output is wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airtrack.functions import clock
from airtrack.functions.geo import planar_heading, planar_speed, with_utm
from airtrack.operators.ranking import numbered
from airtrack.settings import SLIDE_SECONDS, UTM_ZONE, WINDOW_SECONDS

SIGNAL = ["drone_uuid", "batch_num"]
NODE = [*SIGNAL, "timestamp"]
CAUSAL, LOOKAHEAD = "causal", "lookahead"


def signal_id() -> Column:
    return F.concat("drone_uuid", F.lit("_"), "batch_num")


def signal_seconds(rows: DataFrame) -> DataFrame:
    """One row per (signal, second): extent, height sum, first and last position in arrival order."""
    reported = F.coalesce(F.col("speed"), F.lit(0.0)) if "speed" in rows.columns else F.lit(0.0)
    observed = rows.select(
        "offset", *NODE, "intrusion_start_time", "latitude", "longitude", "height", reported.alias("_speed")
    )
    partial = observed.groupBy(*NODE, "intrusion_start_time").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
        F.sum("height").alias("sum_height"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.min_by("latitude", "offset").alias("first_lat"),
        F.min_by("longitude", "offset").alias("first_lon"),
        F.min_by("height", "offset").alias("first_height"),
        F.min_by("_speed", "offset").alias("first_speed"),
        F.max_by("latitude", "offset").alias("last_lat"),
        F.max_by("longitude", "offset").alias("last_lon"),
    )
    # The window step below needs this partitioning anyway; the second aggregation rides on it.
    return (
        partial.repartition(*SIGNAL)
        .groupBy(*NODE)
        .agg(
            F.sum("n").alias("n"),
            F.min("min_lat").alias("min_lat"),
            F.max("max_lat").alias("max_lat"),
            F.min("min_lon").alias("min_lon"),
            F.max("max_lon").alias("max_lon"),
            F.sum("sum_height").alias("sum_height"),
            *[
                F.min_by(name, "first_offset").alias(name)
                for name in ("intrusion_start_time", "first_lat", "first_lon", "first_height", "first_speed")
            ],
            F.max_by("last_lat", "last_offset").alias("last_lat"),
            F.max_by("last_lon", "last_offset").alias("last_lon"),
        )
    )


def with_flights(seconds: DataFrame, gap_seconds: int) -> DataFrame:
    """Add ``_flight``: how often the signal had been silent for more than ``gap_seconds`` before the row."""
    by_time = Window.partitionBy(*SIGNAL).orderBy("timestamp")
    cut = F.col("timestamp") - F.lag("timestamp").over(by_time) > gap_seconds
    return seconds.withColumn("_cut", F.coalesce(cut.cast("int"), F.lit(0))).withColumn("_flight", F.sum("_cut").over(by_time)).drop("_cut")


def node_features(rows: DataFrame, mode: str = CAUSAL, zone: int = UTM_ZONE, gap_seconds: int | None = None) -> DataFrame:
    """Kinematics and window features per (signal, second).

    ``causal``: speed and heading come from the step that led to the second.  ``lookahead``: a row carries the
    value of the last step seen before its five-second window had closed, i.e. up to three seconds ahead.  A signal that was
    silent for more than ``gap_seconds``, which must not be shorter than a window, starts anew.
    """
    seconds, keys = signal_seconds(rows), list(SIGNAL)
    if gap_seconds is not None:
        if gap_seconds < WINDOW_SECONDS:
            raise ValueError(f"a gap must last {WINDOW_SECONDS} seconds at least")
        seconds, keys = with_flights(seconds, gap_seconds), [*SIGNAL, "_flight"]
    placed = with_utm(seconds, "first_lon", "first_lat", "first_x", "first_y", zone)
    placed = with_utm(placed, "last_lon", "last_lat", "last_x", "last_y", zone)
    by_time = Window.partitionBy(*keys).orderBy("timestamp")
    ahead = WINDOW_SECONDS - SLIDE_SECONDS
    window = by_time.rangeBetween(0, ahead)
    stepped = placed.withColumns({
        "_dx": F.col("first_x") - F.lag("last_x").over(by_time),
        "_dy": F.col("first_y") - F.lag("last_y").over(by_time),
        "_dt": F.col("timestamp") - F.lag("timestamp").over(by_time),
        "start_latitude": F.first("first_lat").over(by_time),
        "start_longitude": F.first("first_lon").over(by_time),
        "start_height": F.first("first_height").over(by_time),
    })
    dx, dy, dt = F.col("_dx"), F.col("_dy"), F.col("_dt")
    real = stepped.withColumns({
        "_speed": F.coalesce(planar_speed(dx, dy, dt), F.col("first_speed")),
        "_heading": F.when(dt.isNull(), F.lit(0.0)).otherwise(planar_heading(dx, dy)),
    })
    if mode == CAUSAL:
        emitted = real.withColumns({"speed": F.col("_speed"), "heading": F.col("_heading")})
        speed_sum = F.sum(F.col("n") * F.col("_speed")).over(window)
    elif mode == LOOKAHEAD:
        seen = by_time.rangeBetween(0, ahead - SLIDE_SECONDS)
        emitted = real.withColumns({"speed": F.last("_speed").over(seen), "heading": F.last("_heading").over(seen)})
        later = F.sum(F.col("n") * F.col("_speed")).over(by_time.rangeBetween(SLIDE_SECONDS, ahead))
        speed_sum = F.col("n") * F.col("speed") + F.coalesce(later, F.lit(0.0))
    else:
        raise ValueError(f"mode must be {CAUSAL!r} or {LOOKAHEAD!r}")
    window_rows = F.sum("n").over(window)
    return emitted.select(
        *NODE,
        signal_id().alias("signal_id"),
        "intrusion_start_time",
        "n",
        "speed",
        "heading",
        "start_latitude",
        "start_longitude",
        "start_height",
        (F.max("max_lat").over(window) - F.min("min_lat").over(window)).alias("lat_range"),
        (F.max("max_lon").over(window) - F.min("min_lon").over(window)).alias("lon_range"),
        (F.max("timestamp").over(window) - F.col("timestamp")).cast("int").alias("time_range"),
        (speed_sum / window_rows).alias("avg_speed"),
        (F.sum("sum_height").over(window) / window_rows).alias("avg_height"),
    )


def feature_struct() -> Column:
    return F.struct("signal_id", "lat_range", "lon_range", "time_range", "avg_speed", "avg_height")


def attach_kinematics(
    rows: DataFrame, nodes: DataFrame, zone: int = UTM_ZONE, extra: Sequence[str] = ()
) -> DataFrame:
    """Rows with their planar position and the kinematics and features of their (signal, second).

    ``extra`` names further columns of ``nodes`` to hand to the rows in the same join.
    """
    per_node = nodes.select(
        *NODE, "speed", "heading", "start_latitude", "start_longitude", "start_height",
        feature_struct().alias("feature"), *extra,
    )
    placed = with_utm(rows.drop("speed", "signal_id"), zone=zone)
    return (
        placed.join(per_node, NODE)
        .withColumn("signal_id", signal_id())
        .withColumn("curr_batch_time", clock.batch_label(F.col("timestamp")))
    )


def kinematics(rows: DataFrame, mode: str = CAUSAL, zone: int = UTM_ZONE, gap_seconds: int | None = None) -> DataFrame:
    return attach_kinematics(rows, node_features(rows, mode, zone, gap_seconds), zone)


def slice_rank(rows: DataFrame, **limits) -> DataFrame:
    """Add ``curr_batch_time`` and ``curr_batch_first``: arrival order of a row in its signal's second."""
    ranked = numbered(rows, NODE, ["offset"], "curr_batch_first", **limits)
    return ranked.withColumns({
        "curr_batch_first": F.col("curr_batch_first").cast("int"), "curr_batch_time": clock.batch_label(F.col("timestamp")),
    })


def sliding_counts(rows: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Rows per signal and sliding window; rows are counted per second before windows are expanded."""
    per_second = rows.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n"))
    back = F.explode(F.sequence(F.lit(0), F.lit(window_seconds - 1)))
    return (
        per_second.select(*NODE, "n", back.alias("_back"))
        .withColumn("window_start", F.col("timestamp") - F.col("_back"))
        .groupBy(*SIGNAL, "window_start")
        .agg(F.sum("n").alias("rows"))
    )
