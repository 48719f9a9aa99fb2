"""Message topics: Kafka on a cluster, a folder of JSON files with the same columns in tests and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from airtrack import schemas
from airtrack.settings import CHECKPOINT_TRIGGER, TOPIC_CODEC

_FILE_SCHEMA = "value string, offset bigint"
_PARTITION_BITS = 12


def _arrival() -> F.Column:
    """One whole number per message that is unique in the topic and grows with the offset of its partition.

    A topic with more partitions than the number has room for fails the job rather than mixing up messages.
    """
    packed = F.shiftleft("offset", _PARTITION_BITS).bitwiseOR(F.col("partition").cast("bigint"))
    fits = F.col("partition") < 1 << _PARTITION_BITS
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("too many partitions in the topic"))).alias("offset")


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    folder: str | None = None,
    starting: str = "earliest",
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """``(value, offset)`` of a topic.  ``folder`` reads ``folder/topic`` as JSON lines instead of Kafka."""
    reader = spark.readStream if streaming else spark.read
    if folder is not None:
        return reader.schema(_FILE_SCHEMA).options(**options).json(f"{folder}/{topic}")
    source = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return source.select(F.col("value").cast("string").alias("value"), _arrival())


def read_tdoa(spark: SparkSession, servers: str | None = None, folder: str | None = None, streaming: bool = True) -> DataFrame:
    """Time-difference messages, newest only; typed, with nothing downstream of them yet."""
    source = read_topic(spark, "tdoa", servers, folder, starting="latest" if streaming else "earliest", streaming=streaming)
    return source.select("offset", F.from_json("value", schemas.TDOA).alias("_t")).select("offset", "_t.*")


def write_topic(
    df: DataFrame,
    topic: str,
    servers: str | None = None,
    folder: str | None = None,
    key: F.Column | None = None,
    checkpoint: str | None = None,
    mode: str = "append",
    trigger: dict | None = None,
):
    """Send text rows ``value`` (and an optional ``key``).  Batch frames are written at once, streams started.

    Kafka delivery is at least once: give a ``key`` such as ``signal_id|timestamp`` and drop duplicates when
    reading (:func:`without_duplicates`).
    """
    fields = [F.col("value")] + ([key.cast("string").alias("key")] if key is not None else [])
    if folder is not None:
        rows = df.select("value", "offset") if "offset" in df.columns else df.select("value")
        if not df.isStreaming:
            return rows.write.mode(mode).json(f"{folder}/{topic}")
        return start(rows.writeStream.format("json").option("path", f"{folder}/{topic}"), topic, checkpoint, trigger)
    rows = df.select(*fields)
    if not df.isStreaming:
        return rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    writer = rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return start(writer, topic, checkpoint, trigger)


def write_compressed(rows: DataFrame, path: str, mode: str) -> None:
    """Text rows as compressed JSON lines, one file per partition, which every reader of a topic folder opens like plain ones."""
    rows.select("value", "offset").write.mode(mode).option("compression", TOPIC_CODEC).json(path)


def start(writer: DataStreamWriter, name: str, checkpoint_root: str, trigger: dict | None = None):
    """Start a query that recovers from ``<checkpoint_root>/<name>``."""
    return (
        writer.queryName(name)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
        .trigger(**(trigger or {"processingTime": CHECKPOINT_TRIGGER}))
        .start()
    )


def without_duplicates(stream: DataFrame, event_time: str, keys: list[str], delay: str) -> DataFrame:
    """First copy of each key within the delay: makes an at-least-once topic exactly-once for its reader."""
    if not stream.isStreaming:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def sample(df: DataFrame, rows: int = 1) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)
