"""What signals remember between micro-batches: a table dealt into buckets by signal, with versions.

A micro-batch reads the buckets of its own signals as the micro-batch before left them, writes new versions of just these, and
lists the version of every bucket in a manifest of its own.  Nothing is changed in place: a repeated micro-batch starts from the same
manifest and writes the same folders again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrack.lineage import delete
from airtrack.operators import fusion
from airtrack.operators.kinematics import SIGNAL

BUCKETS = 64
#: Micro-batches whose memory is kept for recovery.
KEPT = 10


def bucket() -> Column:
    return F.pmod(F.hash(*SIGNAL), F.lit(BUCKETS))


def touched(rows: DataFrame) -> list[int]:
    """Buckets of the signals in ``rows``, at most :data:`BUCKETS` numbers."""
    return sorted(r[0] for r in rows.select(bucket().alias("b")).distinct().collect())


def manifest(spark: SparkSession, root: str, number: int) -> dict[int, int]:
    """Version of every bucket after micro-batch ``number``; none before the first."""
    if number < 0:
        return {}
    return {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version long").json(f"{root}/manifest/{number}").collect()}


def read(spark: SparkSession, root: str, versions: dict[int, int], buckets: list[int]) -> DataFrame | None:
    """Rows of ``buckets``; only their folders are opened."""
    paths = [f"{root}/version={versions[b]}/bucket={b}" for b in buckets if b in versions]
    return spark.read.parquet(*paths) if paths else None


def write(
    root: str, number: int, versions: dict[int, int], buckets: list[int], identities: DataFrame, memory: DataFrame | None,
    since: int | None = None,
) -> dict[int, int]:
    """Write ``buckets`` as they are after micro-batch ``number``, then its manifest; returns the new versions."""
    spark = identities.sparkSession
    rows = fusion.remembered(identities, memory, since).withColumn("bucket", bucket())
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/version={number}")
    held = {r[0] for r in spark.read.parquet(f"{root}/version={number}").select("bucket").distinct().collect()} if buckets else set()
    left = {b: v for b, v in versions.items() if b not in buckets} | {b: number for b in buckets if b in held}
    keep(spark, root, number, left)
    return left


def keep(spark: SparkSession, root: str, number: int, versions: dict[int, int]) -> None:
    """Write the manifest of micro-batch ``number``."""
    listed = spark.createDataFrame(sorted(versions.items()), "bucket int, version long")
    listed.coalesce(1).write.mode("overwrite").json(f"{root}/manifest/{number}")


def forget(spark: SparkSession, root: str, number: int) -> None:
    """Delete the manifest of micro-batch ``number`` and the versions that only it and earlier ones listed."""
    if number < 0:
        return
    old, later = (manifest(spark, root, n) for n in (number, number + 1))
    for b, version in old.items():
        if later.get(b) != version:
            delete(spark, f"{root}/version={version}/bucket={b}")
    delete(spark, f"{root}/manifest/{number}")
