"""Cutting lineage in iterative jobs.

Intermediate results are written as Parquet under the shared folder the session names and read back, so a lost
executor costs a re-read and not a wrong or failed job, later steps read only the columns they need, and the
planner knows the true size of what it joins.
"""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_open = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else a folder in the warehouse: both are shared by driver and executors."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"


def pin(df: DataFrame) -> DataFrame:
    """Write the rows once and continue from the written copy."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/airtrack/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def pin_and_test(df: DataFrame, condition: Column) -> tuple[DataFrame, bool]:
    """:func:`pin`, and whether any row meets ``condition``, found while writing."""
    seen = Observation()
    pinned = pin(df.observe(seen, F.max(F.coalesce(condition, F.lit(False))).alias("any")))
    return pinned, bool(seen.get["any"])


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete everything pinned inside the block when it ends; for long-running jobs."""
    outer, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        paths, _open.paths = _open.paths, outer
        for path in paths:
            delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete everything this application has pinned."""
    delete(spark, f"{shared_folder(spark)}/airtrack/{spark.sparkContext.applicationId}")


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
