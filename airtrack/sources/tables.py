"""Hour-partitioned tables: definition, batch and streaming inserts, and the marker of finished partitions."""

from __future__ import annotations

import contextlib
import time
import urllib.parse
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrack import schemas
from airtrack.sources.topics import start
from airtrack.settings import OPEN_FILES, PARTITION_COMMIT_DELAY_SECONDS

TABLES = {
    "ods_jm_drone": schemas.ODS_JM_COLUMNS,
    "ods_jm_remote": schemas.ODS_JM_COLUMNS,
    "ods_aoa": schemas.ODS_AOA_COLUMNS,
    "ods_jm_old": schemas.ODS_JM_OLD_COLUMNS,
}


def use(spark: SparkSession, catalog: str | None = None, database: str = "ods") -> None:
    """Make a catalog and database current; the database is created when it does not exist."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.catalog.setCurrentDatabase(database)


def create_table(spark: SparkSession, name: str, database: str = "ods", location: str | None = None) -> str:
    """Create the database and one partitioned table when they do not exist; returns the full name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{name} ({TABLES[name]}) USING parquet PARTITIONED BY (dt, hr){place}"
    )
    return f"{database}.{name}"


@contextlib.contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Let a task write several partition values side by side; a session that has set a number of its own keeps it.

    Spark sorts all rows of a task by partition value before it writes them otherwise, and a task that holds much of a large
    hour keeps them in memory for that.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if int(before) > 0:
        yield
        return
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def insert(rows: DataFrame, table: str) -> None:
    """Append to a partitioned table.  The rebalance step gives each partition value few, evenly sized files:
    it merges small ones and splits an hour that holds much of the data."""
    columns = rows.sparkSession.table(table).columns
    with open_files(rows.sparkSession):
        rows.select(*columns).hint("rebalance", F.col("dt"), F.col("hr")).write.insertInto(table)


def insert_stream(
    rows: DataFrame, name: str, location: str, checkpoint_root: str, trigger: dict | None = None, by: tuple[str, ...] = ("dt", "hr")
):
    """Stream into the table's folder; Spark's file sink makes every micro-batch visible exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(*by).option("path", location)
    return start(writer, name, checkpoint_root, trigger)


def read_target(spark: SparkSession, name: str, target: str, location: str) -> DataFrame:
    """Rows of one of the tables that a stream has filled side by side in ``location``, through the sink's log."""
    rows = spark.read.schema(f"{TABLES[name]}, target string").parquet(location)
    return rows.filter(F.col("target") == target).drop("target")


def create_fan_out(spark: SparkSession, names: list[str], root: str, database: str = "ods") -> None:
    """Tables that one stream fills together: ``<name>_batches`` keyed by micro-batch as well, and the view ``<name>`` of all
    micro-batches that are complete in every table.

    A micro-batch is complete when its number is in ``<root>/complete``, which is written last.  Readers of the views prune by
    ``dt`` and ``hr`` as before and never see a part of a micro-batch, nor a table that is ahead of the others.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.complete_batches (number BIGINT, batch BIGINT) USING parquet PARTITIONED BY (batch) LOCATION '{root}/complete'")
    for name in names:
        table = f"{database}.{name}_batches"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({TABLES[name]}, batch BIGINT) USING parquet "
            f"PARTITIONED BY (dt, hr, batch) LOCATION '{root}/{name}'"
        )
        columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != "batch")
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {table} "
            f"WHERE batch IN (SELECT number FROM {database}.complete_batches)"
        )


def write_batch(parts: dict[str, DataFrame], number: int, database: str = "ods") -> None:
    """Write the rows of one micro-batch to the tables of :func:`create_fan_out`, then list it as complete.

    Partitions are overwritten, so a micro-batch that failed half-way and is repeated leaves one copy.
    """
    spark = next(iter(parts.values())).sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    batch = F.lit(number).cast("bigint").alias("batch")
    for name, rows in parts.items():
        table = f"{database}.{name}_batches"
        kept = rows.select(*[c for c in spark.table(table).columns if c != "batch"], batch)
        with open_files(spark):
            kept.hint("rebalance", F.col("dt"), F.col("hr")).write.mode("overwrite").insertInto(table)
    spark.range(1).select(batch.alias("number"), batch).write.mode("overwrite").insertInto(f"{database}.complete_batches")


def commit_partitions(
    spark: SparkSession,
    table: str,
    now: float | None = None,
    delay_seconds: int = PARTITION_COMMIT_DELAY_SECONDS,
) -> list[tuple[str, str]]:
    """Mark partitions first written at least ``delay_seconds`` ago as complete.

    A complete partition is registered in the catalog and gets a ``_SUCCESS`` file.  Returns the newly marked
    ``(dt, hr)`` values.  Only folder names are listed; no data is read.
    """
    now_ms = (time.time() if now is None else now) * 1000
    location = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(location)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    marked = []
    for folder in files.globStatus(hadoop.Path(root, "dt=*/hr=*")) or []:
        path = folder.getPath()
        marker = hadoop.Path(path, "_SUCCESS")
        if files.exists(marker):
            continue
        data = [f.getModificationTime() for f in files.listStatus(path) if not f.getPath().getName().startswith(("_", "."))]
        if not data or min(data) + delay_seconds * 1000 > now_ms:
            continue
        dt = urllib.parse.unquote(path.getParent().getName().split("=", 1)[1])
        hr = urllib.parse.unquote(path.getName().split("=", 1)[1])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (dt='{dt}', hr='{hr}')")
        files.create(marker).close()
        marked.append((dt, hr))
    return sorted(marked)
