"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airtrack.lineage import pin

#: A side of a join is broadcast up to so many rows and cells (tens of MB), and shuffled beyond.  A text counts as 8 cells
#: and an array as 32.
BROADCAST_ROWS, BROADCAST_CELLS = 500_000, 4_000_000

#: A word for sizes and shingles: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of so few rows that whole texts fit beside each other in a worker.

    Spark's default of 10,000 rows is for numbers; a size that the session has chosen itself is left alone.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, "1000")
    return df


def pin_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Write the rows once; the written copy and the number of its rows."""
    seen = Observation()
    written = pin(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return written, seen.get["n"]


def sized(df: DataFrame) -> DataFrame:
    """Written once, and marked for broadcast only if it is known to be small."""
    written, n = pin_counted(df)
    width = sum({"string": 8, "binary": 8, "array": 32}.get(kind.split("<")[0], 1) for _, kind in df.dtypes)
    return F.broadcast(written) if n <= min(BROADCAST_ROWS, BROADCAST_CELLS // width) else written


def without(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``docs`` whose id is not in the only column of ``ids``; rows with a null id stay."""
    side = sized(ids.toDF("_gone"))
    return docs.join(side, docs[id_col] == side["_gone"], "left_anti")


def only(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``docs`` whose id is in the only column of ``ids``."""
    side = sized(ids.toDF("_wanted"))
    return docs.join(side, docs[id_col] == side["_wanted"], "left_semi")


def spots(seed: int, buckets: int, *cols: str) -> tuple[Column, Column]:
    """Hash and bucket of a row, to draw at most one row per bucket however rows are stored."""
    spot = F.xxhash64(F.lit(seed), *cols)
    return spot.alias("spot"), F.pmod(spot, F.lit(buckets)).alias("bucket")


def term_table(inside) -> bytes:
    """Byte translation that puts A-Z in lower case and a space for every byte that is not ``inside`` a term."""
    return bytes((c + 32 if 65 <= c <= 90 else c) if inside(c) else 32 for c in range(256))


def terms(raw: bytes, table: bytes, step: int = 1_000_000) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded size."""
    raw, first = raw.translate(table), 0
    while first < len(raw):
        end = raw.find(b" ", first + step) if first + step < len(raw) else len(raw)
        end = len(raw) if end < 0 else end
        yield raw[first:end].split()
        first = end + 1
