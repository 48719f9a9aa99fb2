"""Row numbers within a key that stay exact and parallel when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airtrack.lineage import pin
from airtrack.settings import TASK_ROWS


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add ``name`` = 1, 2, ... (bigint) per key in the given total order.

    The key counts (one narrow pre-aggregated pass) decide the plan.  When every key fits one task this
    is a plain window.  Otherwise rows are range-partitioned on key and order, which splits any key into
    slices of even size; slice counts are summed up per key and added to the row number in the slice.
    """
    counts = df.groupBy(*keys).count()
    if counts.filter(F.col("count") > task_rows).isEmpty():
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))

    sliced = pin(df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sliced.groupBy(*keys, "_slice")
        .count()
        .withColumn("_base", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(in_slice))
        .join(bases, [*keys, "_slice"])
        .withColumn(name, (F.col("_base") + F.col("_rank")).cast("bigint"))
        .select(*df.columns, name)
    )
