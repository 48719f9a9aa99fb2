"""Similarity of signals that are in the air in the same second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrack.lineage import pin
from airtrack.settings import GRID_TASK_ROWS, SIMILARITY_THRESHOLD

DIMENSIONS = ("lat_range", "lon_range", "time_range", "avg_speed", "avg_height")
_SLACK = 1e-9  # keeps rounding at a cell border from hiding a pair


def reach(threshold: float) -> float:
    """Distance below which two feature vectors are more similar than ``threshold``."""
    return 1.0 / threshold - 1.0


def _field(vector: str | Column, name: str) -> Column:
    return F.col(f"{vector}.{name}") if isinstance(vector, str) else vector[name]


def distance(left: str | Column, right: str | Column) -> Column:
    total = None
    for name in DIMENSIONS:
        gap = _field(left, name) - _field(right, name)
        total = gap * gap if total is None else total + gap * gap
    return F.sqrt(total)


def similarity(left: str | Column, right: str | Column) -> Column:
    """1 / (1 + Euclidean distance) of the feature vectors of two aliased rows or structs."""
    return 1.0 / (1.0 + distance(left, right))


def _steps(cells: list[tuple[int, int]]) -> Column:
    return F.array(*[F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j")) for i, j in cells])


def around() -> Column:
    """Steps to the nine cells around and including one, as a constant array."""
    return _steps([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)])


def onward() -> Column:
    """Steps to a cell and to four of its neighbours, so that two neighbours meet in one of them only."""
    return _steps([(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)])


def rounded(value: Column, digits: int) -> Column:
    """``F.round`` of values from 0 to 1, which goes through the decimal text of a number, only next to a half; else the same by
    arithmetic (a whole number below 2**53 over a power of ten is the nearest double of that decimal)."""
    scaled = value * F.lit(10.0**digits)
    left = scaled - F.floor(scaled)
    near = F.floor(scaled + 0.5).cast("double") / F.lit(10.0**digits)
    return F.when(F.abs(left - 0.5) > 1e-6, near).otherwise(F.round(value, digits))


def _classes(vectors: DataFrame, most: int) -> DataFrame:
    """Signals of one second with equal vectors as one row ``signals``, named by its smallest one; at most about ``most`` in a row."""
    same = ["timestamp", *DIMENSIONS]
    sizes = vectors.groupBy(*same).count().filter(F.col("count") > most)
    keys = same
    if not sizes.isEmpty():
        parts = sizes.select(*same, F.ceil(F.col("count") / most).alias("_parts"))
        part = F.pmod(F.xxhash64("signal_id"), F.coalesce("_parts", F.lit(1)))
        vectors, keys = vectors.join(parts, same, "left").withColumn("_part", part), [*same, "_part"]
    classes = vectors.groupBy(*keys).agg(F.min("signal_id").alias("name"), F.collect_list("signal_id").alias("signals"))
    return pin(classes.select(*same, "name", "signals"))


def similar_pairs(
    nodes: DataFrame, threshold: float = SIMILARITY_THRESHOLD, task_rows: int = GRID_TASK_ROWS, digits: int | None = None
) -> DataFrame:
    """All pairs of signals in one second that are more similar than ``threshold``; a signal has one row a second.

    A grid over speed and height turns the theta join into an equi-join: the right side visits its own cell and half of those
    around it, so a pair meets exactly once and candidates stay in proportion to the result.  A signal is compared
    with classes of signals that have the same vector, and a similar class is listed signal by signal, so what a
    listed pair costs is little more than its row; ``digits`` rounds the similarity before that.  Cells with many signals, their
    own or visiting, are split by salt on both sides, so that a signal meets about ``task_rows`` others at a time.  (The fusion
    itself never lists pairs; see ``components``.)
    """
    width = reach(threshold) * (1 + _SLACK)
    classes = _classes(nodes.select("timestamp", "signal_id", *DIMENSIONS).dropna(), max(task_rows // 4, 1))
    cell = ["timestamp", "_tr", "_sp", "_h"]
    gridded = classes.withColumns({
        # whole seconds that differ are already too far apart when the reach is at most one
        "_tr": F.col("time_range") if width <= 1 else F.lit(0),
        "_sp": F.floor(F.col("avg_speed") / width),
        "_h": F.floor(F.col("avg_height") / width),
    })
    visiting = gridded.select("*", F.explode(onward()).alias("_o")).select(
        *classes.columns, ((F.col("_o.i") != 0) | (F.col("_o.j") != 0)).alias("_away"), "_tr", (F.col("_sp") + F.col("_o.i")).alias("_sp"), (F.col("_h") + F.col("_o.j")).alias("_h")
    )
    single = gridded.select("*", F.explode("signals").alias("signal_id")).drop("signals")
    own = gridded.groupBy(*cell).agg(F.sum(F.size("signals")).alias("_own"))
    crowded = visiting.groupBy(*cell).agg(F.sum(F.size("signals")).alias("_met")).filter(F.col("_met") > task_rows).join(own, cell)
    keys = cell
    if not crowded.isEmpty():
        salts = crowded.select(*cell, *(F.ceil(F.col(n) / task_rows).alias(n) for n in ("_own", "_met")))
        own_salts, met_salts = F.coalesce("_own", F.lit(1)), F.coalesce("_met", F.lit(1))
        single = single.join(salts, cell, "left").select(
            "*", F.pmod(F.xxhash64("signal_id"), own_salts).alias("_salt"), F.explode(F.sequence(F.lit(0).cast("bigint"), met_salts - 1)).alias("_turn")
        )
        visiting = visiting.join(salts, cell, "left").select(
            "*", F.explode(F.sequence(F.lit(0).cast("bigint"), own_salts - 1)).alias("_salt"), F.pmod(F.xxhash64("name"), met_salts).alias("_turn")
        )
        keys = [*cell, "_salt", "_turn"]
    # The side that was multiplied must not be broadcast on the strength of its size before that.
    left, right = single.alias("a"), visiting.hint("merge").alias("b")
    met = F.col("b._away") | (F.col("a.name") <= F.col("b.name"))
    for key in keys:
        met = met & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    alike = similarity("a", "b")
    similar = left.join(right, met & (alike > threshold)).select(
        F.col("a.timestamp").alias("timestamp"), F.col("a.signal_id").alias("_one"),
        (F.col("a.name") == F.col("b.name")).alias("_same"), alike.alias("similarity"), "b.signals",
    )
    if digits is not None:
        similar = similar.withColumn("similarity", rounded(F.col("similarity"), digits))
    pairs = similar.select("timestamp", "_one", "_same", "similarity", F.explode("signals").alias("_other"))
    # two classes meet once, whichever signal of theirs is smaller; a class meets itself
    return pairs.filter(~F.col("_same") | (F.col("_one") < F.col("_other"))).select(
        "timestamp", F.least("_one", "_other").alias("left_signal"), F.greatest("_one", "_other").alias("right_signal"), "similarity"
    )
