"""Clusters of similar signals: connected components of the similarity graph of every second.

The graph is never listed pair by pair.  Distinct feature vectors fall into grid cells so small that all members
of a cell are similar to each other; only cells are compared.  Two cells are linked, or ruled out, by the bounding
boxes of their members, or linked by the outermost members of both; the few undecided pairs of cells are compared on a
finer grid, and what is still undecided there on the vectors themselves.  The result equals that of comparing all pairs.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrack.lineage import pin, pin_and_test
from airtrack.operators.similarity import DIMENSIONS, around, reach, similarity
from airtrack.settings import GRID_TASK_ROWS, SIMILARITY_THRESHOLD, SMALL_GRAPH_LINKS

_MARGIN = 1e-9  # box distances this close to the reach are left to the exact comparison
_FINER = 8
_PAIR = ["timestamp", "left_cell", "right_cell"]


def _cell(side: float) -> Column:
    return F.concat_ws(":", *[F.floor(F.col(name) / side).cast("string") for name in DIMENSIONS])


def _cell_side(threshold: float) -> float:
    return reach(threshold) / math.sqrt(len(DIMENSIONS)) * (1 - 1e-6)


def _box() -> list[Column]:
    out = []
    for name in DIMENSIONS:
        out += [F.min(name).alias(f"lo_{name}"), F.max(name).alias(f"hi_{name}")]
    return out


def _outermost() -> Column:
    """The members of a cell that touch its bounding box."""
    vector = F.struct(*DIMENSIONS)
    ends = [end(vector, F.struct(name, vector)) for name in DIMENSIONS for end in (F.min_by, F.max_by)]
    return F.array_distinct(F.array(*ends)).alias("outermost")


def _box_distances(left: str, right: str) -> tuple[Column, Column]:
    """Smallest and largest distance two members of the boxes can have."""
    near, far = F.lit(0.0), F.lit(0.0)
    for name in DIMENSIONS:
        a_lo, a_hi = F.col(f"{left}.lo_{name}"), F.col(f"{left}.hi_{name}")
        b_lo, b_hi = F.col(f"{right}.lo_{name}"), F.col(f"{right}.hi_{name}")
        gap = F.greatest(F.lit(0.0), b_lo - a_hi, a_lo - b_hi)
        span = F.greatest(b_hi - a_lo, a_hi - b_lo)
        near, far = near + gap * gap, far + span * span
    return F.sqrt(near), F.sqrt(far)


def _neighbour_cells(cells: DataFrame, threshold: float) -> DataFrame:
    """Pairs of cells that may hold similar signals, with ``sure`` set where they certainly do."""
    width, side = reach(threshold), _cell_side(threshold)
    steps = math.ceil(width / side)  # similar signals are at most this many cells apart
    coarse = cells.drop("outermost").withColumns({
        "_tr": F.col("lo_time_range") if width <= 1 else F.lit(0),
        "_sp": F.floor(F.floor(F.col("lo_avg_speed") / side) / steps),
        "_h": F.floor(F.floor(F.col("lo_avg_height") / side) / steps),
    })
    visiting = coarse.withColumn("_o", F.explode(around())).withColumns({
        "_sp": F.col("_sp") + F.col("_o.i"),
        "_h": F.col("_h") + F.col("_o.j"),
    })
    # The side that was multiplied must not be broadcast on the strength of its size before that.
    left, right = coarse.alias("a"), visiting.hint("merge").alias("b")
    met = F.col("a.cell") < F.col("b.cell")
    for key in ("timestamp", "_tr", "_sp", "_h"):
        met = met & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    near, far = _box_distances("a", "b")
    return (
        left.join(right, met)
        .select(
            F.col("a.timestamp").alias("timestamp"),
            F.col("a.cell").alias("left_cell"),
            F.col("b.cell").alias("right_cell"),
            (F.col("a.vectors") * F.col("b.vectors")).alias("comparisons"),
            near.alias("_near"),
            far.alias("_far"),
        )
        .filter(F.col("_near") < width * (1 + _MARGIN))
        .select(*_PAIR, "comparisons", (F.col("_far") < width * (1 - _MARGIN)).alias("sure"))
    )


def _touching(cells: DataFrame, neighbours: DataFrame, threshold: float) -> DataFrame:
    """``neighbours`` with ``sure`` set also where two outermost members are similar.

    Cells that box distances leave open mostly are linked, and a few of their members show it; what is left to the comparison of all
    members is the rim of a cluster, not its inside.
    """
    a = cells.select("timestamp", F.col("cell").alias("left_cell"), F.col("outermost").alias("_a"))
    b = cells.select("timestamp", F.col("cell").alias("right_cell"), F.col("outermost").alias("_b"))
    similar = F.exists("_a", lambda x: F.exists("_b", lambda y: similarity(x, y) > threshold))
    opened = neighbours.filter(~F.col("sure")).join(a, ["timestamp", "left_cell"]).join(b, ["timestamp", "right_cell"])
    return neighbours.filter("sure").unionByName(opened.select(*_PAIR, "comparisons", similar.alias("sure")))


def _compared_links(vectors: DataFrame, undecided: DataFrame, threshold: float) -> DataFrame:
    """The undecided pairs that hold a similar pair of signals, by comparing their vectors (few per pair)."""
    a = vectors.select("timestamp", F.col("cell").alias("left_cell"), F.struct(*DIMENSIONS).alias("a"))
    b = vectors.select("timestamp", F.col("cell").alias("right_cell"), F.struct(*DIMENSIONS).alias("b"))
    return (
        undecided.select(*_PAIR)
        .join(a, ["timestamp", "left_cell"])
        .join(b, ["timestamp", "right_cell"])
        .filter(similarity("a", "b") > threshold)
        .select(*_PAIR)
        .distinct()
    )


def _refined_links(vectors: DataFrame, undecided: DataFrame, threshold: float) -> DataFrame:
    """As :func:`_compared_links` for pairs of crowded cells: boxes of a finer grid decide, and vectors are
    compared only across pairs of fine cells that lie right at the reach, with the left side salted."""
    width, pair = reach(threshold), _PAIR
    wanted = undecided.select("timestamp", F.explode(F.array("left_cell", "right_cell")).alias("cell")).distinct()
    members = vectors.join(wanted, ["timestamp", "cell"], "left_semi").withColumn(
        "sub", _cell(_cell_side(threshold) / _FINER)
    )
    subs = members.groupBy("timestamp", "cell", "sub").agg(F.count(F.lit(1)).alias("vectors"), *_box())
    left = subs.withColumnRenamed("cell", "left_cell").alias("a")
    right = subs.withColumnRenamed("cell", "right_cell").alias("b")
    near, far = _box_distances("a", "b")
    compared = (
        undecided.join(left, ["timestamp", "left_cell"])
        .join(right, ["timestamp", "right_cell"])
        .select(
            *pair,
            F.col("a.sub").alias("left_sub"),
            F.col("b.sub").alias("right_sub"),
            F.ceil(F.col("a.vectors") / GRID_TASK_ROWS).alias("_salts"),
            near.alias("_near"),
            far.alias("_far"),
        )
        .filter(F.col("_near") < width * (1 + _MARGIN))
        .withColumn("sure", F.col("_far") < width * (1 - _MARGIN))
    )
    compared = pin(compared)
    found = compared.filter("sure").select(*pair).distinct()
    rest = compared.filter(~F.col("sure")).join(found, pair, "left_anti")
    salted = members.withColumn("_hash", F.xxhash64(*DIMENSIONS))
    a = salted.select("timestamp", F.col("cell").alias("left_cell"), F.col("sub").alias("left_sub"), "_hash", F.struct(*DIMENSIONS).alias("a"))
    b = members.select("timestamp", F.col("cell").alias("right_cell"), F.col("sub").alias("right_sub"), F.struct(*DIMENSIONS).alias("b"))
    exact = (
        rest.join(a, ["timestamp", "left_cell", "left_sub"])
        .withColumn("_salt", F.pmod("_hash", "_salts"))
        .join(
            rest.join(b, ["timestamp", "right_cell", "right_sub"])
            .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1)))
            .select(*pair, "left_sub", "right_sub", "_salt", "b"),
            [*pair, "left_sub", "right_sub", "_salt"],
        )
        .filter(similarity("a", "b") > threshold)
        .select(*pair)
        .distinct()
    )
    return found.unionByName(exact)


def connected(links: DataFrame, small: int = SMALL_GRAPH_LINKS) -> DataFrame:
    """Label ``(timestamp, cell, label)`` of every linked cell: the smallest cell it is connected to.

    A second with few links is solved by one task; seconds beyond that size go through an iteration whose every
    step is spread over (second, cell).
    """
    links = links.select("timestamp", "left_cell", "right_cell")
    sizes = links.groupBy("timestamp").count()
    large = sizes.filter(F.col("count") > small).select("timestamp")
    if large.isEmpty():
        return _label_small(links)
    few = links.join(large, "timestamp", "left_anti")
    return _label_small(few).unionByName(_label_large(links.join(large, "timestamp", "left_semi")))


def _label_small(links: DataFrame) -> DataFrame:
    def union_find(second: pd.DataFrame) -> pd.DataFrame:
        parent: dict[str, str] = {}

        def root(cell: str) -> str:
            top = cell
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[cell] != top:
                parent[cell], cell = top, parent[cell]
            return top

        for a, b in zip(second["left_cell"], second["right_cell"]):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        cells = list(parent)
        return pd.DataFrame({
            "timestamp": second["timestamp"].iloc[0],
            "cell": cells,
            "label": [root(cell) for cell in cells],
        })

    return links.groupBy("timestamp").applyInPandas(union_find, "timestamp bigint, cell string, label string")


def _label_large(links: DataFrame) -> DataFrame:
    """Neighbours' smallest label, then two jumps along labels, until nothing changes."""
    both = links.unionByName(
        links.select("timestamp", F.col("right_cell").alias("left_cell"), F.col("left_cell").alias("right_cell"))
    ).distinct()
    both = pin(both)
    labels = pin(
        both.groupBy("timestamp", F.col("left_cell").alias("cell")).agg(
            F.least(F.min("right_cell"), F.col("left_cell")).alias("label")
        )
    )
    while True:
        around = (
            both.join(labels.select("timestamp", F.col("cell").alias("right_cell"), "label"), ["timestamp", "right_cell"])
            .groupBy("timestamp", F.col("left_cell").alias("cell"))
            .agg(F.min("label").alias("_near"))
        )
        lowered = labels.join(around, ["timestamp", "cell"]).select(
            "timestamp", "cell", F.col("label").alias("_old"), F.least("label", "_near").alias("label")
        )
        # The representative of a label learns what its followers have seen.
        heard = lowered.groupBy("timestamp", F.col("_old").alias("cell")).agg(F.min("label").alias("_heard"))
        hooked = (
            lowered.join(heard, ["timestamp", "cell"], "left")
            .select("timestamp", "cell", "_old", F.least("label", F.coalesce("_heard", "label")).alias("label"))
        )
        jump = hooked.select("timestamp", F.col("cell").alias("label"), F.col("label").alias("_next"))
        stepped, lowered = pin_and_test(
            hooked.join(jump, ["timestamp", "label"])
            .select("timestamp", "cell", "_old", F.least("label", "_next").alias("label")),
            F.col("label") != F.col("_old"),
        )
        labels = stepped.select("timestamp", "cell", "label")
        if not lowered:
            return labels


def clustered(
    nodes: DataFrame,
    threshold: float = SIMILARITY_THRESHOLD,
    small: int = SMALL_GRAPH_LINKS,
    comparisons: int = GRID_TASK_ROWS**2,
) -> DataFrame:
    """Add ``cluster``: the smallest ``signal_id`` of the signals connected to a node in its second."""
    placed = nodes.withColumn("cell", _cell(_cell_side(threshold)))
    vectors = pin(placed.groupBy("timestamp", "cell", *DIMENSIONS).agg(F.min("signal_id").alias("first")))
    cells = pin(
        vectors.groupBy("timestamp", "cell").agg(
            F.count(F.lit(1)).alias("vectors"), F.min("first").alias("first"), _outermost(), *_box()
        )
    )
    vectors = vectors.drop("first")
    neighbours, any_crowded = pin_and_test(
        _touching(cells, pin(_neighbour_cells(cells, threshold)), threshold), ~F.col("sure") & (F.col("comparisons") > comparisons)
    )
    undecided = neighbours.filter(~F.col("sure"))
    links = neighbours.filter("sure").select(*_PAIR).unionByName(
        _compared_links(vectors, undecided.filter(F.col("comparisons") <= comparisons), threshold)
    )
    if any_crowded:
        crowded = undecided.filter(F.col("comparisons") > comparisons)
        links = links.unionByName(_refined_links(vectors, crowded, threshold))
    labels = connected(pin(links), small)
    labelled = (
        cells.select("timestamp", "cell", "first")
        .join(labels, ["timestamp", "cell"], "left")
        .withColumn("label", F.coalesce("label", "cell"))
    )
    names = labelled.groupBy("timestamp", "label").agg(F.min("first").alias("cluster"))
    by_cell = labelled.select("timestamp", "cell", "label").join(names, ["timestamp", "label"]).drop("label")
    return placed.join(by_cell, ["timestamp", "cell"]).drop("cell")
