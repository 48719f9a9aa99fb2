"""Repeated blocks of lines, removed from later documents by pairwise alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airtrack.lineage import pin
from airtrack.llm.common import in_small_batches, sized

#: A common block is removed if its lines have so many characters in all.
MIN_BLOCK_CHARS = 40
#: Lines of so many characters at least lead to partners; shorter ones are only aligned.
MIN_ANCHOR_CHARS = 20

#: Odd factors of two rolling hashes modulo 2 ** 64.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of equal lines: lines that are unique in both sides, in the longest common order, then recursively
    between them, each extended to its equal neighbours."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        common = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place]
        if not common:
            continue
        tops: list[int] = []
        last: list[int] = []
        before: list[int] = []
        for k, (_, j) in enumerate(common):
            at = bisect_left(tops, j)
            before.append(last[at - 1] if at else -1)
            tops[at : at + 1] = [j]
            last[at : at + 1] = [k]
        k, anchors = last[-1], []
        while k >= 0:
            anchors.append(common[k])
            k = before[k]
        p, q = a0, b0
        for i, j in reversed(anchors):
            todo.append((p, i, q, j))
            out.append((i, j))
            p, q = i + 1, j + 1
        todo.append((p, a1, q, b1))
    return sorted(out)


def common_lines(a: list[int], b: list[int], sizes: list[int], least: int) -> list[int]:
    """Places in ``b`` of the aligned blocks that have ``least`` characters or more."""
    return [j for first, last in common_blocks(a, b, sizes, least) for j in range(first, last)]


def common_blocks(a: list[int], b: list[int], sizes: list[int], least: int) -> list[tuple[int, int]]:
    """First and last places (the last one exclusive) in ``b`` of those blocks."""
    out: list[tuple[int, int]] = []
    block: list[tuple[int, int]] = []
    for pair in [*patience(a, b), (-9, -9)]:
        if block and (pair[0] != block[-1][0] + 1 or pair[1] != block[-1][1] + 1):
            if sum(sizes[j] for _, j in block) >= least:
                out.append((block[0][1], block[-1][1] + 1))
            block = []
        block.append(pair)
    return out


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _sequences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, hashes, sizes`` of the lines of every document with an id; of rows that share it the one with the least lines counts."""
    lines = _lines(F.col("text"))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter("id is not null")
    return rows.select("id", F.transform(lines, lambda x: F.xxhash64(x)).alias("hashes"), F.transform(lines, F.length).alias("sizes")).groupBy(
        "id"
    ).agg(F.min(F.struct("hashes", "sizes")).alias("s")).select("id", "s.*")


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_block_chars: int = MIN_BLOCK_CHARS,
    min_anchor_chars: int = MIN_ANCHOR_CHARS,
) -> DataFrame:
    """``id, removed``: places (from 0) of the lines that a document repeats from an earlier one, for documents with any.

    The earlier of two documents is the one with the smaller id.  A line shared by several documents joins each of them to the
    first that holds it, so that pairs grow with shared lines and not with their square.  Rare lines lead to partners of their
    own; a frequent line leads all its documents to the same one, whose lines are then dealt over tasks with the pairs.  Each
    pair is aligned by patience diff over line hashes; aligned blocks of consecutive lines are repeated if they have
    ``min_block_chars`` characters.

    A null text is empty; empty lines never join documents.  Rows with a null id are left alone, of rows that repeat an id the
    one with the smallest text counts.  An empty table gives an empty result; other columns are ignored.
    """
    found = aligned_blocks(pin(_sequences(docs, id_col, text_col)), min_block_chars, min_anchor_chars)
    place = F.explode(F.sequence("block.start", F.col("block.stop") - 1))
    return found.select("id", F.explode("blocks").alias("block")).select("id", place.alias("place")).distinct().groupBy("id").agg(
        F.sort_array(F.collect_list("place")).alias("removed")
    )


def aligned_blocks(sequences: DataFrame, min_block_chars: int, min_anchor_chars: int) -> DataFrame:
    """``id, blocks``: stretches of lines (``start``, ``stop``) that the alignment with an earlier document finds."""
    held = sequences.select("id", F.explode(F.array_distinct(F.transform(
        F.filter(F.arrays_zip("hashes", "sizes"), lambda x: x["sizes"] >= min_anchor_chars), lambda x: x["hashes"]
    ))).alias("line"))
    shared = held.groupBy("line").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last")
    pairs = pin(
        held.join(sized(shared), "line").filter("id <> first").select("first", "id").distinct()
    )
    earlier = sequences.select(F.col("id").alias("first"), F.col("hashes").alias("before"))
    aligned = pairs.join(sequences, "id").join(earlier, "first").select("id", "hashes", "sizes", "before")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, blocks = [], []
            for i, hashes, sizes, before in zip(*(c.to_pylist() for c in batch.columns)):
                if found := common_blocks(before, hashes, sizes, min_block_chars):
                    ids.append(i)
                    blocks.append([{"start": a, "stop": b} for a, b in found])
            yield pa.record_batch([pa.array(ids, batch.column(0).type), pa.array(blocks, layout[1].type)], schema=layout)

    block = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
    schema = T.StructType([sequences.schema["id"], T.StructField("blocks", T.ArrayType(block))])
    layout = to_arrow_schema(schema)
    found = in_small_batches(aligned).mapInArrow(align, schema)
    return found.select("id", F.explode("blocks").alias("block")).groupBy("id").agg(F.collect_set("block").alias("blocks"))


def runs(hashes: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """``start, stop`` and two hashes of the shortest runs of lines that have ``least`` characters: from every line on, and up
    to every line.  Together those inside a block of ``least`` characters or more cover all its lines."""
    n = len(hashes)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    stops = np.searchsorted(total, total[:-1] + least)
    starts = np.searchsorted(total, total[1:] - least, side="right") - 1
    places = np.arange(n)
    codes = np.unique(np.concatenate([(places * (n + 1) + stops)[stops <= n], (starts * (n + 1) + places + 1)[starts >= 0]]))
    start, stop = codes // (n + 1), codes % (n + 1)
    sums = []
    for factor in _FACTORS:
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, factor, np.uint64)]))
        back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, pow(factor, -1, 2**64), np.uint64)]))
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * powers[:-1])])
        sums.append(((upto[stop] - upto[start]) * back[start]).view(np.int64))
    return start, stop, *sums


def repeated_blocks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_block_chars: int = MIN_BLOCK_CHARS,
    min_anchor_chars: int = MIN_ANCHOR_CHARS,
) -> DataFrame:
    """``id, removed``: places (from 0) of the lines that lie in a block of consecutive lines with ``min_block_chars`` characters
    which any document with a smaller id holds, too.

    Documents are aligned as in :func:`repeated_lines` first.  What that leaves is searched exactly: the shortest long enough runs
    of lines outside of aligned blocks meet the smallest id that holds them, two runs per line at most.  (A run inside of an aligned
    block is held by the earlier document, so it is nobody's first holder.)  The result is that of comparing all pairs, wherever the
    block is, in whatever order and how often, and however short its lines are.  Null texts, null and repeated ids are treated as in
    :func:`repeated_lines`.
    """
    whole = pin(_sequences(docs, id_col, text_col))
    aligned = pin(aligned_blocks(whole, min_block_chars, min_anchor_chars))
    side = sized(aligned.toDF("_id", "blocks"))
    sequences = whole.join(side, F.col("id") == F.col("_id"), "left").select("id", "hashes", "sizes", "blocks")
    kind = docs.schema[id_col].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = (c.values.to_numpy(zero_copy_only=False) for c in batch.columns[1:3])
            ends = batch.column(1).offsets.to_numpy()
            ends_sizes = batch.column(2).offsets.to_numpy()
            owners, parts = [], []
            for i in range(len(batch)):
                found = runs(hashes[ends[i] : ends[i + 1]], sizes[ends_sizes[i] : ends_sizes[i + 1]], min_block_chars)
                for block in batch.column(3)[i].as_py() or ():
                    left = (found[0] < block["start"]) | (found[1] > block["stop"])
                    found = tuple(c[left] for c in found)
                owners.append(np.full(len(found[0]), i))
                parts.append(found)
            owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
            yield pa.record_batch(
                [batch.column(0).take(pa.array(owner)), pa.array(columns[0].astype(np.int32)), pa.array(columns[1].astype(np.int32)),
                 pa.array(columns[2]), pa.array(columns[3])], names=["id", "start", "stop", "h1", "h2"],
            )

    def schema(*more: T.StructField) -> T.StructType:
        return T.StructType([T.StructField("id", kind), *more])

    places = [T.StructField(c, T.IntegerType()) for c in ("start", "stop")]
    hashed = in_small_batches(sequences).mapInArrow(cut, schema(*places, *(T.StructField(c, T.LongType()) for c in ("h1", "h2"))))
    held = pin(hashed.select("id", "start", "stop", F.xxhash64("h1", "h2", F.col("stop") - F.col("start")).alias("run")))
    shared = held.groupBy("run").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last")
    met = held.join(sized(shared), "run").filter("id <> first").groupBy("id").agg(
        F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")
    )

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = []
            for starts, stops in zip(batch.column(1), batch.column(2)):
                starts, stops = starts.values.to_numpy(), stops.values.to_numpy()
                depth = np.bincount(starts, minlength=stops.max() + 1) - np.bincount(stops, minlength=stops.max() + 1)
                removed.append(np.flatnonzero(np.cumsum(depth)).astype(np.int32))
            yield pa.record_batch([batch.column(0), pa.array(removed, pa.list_(pa.int32()))], names=["id", "removed"])

    places = aligned.select("id", F.flatten(F.transform("blocks", lambda b: F.sequence(b["start"], b["stop"] - 1))).alias("removed"))
    rest = in_small_batches(met).mapInArrow(cover, schema(T.StructField("removed", T.ArrayType(T.IntegerType()))))
    return places.unionByName(rest).groupBy("id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("removed")))).alias("removed"))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_block_chars: int = MIN_BLOCK_CHARS
) -> DataFrame:
    """``docs`` without the lines of :func:`repeated_blocks`; all rows and other columns as they are."""
    return _cut_out(docs, repeated_blocks(docs, id_col, text_col, min_block_chars), id_col, text_col)


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_block_chars: int = MIN_BLOCK_CHARS,
    min_anchor_chars: int = MIN_ANCHOR_CHARS,
) -> DataFrame:
    """``docs`` with repeated blocks deleted from the text of later documents; all rows and other columns as they are."""
    return _cut_out(docs, repeated_lines(docs, id_col, text_col, min_block_chars, min_anchor_chars), id_col, text_col)


def _cut_out(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    side = sized(found.toDF("_id", "_removed"))
    left = F.filter(_lines(docs[text_col]), lambda x, i: ~F.array_contains(side["_removed"], i))
    text = F.when(side["_removed"].isNull(), docs[text_col]).otherwise(F.array_join(left, "\n"))
    joined = docs.join(side, docs[id_col] == side["_id"], "left")
    return joined.select(*(text.alias(c) if c == text_col else docs[c] for c in docs.columns))
