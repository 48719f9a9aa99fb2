"""Token sequences of fixed capacity by harmonic packing.

Lengths fall into reciprocal-capacity classes: a bin of class ``k`` takes exactly ``k`` pieces of ``capacity // k`` tokens.
Documents may be cut, so each is cut into pieces of exactly such lengths, the largest first: almost nothing is left over in a
full bin.  Every task numbers its own pieces of each class; the counts of tasks, one row per task and class, give each task the
place where its numbers begin, so all bins but the last one of a class are full, no token is shuffled, and no task waits for
another.  Pieces of the last bins, fewer than ``k`` per class whatever the input, are laid side by side in common sequences.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airtrack.lineage import pin
from airtrack.llm.common import in_small_batches, sized

CAPACITY = 4096
#: Token that ends every document.
END = 2
#: A cut leaves no piece of fewer tokens, unless full sequences leave fewer of the document.
LEAST = 16
#: Words whose tokens a task remembers, and the longest of them.
REMEMBERED, WORD_CHARS = 600_000, 64
#: Bytes of tokens after which a task hands its pieces on.
BATCH_BYTES = 16_000_000


@lru_cache(maxsize=4)
def reciprocal_sizes(capacity: int) -> tuple[int, ...]:
    """All ``capacity // k``, largest first: about two square roots of the capacity."""
    return tuple(sorted({capacity // k for k in range(1, capacity + 1)}, reverse=True))


def cut(length: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of the pieces of a document of ``length`` tokens."""
    out, sizes = [capacity] * (length // capacity), reciprocal_sizes(capacity)
    rest = length % capacity
    while rest:
        size = next((s for s in sizes if s == rest or s <= rest - least), 1)
        out.append(size)
        rest -= size
    return out


class _Words(dict):
    """Words to their tokens, as little-endian unsigned 32-bit numbers.

    White space is never part of a token here, so the tokens of a text are those of its words one after another, and a task looks a
    word up once.  Where the tokenizer takes runs of lower-cased letters and of signs apart and merges bytes, as the one of 49 thousand
    entries does, Latin letters before signs go to its merges directly.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer, self.letters = Tokenizer.from_file(path), {}
        self.merges = self.tokenizer.model.tokenize
        spec = json.loads(self.tokenizer.to_str())
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        pattern = splits[0].get("pattern", {}).get("Regex", "")
        self.direct = (
            kinds == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in splits] == ["Split", "ByteLevel"]
            and "|[\\p{L}]+|" in pattern and pattern.endswith("|[^\\s\\p{L}\\p{N}]+") and spec["model"]["type"] == "BPE"
        )

    def _merged(self, letters: str) -> bytes:
        letters = letters.lower()
        found = self.letters.get(letters)
        if found is None:
            units = letters if letters.isascii() else "".join(map(_byte_characters().__getitem__, letters.encode()))
            found = self.letters[letters] = _packed([t.id for t in self.merges(units)])
        return found

    def __missing__(self, word: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
            self.letters.clear()
        if self.direct and word.isascii() and word.isalpha():
            found = self._merged(word)
        elif self.direct and (parts := _LETTERS_AND_SIGNS.fullmatch(word)):
            found = self._merged(parts[1]) + (self[parts[2]] if parts[2] else b"")
        else:
            found = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= WORD_CHARS:
            self[word] = found
        return found

    def tokens(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


#: Latin letters whose lower case is one letter, and signs that begin no special token and no contraction.
_LETTERS_AND_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=>?@\[-`{-~]*)")


@lru_cache(maxsize=1)
def _byte_characters() -> list[str]:
    """The character that stands for a byte: itself if it is printable, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + others.index(b)) for b in range(256)]


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end: int = END, least: int = LEAST,
) -> DataFrame:
    """``id, start, length, ids, doc_tokens, part, number``: the pieces of every document.

    ``tokenizer`` is the path of a vocabulary file in which white space only separates tokens.  ``ids`` holds the tokens as
    little-endian unsigned 32-bit numbers, ``number`` counts the pieces of that length in the task ``part`` from 0.
    """
    kind = T.StructField("id", docs.schema[id_col].dataType)
    schema = T.StructType([
        kind, T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("part", T.LongType()), T.StructField("number", T.LongType()),
    ])
    layout, last = to_arrow_schema(schema), _packed([end])

    def run(batches):
        words, part, numbers = _Words(tokenizer), TaskContext.get().partitionId(), {}
        cuts = [cut(n, capacity, least) for n in range(capacity)]
        for batch in batches:
            owner, columns, held = [], [[] for _ in range(5)], 0

            def made():
                return pa.record_batch([
                    batch.column(0).take(pa.array(owner, pa.int64())), *map(pa.array, columns[:2], (pa.int64(),) * 2),
                    pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int64()),
                    pa.array(np.full(len(owner), part), pa.int64()), pa.array(columns[4], pa.int64()),
                ], schema=layout)

            for i, text in enumerate(batch.column(1)):
                ids, start = words.tokens(text.as_py() or "") + last, 0
                total = len(ids) // 4
                for size in [capacity] * (total // capacity) + cuts[total % capacity]:
                    number = numbers.get(size, 0)
                    numbers[size] = number + 1
                    owner.append(i)
                    for column, value in zip(columns, (start, size, ids[4 * start: 4 * (start + size)], total, number)):
                        column.append(value)
                    start += size
                    held += 4 * size
                    if held > BATCH_BYTES:
                        yield made()
                        owner, columns, held = [], [[] for _ in range(5)], 0
            yield made()

    rows = in_small_batches(docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")))
    return rows.mapInArrow(run, schema)


def last_bins(left: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first, count, bin, offset)`` of the pieces that fill no bin of their class, longest into the first fit."""
    free, runs = [], []
    for length in sorted(left, reverse=True):
        first = 0
        while first < left[length]:
            place = next((i for i, room in enumerate(free) if room >= length), len(free))
            if place == len(free):
                free.append(capacity)
            count = min(left[length] - first, free[place] // length)
            runs.append((length, first, count, place, capacity - free[place]))
            free[place] -= count * length
            first += count
    return runs


def assigned(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (:func:`pieces`, more columns allowed) with ``sequence_id`` and ``offset`` instead of ``part`` and ``number``.

    What comes to the driver is one number per class, at most two square roots of the capacity.
    """
    spark, found = found.sparkSession, pin(found)
    counts = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.expr("coalesce(sum(n) over (partition by length order by part rows between unbounded preceding and 1 preceding), 0)")
    bases = pin(counts.withColumn("before", before))
    totals = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    classes, base = [], 0
    for length in sorted(totals, reverse=True):
        size = capacity // length
        classes.append((length, size, totals[length] // size, base))
        base += totals[length] // size
    runs = last_bins({length: totals[length] - full * size for length, size, full, _ in classes}, capacity)
    runs = spark.createDataFrame(runs, "length long, first long, count long, bin long, at long")
    classes = spark.createDataFrame(classes, "length long, size long, full long, base long")
    placed = found.join(sized(bases.select("length", "part", "before")), ["length", "part"]).join(F.broadcast(classes), "length")
    position = F.col("before") + F.col("number")
    placed = placed.withColumn("_bin", F.expr("(before + number) div size")).withColumn("_in", F.pmod(position, F.col("size")))
    kept = [c for c in found.columns if c not in ("part", "number")]
    full = placed.filter("_bin < full").select(
        *kept, (F.col("base") + F.col("_bin")).alias("sequence_id"), (F.col("_in") * F.col("length")).alias("offset")
    )
    rest = placed.filter("_bin >= full").join(F.broadcast(runs), "length").filter("_in >= first and _in < first + count").select(
        *kept, (F.lit(base) + F.col("bin")).cast("long").alias("sequence_id"),
        (F.col("at") + (F.col("_in") - F.col("first")) * F.col("length")).alias("offset"),
    )
    return full.unionByName(rest)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end: int = END, least: int = LEAST,
) -> DataFrame:
    """``length, id, start, ids, doc_tokens, sequence_id, offset``: every piece with its tokens and its place in a sequence.

    Every document, with a null or empty text too, ends with ``end`` and is cut into pieces; sequences are numbered from 0 and hold
    pieces without gaps from offset 0, ``capacity`` tokens at most.  Repeated rows and rows that share an id, or have a null one, are
    packed row by row.  An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    return assigned(pieces(docs, tokenizer, id_col, text_col, capacity, end, least), capacity)
