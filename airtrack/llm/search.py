"""The best documents for each query by summed term impacts, exactly, without an inverted index.

Every document is folded into sketches: a term's place in a sketch is its hash, and a place holds the largest frequency of the
document's terms there.  Looking up all terms of a batch of queries in the sketches of a block of documents bounds every score from
above.  Candidates are scored exactly in descending order of their bounds, until the next bound is below the worst score that a
query already has to beat.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airtrack.lineage import pin
from airtrack.llm.common import in_small_batches, pin_counted, sized, term_table, terms

#: Documents listed per query.
LISTED = 20
#: Sketches of a document and places in each.
SKETCHES, PLACES = 2, 2048
#: Terms of queries that are looked up in one pass over the sketches.
BATCH_TERMS = 16_384
#: Candidates scored per query in the first turn, and how many times more in every further one.
FIRST, GROWTH = 64, 8
#: Terms whose places a task remembers.
REMEMBERED = 500_000

_TERM = term_table(lambda c: 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)


class _Places(dict):
    """A term's places in the sketches."""

    def __missing__(self, term: bytes) -> tuple[int, int]:
        if len(self) > REMEMBERED:
            self.clear()
        spot = zlib.crc32(term)
        self[term] = spot % PLACES, PLACES + spot // PLACES % PLACES
        return self[term]


def _counted(text: bytes | None) -> Counter:
    counts = Counter()
    for words in terms(text or b"", _TERM):
        counts.update(words)
    return counts


def _texts(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    return in_small_batches(docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").cast("binary").alias("text"), *more))


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, places, tops``: number of terms of every row, its filled places in ascending order and the largest frequency in each."""
    def run(batches):
        for batch in batches:
            places_of, sizes, places, tops, ends = _Places(), [], [], [], [0]
            for cell in batch.column(1):
                counts = _counted(cell.as_py())
                n = np.fromiter(counts.values(), np.int64, len(counts))
                at = np.fromiter((p for term in counts for p in places_of[term]), np.int64, 2 * len(counts))
                tallest = np.zeros(SKETCHES * PLACES, np.int64)
                np.maximum.at(tallest, at, np.repeat(n, 2))
                filled = np.flatnonzero(tallest)
                sizes.append(int(n.sum()))
                places.append(filled)
                tops.append(tallest[filled])
                ends.append(ends[-1] + len(filled))
            offsets = pa.array(ends, pa.int32())
            yield pa.record_batch([
                batch.column(0), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(places or [np.zeros(0)]).astype(np.int16))),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tops or [np.zeros(0)]).astype(np.int64))),
            ], schema=layout)

    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("places", T.ArrayType(T.ShortType())), T.StructField("tops", T.ArrayType(T.LongType())),
    ])
    layout = to_arrow_schema(schema)
    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term, repeats`` of every query."""
    def run(batches):
        for batch in batches:
            rows = [(i, term, n) for i, cell in enumerate(batch.column(1)) for term, n in _counted(cell.as_py()).items()]
            owner, words, repeats = (list(x) for x in zip(*rows)) if rows else ([], [], [])
            yield pa.record_batch([
                batch.column(0).take(pa.array(owner, pa.int64())), pa.array(words, pa.binary()), pa.array(repeats, pa.int64())
            ], schema=layout)

    schema = T.StructType([
        T.StructField("item", items.schema[id_col].dataType), T.StructField("term", T.BinaryType()), T.StructField("repeats", T.LongType())
    ])
    layout = to_arrow_schema(schema)
    return _texts(items, id_col, text_col).mapInArrow(run, schema)


def _holders(docs: DataFrame, words: list[bytes], id_col: str, text_col: str) -> dict[bytes, int]:
    """How many rows hold each of ``words``."""
    def run(batches):
        wanted, held = frozenset(words), Counter()
        for batch in batches:
            for cell in batch.column(1):
                own = set()
                for some in terms(cell.as_py() or b"", _TERM):
                    own |= wanted.intersection(some)
                held.update(own)
        yield pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], schema=layout)

    schema = T.StructType([T.StructField("term", T.BinaryType()), T.StructField("df", T.LongType())])
    layout = to_arrow_schema(schema)
    counted = _texts(docs, id_col, text_col).mapInArrow(run, schema).groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in counted.collect()}


class _Batch:
    """Queries that are looked up together: for each its terms' numbers and weights times repeats."""

    def __init__(self, rows: list, weights: dict[bytes, int], kind: T.DataType):
        self.terms = sorted({bytes(r["term"]) for r in rows if weights.get(bytes(r["term"]))})
        at, self.items = {t: k for k, t in enumerate(self.terms)}, {}
        for r in rows:
            if bytes(r["term"]) in at:
                self.items.setdefault(r["item"], []).append((at[bytes(r["term"])], weights[bytes(r["term"])] * r["repeats"]))
        places = _Places()
        self.places = np.array([places[t] for t in self.terms], np.int64).reshape(-1, 2)
        self.weights = [tuple(np.array(x, np.int64) for x in zip(*parts)) for parts in self.items.values()]
        self.items, self.kind = list(self.items), kind
        self.plain = {
            item: [(self.terms[t], int(w)) for t, w in zip(*parts)] for item, parts in zip(self.items, self.weights)
        }


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's share of its weight, in millionths, which grows with its frequency."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def normalised(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Length of a document against the mean, 100 for the mean."""
    return 75 + 25 * n * documents // length


def _bounds(batch: pa.RecordBatch, queries: _Batch, documents: int, length: int) -> np.ndarray:
    """Upper bounds of the scores, one row per query and one column per document of the batch."""
    n = batch.column("n").to_numpy()
    places, tops = (batch.column(x).flatten().to_numpy().astype(np.int64) for x in ("places", "tops"))
    owner = np.repeat(np.arange(len(n)), np.diff(batch.column("places").offsets.to_numpy()))
    sketch = np.zeros((SKETCHES * PLACES, len(n)), np.int32)
    sketch[places, owner] = impact(tops, normalised(n, documents, length)[owner])
    least = np.minimum(sketch[queries.places[:, 0]], sketch[queries.places[:, 1]])
    return np.stack([weight @ least[at].astype(np.int64) for at, weight in queries.weights])


def candidates(sketches: DataFrame, queries: _Batch, documents: int, length: int, beat: dict | None = None, most: int = LISTED) -> DataFrame:
    """``item, id, bound``: per query and batch of documents the ``most`` highest bounds above 0, or all that reach ``beat``."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = _bounds(batch, queries, documents, length)
            for start in range(0, len(found), 64):
                part = found[start: start + 64]
                if beat is None:
                    floor = np.sort(part, axis=1)[:, -min(most, part.shape[1])]
                else:
                    floor = np.array([beat.get(item, 0) for item in queries.items[start: start + 64]], np.int64)
                query, doc = np.nonzero(part >= np.maximum(floor, 1)[:, None])
                yield pa.record_batch([
                    names.take(pa.array(query + start)), batch.column(0).take(pa.array(doc)), pa.array(part[query, doc], pa.int64())
                ], schema=layout)

    kind = sketches.schema["id"].dataType
    schema = T.StructType([T.StructField("item", queries.kind), T.StructField("id", kind), T.StructField("bound", T.LongType())])
    layout = to_arrow_schema(schema)
    names = pa.array(queries.items, layout[0].type)
    return sketches.mapInArrow(run, schema)


def scored(docs: DataFrame, wanted: DataFrame, queries: _Batch, documents: int, length: int, id_col: str, text_col: str) -> DataFrame:
    """``item, id, score`` above 0 of the pairs ``item, id`` in ``wanted``, from the whole texts."""
    def run(batches):
        for batch in batches:
            owner, query, score = [], [], []
            for i, (cell, items) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
                counts = _counted(cell.as_py())
                m = normalised(counts.total(), documents, length)
                for item in items:
                    value = sum(w * impact(counts[term], m) for term, w in queries.plain[item] if term in counts)
                    if value:
                        owner.append(i)
                        query.append(item)
                        score.append(value)
            yield pa.record_batch([
                pa.array(query, layout[0].type), batch.column(0).take(pa.array(owner, pa.int64())), pa.array(score, pa.int64())
            ], schema=layout)

    by_doc = sized(wanted.groupBy(F.col("id").alias("_id")).agg(F.collect_set("item").alias("_items")))
    schema = T.StructType([T.StructField("item", queries.kind), T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    layout = to_arrow_schema(schema)
    joined = docs.select(docs[id_col].alias("_doc"), docs[text_col].alias("_text")).join(by_doc, F.col("_doc") == F.col("_id"))
    return _texts(joined, "_doc", "_text", "_items").mapInArrow(run, schema)


def _first(rows: DataFrame, by: str, most: int) -> DataFrame:
    place = F.expr(f"row_number() over (partition by item order by {by} desc, id)")
    return rows.withColumn("rank", place).filter(F.col("rank") <= most)


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", listed: int = LISTED,
) -> DataFrame:
    """``item, rank, id, score``: the ``listed`` rows of ``docs`` with the highest scores above 0 for every query.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case; a null text has none.  A term weighs
    ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` where ``df`` of the ``N`` rows with terms hold it; every occurrence in a query
    counts.  Equal scores rank by the smaller id.  All but the logarithm is whole numbers.

    Repeated rows are documents of their own, and rows that share an id are listed side by side.  Rows with a null id count in
    ``N``, ``df`` and the mean length but are not listed; queries with a null id are left out, and queries that share an id are one.
    Queries without terms, or none of whose terms occurs, have no rows; empty tables give an empty result; other columns are ignored.
    """
    spark, kind = docs.sparkSession, items.schema[item_col].dataType
    sketches = pin(index(docs, id_col, text_col))
    documents, length = sketches.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    wanted = query_terms(items.filter(items[item_col].isNotNull()), item_col, item_text_col)
    wanted = pin(wanted.groupBy("item", "term").agg(F.sum("repeats").alias("repeats")))
    dealt = wanted.withColumn("batch", F.pmod(F.xxhash64("item"), F.lit(wanted.count() // BATCH_TERMS + 1)))
    known = sketches.filter("id is not null and n > 0")
    schema = T.StructType([
        T.StructField("item", kind), T.StructField("rank", T.IntegerType()), T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("score", T.LongType()),
    ])
    result = spark.createDataFrame([], schema)
    for (batch,) in sorted(dealt.select("batch").distinct().collect()) if length else []:
        rows = dealt.filter(F.col("batch") == batch).select("item", "term", "repeats").collect()
        df = _holders(docs, sorted({bytes(r["term"]) for r in rows}), id_col, text_col)
        weights = {t: int(np.floor(1000 * np.log((2 * documents + 2) / (2 * n + 1)))) for t, n in df.items()}
        queries = _Batch(rows, weights, kind)
        if queries.items:
            found = _best(docs, known, queries, documents, length, id_col, text_col, listed)
            result = result.unionByName(found.select("item", F.col("rank").cast("int"), "id", "score"))
    return result


def _best(docs, known, queries, documents, length, id_col, text_col, listed) -> DataFrame:
    """Turns of exact scores in descending order of bounds, until no bound is left that reaches a query's worst listed score."""
    def score(pairs):
        return scored(docs, pairs.select("item", "id"), queries, documents, length, id_col, text_col)

    def worst(scores):
        last = _first(scores, "score", listed).filter(F.col("rank") == listed)
        return {r["item"]: r["score"] for r in last.select("item", "score").collect()}

    highest = candidates(known, queries, documents, length, most=listed).distinct()
    scores = pin(score(_first(highest, "bound", FIRST)))
    beat, most = worst(scores), FIRST
    left, n = pin_counted(candidates(known, queries, documents, length, beat).groupBy("item", "id").agg(F.max("bound").alias("bound")))
    spark, scores = docs.sparkSession, None
    while n:
        most *= GROWTH
        turn = pin(_first(left, "bound", most))
        found = score(turn)
        scores = pin(found if scores is None else scores.unionByName(found))
        beat = worst(scores)
        limits = spark.createDataFrame(list(beat.items()), T.StructType([T.StructField("item", queries.kind), T.StructField("beat", T.LongType())]))
        rest = left.join(F.broadcast(limits), "item", "left").filter("beat is null or bound >= beat").drop("beat")
        left, n = pin_counted(rest.join(turn.select("item", "id"), ["item", "id"], "left_anti"))
    if scores is None:
        return _first(score(highest.limit(0)), "score", listed)
    return pin(_first(scores, "score", listed))
