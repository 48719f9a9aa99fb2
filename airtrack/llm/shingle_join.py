"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold, exactly.

The global order of n-grams is the order of their 64-bit hashes.  It is cut into fragments (vertical partitions), and
documents are compared fragment by fragment: similar sets differ in few n-grams, so that among enough fragments at least one
holds the same n-grams in both.  Equal fragments therefore find every similar pair, and hardly any other; the pairs are then
decided by counting the overlap of each fragment separately and summing per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtrack.lineage import pin
from airtrack.llm.common import in_small_batches, only, sized, without
from airtrack.llm.components import components

#: Ratio of the largest to the smallest set size of a class; documents of a class share one cut of the order.
CLASS_RATIO = 1.5
#: Cuts tried for documents that have too many empty fragments; the last one compares empty fragments, too.
VARIANTS = 4
#: Fragments in which overlaps are counted separately.
COUNTING_FRAGMENTS = 4
#: Times that documents which share too few fragments to have a partner are left out of the others' counts.
PRUNINGS = 2
#: Bytes of text that one vectorised pass takes.
PASS_BYTES = 1_000_000

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(2).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_PRIME), -1, 2**64))
    return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, p)])) for p in (_PRIME, inverse))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text; of a shorter text one hash of all its words."""
    flat = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    word = ~_SPACE[flat]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=np.int8(0)))
    start, stop = edge[::2], edge[1::2]
    power, inverse = _powers(1 << max(20, len(flat).bit_length()))
    value = np.where(word, _BYTES[_LOWER[flat]], np.uint64(0)) * power[: len(flat)]
    total = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
    words = _mix((total[stop] - total[start]) * inverse[start] + (stop - start).astype(np.uint64))
    bounds = np.searchsorted(start, np.concatenate([[0], ends]))
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        grams = _mix(grams * _PRIME + words[k : len(words) - n + 1 + k]) if len(grams) else grams
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= n:
            own = np.sort(grams[a : b - n + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for k in range(a, b):
                whole = _mix(whole * _PRIME + words[k : k + 1] + np.uint64(1))
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Cuts:
    """Size classes and their numbers of fragments for a similarity threshold of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.similar = Fraction(percent, 100)
        self.spread = (1 - self.similar) / (1 + self.similar)  # differing n-grams per n-gram of both sets
        smallest = math.ceil(1 / self.spread / 2 - Fraction(1, 2))
        self.bounds = [max(1, smallest)]
        while self.bounds[-1] < 2**31:
            self.bounds.append(max(self.bounds[-1] + 1, math.ceil(self.bounds[-1] * CLASS_RATIO)))
        self.fragments = [self._fragments(b - 1) for b in self.bounds[1:]]

    def _fragments(self, n: int) -> int:
        """So many that sets of ``n`` n-grams have, but for rare ones, more filled fragments than differing n-grams."""
        differ = int(self.spread * 2 * n)

        def margin(k: int) -> float:
            empty = k * math.exp(-n / k)
            return (k - empty - differ - 1) / math.sqrt(empty + 0.05)

        most = differ * 2 + 8
        if margin(differ + 1) >= 3:
            return differ + 1
        low, high = differ + 1, next((k for k in range(differ + 2, most, max(1, differ // 64)) if margin(k) >= 3), 0)
        return high or max(range(low, most), key=margin)

    def size_class(self, n: int) -> int:
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def most_differing(self, n: int, tag: int) -> int:
        """Most differing n-grams in a similar pair of ``tag`` that has a set of ``n``."""
        return int(self.spread * (n + min(int(n / self.similar), self.bounds[tag + 1] - 1)))

    def tags(self, n: int) -> list[int]:
        """The classes in which a set meets its partners: the class of the larger set of each pair."""
        own = self.size_class(n)
        if own < 0:
            return []
        return [own, own + 1] if n >= self.similar * self.bounds[own + 1] else [own]

    def signatures(self, grams: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Hashes of filled fragments, the lowest bit telling whether the tag is odd; and for each tag the number of them in the
        first cut, and how many of them a similar set shares at least."""
        found, filled = [], []
        for tag in self.tags(len(grams)):
            k, allowed = self.fragments[tag], self.most_differing(len(grams), tag)
            for variant in range(VARIANTS):
                order = np.sort(_mix(grams + np.uint64(variant) * _PRIME)) if variant else grams
                part = ((order >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
                total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(order ^ np.uint64(variant + 7)), dtype=np.uint64)])
                at = np.searchsorted(part, np.arange(k + 1, dtype=np.uint64))
                count = np.diff(at)
                label = np.uint64((tag * VARIANTS + variant) << 40) + np.arange(k, dtype=np.uint64)
                marks = _mix(_mix((total[at[1:]] - total[at[:-1]]) + count.astype(np.uint64)) ^ _mix(label))
                marks = marks & ~np.uint64(1) | np.uint64(tag & 1)
                enough = np.count_nonzero(count) > allowed
                found.append(marks if variant == VARIANTS - 1 and not enough else marks[count > 0])
                if not variant:
                    filled += [int(np.count_nonzero(count)), int(np.count_nonzero(count)) - allowed]
                if enough:
                    break
        return np.concatenate(found) if found else np.zeros(0, np.uint64), filled


@lru_cache(maxsize=4)
def _cuts(percent: int) -> Cuts:
    return Cuts(percent)


def _passes(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in groups of bounded size, with the place of the first."""
    texts, held, first = [], 0, 0
    for i, cell in enumerate(batch.column(1)):
        raw = cell.as_py() or b""
        if texts and held + len(raw) > PASS_BYTES:
            yield first, texts
            texts, held, first = [], 0, i
        texts.append(raw)
        held += len(raw)
    if texts:
        yield first, texts


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return in_small_batches(docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("text")))


def set_table(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """``id, n_shingles, set_a, set_b, own, filled, need, filled_next, need_next``: size and identity of every document's set,
    its size class, filled fragments in this and the next class, and how many of them a similar set shares at least."""
    def run(batches):
        for batch in batches:
            out = [[] for _ in range(8)]
            for _, texts in _passes(batch):
                cuts = _cuts(percent)
                for grams in shingle_sets(texts, n):
                    filled = (cuts.signatures(grams)[1] + [0] * 4)[:4]
                    sums = (int(np.sum(f, dtype=np.uint64).view(np.int64)) if len(f) else 0 for f in (grams, _mix(grams ^ _PRIME)))
                    for column, value in zip(out, (len(grams), *sums, cuts.size_class(len(grams)), *filled)):
                        column.append(value)
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in out)], schema=layout)

    names = ("n_shingles", "set_a", "set_b", "own", "filled", "need", "filled_next", "need_next")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(x, T.LongType()) for x in names)])
    layout = pa.schema([_arrow_field(schema[0]), *((x, pa.int64()) for x in names)])
    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def _arrow_field(field: T.StructField) -> pa.Field:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.field(field.name, to_arrow_type(field.dataType))


def _signature_rows(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """``sig, id``: one row per filled fragment."""
    def run(batches):
        for batch in batches:
            for first, texts in _passes(batch):
                marks = [_cuts(percent).signatures(grams)[0] for grams in shingle_sets(texts, n)]
                owner = pa.array(np.repeat(np.arange(first, first + len(texts)), [len(m) for m in marks]))
                values = pa.array(np.concatenate(marks).view(np.int64))
                yield pa.record_batch([values, batch.column(0).take(owner)], schema=layout)

    kind = T.StructField("id", docs.schema[id_col].dataType)
    layout = pa.schema([("sig", pa.int64()), _arrow_field(kind)])
    return _rows(docs, id_col, text_col).mapInArrow(run, T.StructType([T.StructField("sig", T.LongType()), kind]))


def _fragment_rows(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``id, part, grams``: the n-grams of each document by counting fragment."""
    def run(batches):
        for batch in batches:
            for first, texts in _passes(batch):
                place, parts, lists = [], [], []
                for i, grams in enumerate(shingle_sets(texts, n)):
                    cuts = np.searchsorted(grams, bounds)
                    for part, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(grams)])):
                        if b > a:
                            place.append(first + i)
                            parts.append(part)
                            lists.append(grams[a:b].view(np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
                grams_column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.record_batch([
                    batch.column(0).take(pa.array(place, pa.int64())), pa.array(parts, pa.int32()), grams_column
                ], schema=layout)

    bounds = np.arange(COUNTING_FRAGMENTS, dtype=np.uint64) * np.uint64(2**64 // COUNTING_FRAGMENTS)
    kind = T.StructField("id", docs.schema[id_col].dataType)
    layout = pa.schema([_arrow_field(kind), ("part", pa.int32()), ("grams", pa.list_(pa.int64()))])
    schema = T.StructType([kind, T.StructField("part", T.IntegerType()), T.StructField("grams", T.ArrayType(T.LongType()))])
    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def _near_in_size(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` (with sizes ``n_a, n_b``) that are similar: overlaps of fragments are counted apart and summed."""
    left = parts.select(F.col("id").alias("a"), "part", F.col("grams").alias("grams_a"))
    right = parts.select(F.col("id").alias("b"), "part", F.col("grams").alias("grams_b"))
    counted = pairs.select("a", "b", "n_a", "n_b").join(left, "a").join(right, ["b", "part"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("both")
    )
    sums = counted.groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
    return sums.filter(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent).select("a", "b")


def _sizes(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with sizes, classes and filled fragments of both sides."""
    for side in ("a", "b"):
        own = sets.select(
            F.col("id").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("own").alias(f"own_{side}"),
            F.col("filled").alias(f"filled_{side}"), F.col("filled_next").alias(f"next_{side}"),
        )
        pairs = pairs.join(own, side)
    return pairs


def links(
    docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, n: int, percent: int
) -> DataFrame:
    """``a, b``: links between documents of distinct ids in ``docs`` that give the same components as all similar pairs.

    Documents that share a fragment are compared with the first of them, not with each other.  A fragment whose documents
    have become one component is done; documents of the others are compared completely by their rarest n-grams.
    """
    marks = _signature_rows(docs, id_col, text_col, n, percent)
    members = pin(marks.alias("x").join(marks.alias("y"), F.expr("x.sig = y.sig and x.id <> y.id"), "left_semi"))
    for _ in range(PRUNINGS):
        members = _with_enough(members, sets)
    ids = pin(members.select("id").distinct())
    own = pin(sets.join(sized(ids.toDF("_id")), F.col("id") == F.col("_id"), "left_semi"))
    parts = pin(_fragment_rows(only(docs, ids, id_col), id_col, text_col, n))
    stars = members.filter("id <> pivot").groupBy(F.col("pivot").alias("a"), F.col("id").alias("b")).agg(
        F.count(F.lit(1)).alias("shared")
    )
    likely = _sizes(stars, own).filter(_near_in_size("n_a", "n_b", percent) & _enough_shared(percent))
    found = pin(verified(likely, parts, percent))
    open_ = _apart(members.select("sig", "id"), sized(components(found)))
    apart = pin(open_.select("id", "component").distinct())
    hubs, pairs = _pairs_by_rare_grams(apart, own, parts, percent)
    return found.unionByName(hubs).unionByName(verified(_sizes(pairs, own), parts, percent))


def _with_enough(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``sig, id, pivot`` of documents that share as many fragments with others as they would with a similar set."""
    odd = F.pmod("sig", F.lit(2))
    counts = members.groupBy("id", odd.alias("odd")).agg(F.count(F.lit(1)).alias("shared"))
    need = F.when(F.col("odd") == F.pmod("own", F.lit(2)), F.col("need")).otherwise(F.col("need_next"))
    able = counts.join(sets.select(F.col("id").alias("_id"), "own", "need", "need_next"), F.col("id") == F.col("_id"))
    able = sized(able.filter(F.col("shared") >= need).select(F.col("id").alias("_id"), "odd"))
    left = pin(members.select("sig", "id").join(able, (F.col("id") == F.col("_id")) & (odd == F.col("odd")), "left_semi"))
    pivots = left.groupBy("sig").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot < last")
    return pin(left.join(sized(pivots.select("sig", "pivot")), "sig"))


def _pairs_by_rare_grams(apart: DataFrame, own: DataFrame, parts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links, and pairs ``a, b`` from different components, among documents that share one of their rarest n-grams.

    N-grams are ordered by their number of holders, those that no other document here holds come first.  A partner of a set of
    ``n`` lacks at most ``n - threshold * n`` of its n-grams, so the two share one of so many and one more, at places in both
    orders that leave room for the overlap.
    """
    side = sized(apart.select(F.col("id").alias("_id"), "component"))
    grams = parts.join(side, F.col("id") == F.col("_id")).select("id", F.explode("grams").alias("gram"))
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    lists = grams.join(common, "gram").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("holders", "gram"))).alias("held"))
    rare = lists.join(own.select("id", F.col("n_shingles").alias("n")), "id").join(side, F.col("id") == F.col("_id")).withColumn(
        "look", (F.size("held") - F.ceil(F.col("n") * percent / 100 - 1e-9) + 1).cast("int")
    ).filter("look > 0")
    rows = rare.select("id", "component", "n", F.explode(F.slice("held", F.lit(1), F.col("look"))).alias("g"))
    rows = pin(rows.select(F.col("g.gram").alias("sig"), "id", "component", "n"))
    return _pairs_in_families(pin(_several(rows).select("sig", "id", "component", "n")), parts, percent)


def _pairs_in_families(several: DataFrame, parts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links, and pairs that can be similar, among documents that share a ``sig`` with another component.

    A family is what shared signatures connect.  Most n-grams of near copies are held by nearly all of the family, so they do not
    tell which two are similar; what a document deviates in from the family's majority does: the n-grams that it holds and most lack
    and those that it lacks and most hold.  Differences between sets are differences between deviations.  With ``q = (100 - percent)
    / (100 + percent)`` and ``u = deviations - q * n``, two documents are similar if and only if they share ``(u_x + u_y) / 2``
    deviations.  Where that is nothing at all, both are similar to the document of the least ``u``, so these links need no pair; all
    others share one of their rarest deviations, at places that leave room for so many.
    """
    more, less = 100 + percent, 100 - percent
    hubs = several.groupBy("sig").agg(F.min("id").alias("hub"))
    edges = several.join(sized(hubs), "sig").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    families = sized(components(edges).select("id", F.col("component").alias("family")))
    docs = pin(several.select("id", "component", "n").distinct().join(families, "id"))
    side = sized(docs.select(F.col("id").alias("_id"), "family"))
    grams = pin(parts.join(side, F.col("id") == F.col("_id")).select("family", "id", F.explode("grams").alias("gram")))
    sizes = docs.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    held = grams.groupBy("family", "gram").agg(F.count(F.lit(1)).alias("holders")).join(sized(sizes), "family")
    major = F.col("holders") * 2 > F.col("size")
    held = held.select("family", "gram", major.alias("major"), F.when(major, F.col("size") - F.col("holders")).otherwise(F.col("holders")).alias("weight"))
    held = pin(held.filter("major or weight > 1"))
    centres = held.filter("major").groupBy("family").agg(F.collect_list("gram").alias("centre"))
    of = F.struct("weight", "gram")
    split = grams.join(held, ["family", "gram"]).groupBy("id").agg(
        F.collect_list(F.when(F.col("major"), F.col("gram"))).alias("major"),
        F.collect_list(F.when(~F.col("major") & (F.col("weight") > 1), of)).alias("minor"),
    )
    split = docs.join(split, "id").join(centres, "family", "left").withColumn("centre", F.coalesce("centre", F.array().cast("array<bigint>")))
    split = pin(split.withColumn("lacks", F.array_except("centre", "major")).withColumn("all", F.col("n") + F.size("centre") - 2 * F.size("major")).drop("centre", "major"))
    rare = held.filter("major and weight > 1").select("family", "gram", "weight")
    lacks = split.select("family", "id", F.explode("lacks").alias("gram")).join(rare, ["family", "gram"]).groupBy("id").agg(
        F.collect_list(of).alias("lacked")
    )
    known = split.drop("lacks").join(lacks, "id", "left").select(
        "family", "id", "component", "n", "all", (more * F.col("all") - less * F.col("n")).alias("u"),
        F.sort_array(F.concat("minor", F.coalesce("lacked", F.array().cast("array<struct<weight:bigint,gram:bigint>>")))).alias("deviations"),
    )
    known = pin(known)
    least = known.groupBy("family").agg(F.min(F.struct("u", "id", "component")).alias("z"))
    joined = known.drop("deviations").join(sized(least.select("family", F.col("z.u").alias("u_z"), F.col("z.id").alias("z"), F.col("z.component").alias("of_z"))), "family")
    near = pin(joined.filter("u + u_z <= 0 and component <> of_z").select("id", "z", "component", "of_z"))
    found = near.select(F.least("id", "z").alias("a"), F.greatest("id", "z").alias("b"))
    merged = components(near.select(F.col("component").alias("a"), F.col("of_z").alias("b")))
    merged = sized(merged.select(F.col("id").alias("component"), F.col("component").alias("into")))
    known = known.join(merged, "component", "left").withColumn("component", F.coalesce("into", "component"))
    needed = F.greatest(F.lit(1), F.ceil((F.col("u") + F.col("u_z")) / (2 * more) - 1e-9), F.ceil(F.col("all") - F.col("n") * less / percent - 1e-9))
    known = known.join(sized(least.select("family", F.col("z.u").alias("u_z"))), "family").withColumn(
        "look", (F.size("deviations") - needed + 1).cast("int")
    ).filter("look > 0")
    rows = known.select("family", "id", "component", "n", "u", F.size("deviations").alias("all"), F.posexplode(F.slice("deviations", F.lit(1), F.col("look"))).alias("at", "d"))
    rows = pin(rows.select("family", F.col("d.gram").alias("gram"), "id", "component", "n", "u", (F.col("all") - F.col("at")).alias("room")))
    one, two = (rows.select("family", "gram", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "component", "n", "u", "room"))) for s in "xy")
    both = F.ceil((F.col("u_x") + F.col("u_y")) / (2 * more) - 1e-9)
    pairs = one.join(two, ["family", "gram"]).filter("component_x <> component_y and id_x < id_y").filter(
        (both >= 1) & (F.col("room_x") >= both) & (F.col("room_y") >= both) & _near_in_size("n_x", "n_y", percent)
    )
    return found, pairs.select(F.col("id_x").alias("a"), F.col("id_y").alias("b")).distinct()


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``sig, id, component, main`` of fragments whose documents are in several components."""
    labelled = members.join(labels, "id", "left").select("sig", "id", F.coalesce("component", "id").alias("component"))
    return _several(pin(labelled))


def _several(rows: DataFrame) -> DataFrame:
    """Rows of ``sig, id, component`` whose ``sig`` occurs in several components, with the one that holds most, ``main``."""
    sizes = rows.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("sig").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("top")
    ).filter("parts > 1").select("sig", F.col("top.component").alias("main"))
    return rows.join(sized(several), "sig")


def _enough_shared(percent: int) -> Column:
    """A similar pair shares all filled fragments of a set but those that differing n-grams change."""
    differ = F.floor((F.col("n_a") + F.col("n_b")) * (100 - percent) / (100 + percent) + 1e-9)
    tag = F.greatest("own_a", "own_b")
    filled = [F.when(F.col(f"own_{s}") == tag, F.col(f"filled_{s}")).otherwise(F.col(f"next_{s}")) for s in "ab"]
    return F.col("shared") >= F.greatest(*filled) - differ


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """``id, n_shingles, component`` of every row: the size of its set and the smallest id that links lead to.

    Words are what ASCII white space separates, A-Z in lower case.  A set holds the distinct ``n``-word sequences of the whole
    text, or all words as one sequence if there are fewer.  Two documents are linked if ``100 * common >= percent * all``; the
    decision is exact but for equal 64-bit hashes of different sequences.

    Rows without words have size 0 and no links.  Equal sets form one class first, and one document of each class goes on.
    Rows that share an id share their links.  Rows with a null id have no links and a null component.  Empty tables give empty
    results; other columns are ignored.
    """
    sets = pin(set_table(docs, id_col, text_col, n, percent))
    known = sets.filter("id is not null and n_shingles > 0")
    classes = known.groupBy("set_a", "set_b", "n_shingles").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    copies = pin(known.join(sized(classes.drop("last")), ["set_a", "set_b", "n_shingles"]).filter("id <> first").select("id", "first").distinct())
    single = without(docs.filter(docs[id_col].isNotNull()), copies.select("id").distinct(), id_col)
    found = links(single, known.dropDuplicates(["id"]), id_col, text_col, n, percent)
    joined = found.unionByName(copies.select(F.col("first").alias("a"), F.col("id").alias("b")))
    labels = sized(components(joined).withColumnRenamed("id", "_id"))
    return sets.join(labels, F.col("id") == F.col("_id"), "left").select(
        "id", "n_shingles", F.coalesce("component", "id").alias("component")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component, all columns as they are."""
    found = similar_components(docs, id_col, text_col, n, percent)
    return without(docs, found.filter("component < id").select("id").distinct(), id_col)
