"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtrack.lineage import pin
from airtrack.llm.common import in_small_batches, only, sized

#: The model predicts a byte of UTF-8 text from the three before it.
ORDER = 4
#: Models are sent to tasks; so many languages may have one.
MAX_LANGUAGES = 64
#: Quantiles of trusted documents that bound what is kept, and how far beyond them a document may be.
LOW, HIGH, SLACK = 0.01, 0.99, 0.12
#: A text is averaged with so many bytes of typical loss, so that short texts are not judged by a few bytes.
PRIOR_BYTES = 200
#: Bytes of text that one vectorised pass takes, and n-grams that a task counts before it gives them out.
PASS_BYTES, TASK_GRAMS = 1_000_000, 2_000_000


def training_text(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, text`` of all trusted documents, whole texts."""
    own = docs.select(docs[id_col].alias("_id"), docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text"))
    return only(own.filter("lang is not null and length(text) > 0"), trusted_ids(labels, id_col), "_id").select("lang", "text")


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids labelled as good and not toxic."""
    return labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select(
        labels[id_col].alias("id")
    ).distinct()


def _codes(text: bytes, order: int) -> np.ndarray:
    """The ``order`` bytes that end at each byte after the first ``order - 1``, as one number."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint32 if order <= 4 else np.uint64)
    codes = raw[: len(raw) - order + 1].copy()
    for k in range(1, order):
        codes <<= 8
        codes |= raw[k : k + len(codes)]
    return codes


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, gram, c``: n-grams of bytes (as hex) of all texts, with line breaks before each text.

    Tasks count their own texts, so that only different n-grams are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = b"\n" * (order - 1)
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        counted: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def count(lang):
            # A text's places are those of its own bytes; the padding between texts belongs to the next one.
            codes = np.concatenate([_codes(pad + t, order) for t in waiting.pop(lang)])
            sizes.pop(lang)
            grams, c = np.unique(codes, return_counts=True)
            if lang in counted:
                old, n = counted[lang]
                grams, at = np.unique(np.concatenate([old, grams]), return_inverse=True)
                c = np.bincount(at, np.concatenate([n, c]), len(grams)).astype(np.int64)
            counted[lang] = grams, c

        def given_out():
            for lang, (grams, c) in counted.items():
                for k in range(0, len(grams), 100_000):
                    part = grams[k : k + 100_000]
                    yield pa.record_batch([
                        pa.array([lang] * len(part), pa.string()), pa.array(part.astype(np.int64)), pa.array(c[k : k + 100_000].astype(np.int64))
                    ], names=["lang", "code", "c"])
            counted.clear()

        for batch in batches:
            for lang, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = cell.as_py()
                waiting.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= PASS_BYTES:
                    count(lang)
            if sum(len(g) for g, _ in counted.values()) > TASK_GRAMS:
                yield from given_out()
        for lang in list(waiting):
            count(lang)
        yield from given_out()

    rows = in_small_batches(texts.select("lang", F.encode("text", "UTF-8").alias("text")).filter("length(text) > 0"))
    parts = rows.mapInArrow(run, "lang string, code long, c long")
    return parts.groupBy("lang", "code").agg(F.sum("c").alias("c")).select(
        "lang", F.lpad(F.hex("code"), 2 * order, "0").alias("gram"), "c"
    )


def kneser_ney(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, gram, p, back``: probability of the last byte of every seen n-gram (as hex), and the weight its context leaves
    to the next shorter one; shorter n-grams of all orders included, and the empty one of each language.

    The highest order uses counts, lower orders the number of different bytes before.  Three discounts per language and
    order come from counts of counts.  Counting is sharded by n-gram; n-grams meet the sums of their context and the
    probability of their suffix in joins.
    """
    counts = {order: pin(gram_counts(texts, order))}
    for k in range(order - 1, 0, -1):
        counts[k] = counts[k + 1].select("lang", F.substr("gram", F.lit(3)).alias("gram")).groupBy("lang", "gram").agg(
            F.count(F.lit(1)).alias("c")
        )
    known = counts[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("v"))
    lower = known.select("lang", F.lit("").alias("gram"), (1 / F.col("v")).alias("p"))
    tables = [lower.withColumn("back", F.lit(1.0))]
    for k in range(1, order + 1):
        n = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
        cut = [
            F.when(y.isNull() | (F.col(f"n{i}") == 0), F.lit(0.5 * i))
            .otherwise(F.greatest(F.lit(0.1), i - F.try_divide((i + 1) * y * F.col(f"n{i + 1}"), F.col(f"n{i}"))))
            for i in (1, 2, 3)
        ]
        discounts = counts[k].groupBy("lang").agg(*n).select(
            "lang", *(F.least(d, F.lit(0.95 * i)).alias(f"d{i}") for i, d in enumerate(cut, 1))
        )
        with_cut = counts[k].join(discounts, "lang").withColumn(
            "d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        ).withColumn("context", F.substr("gram", F.lit(1), F.lit(2 * k - 2)))
        sums = with_cut.groupBy("lang", "context").agg((F.sum("d") / F.sum("c")).alias("back"), F.sum("c").alias("total"))
        suffix = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("shorter"))
        rows = pin(
            with_cut.withColumn("suffix", F.substr("gram", F.lit(3))).join(sums, ["lang", "context"]).join(suffix, ["lang", "suffix"])
            .select("lang", "gram", ((F.col("c") - F.col("d")) / F.col("total") + F.col("back") * F.col("shorter")).alias("p"), "back")
        )
        tables.append(rows)
        lower = rows.select("lang", "gram", "p")
    result = tables[0]
    for more in tables[1:]:
        result = result.unionByName(more)
    return result


def model(texts: DataFrame, order: int = ORDER) -> tuple[tuple[str, tuple[tuple[bytes, bytes, bytes], ...]], ...]:
    """The model on the driver, per language and length of n-gram: the sorted n-grams as numbers, negative logarithms of
    probabilities and of back-off weights; bounded with the different n-grams of a few bytes."""
    rows = kneser_ney(texts, order).select(
        "lang", (F.length("gram") / 2).cast("int").alias("k"), F.coalesce(F.conv("gram", 16, 10).cast("long"), F.lit(0)).alias("code"),
        (-F.log("p")).cast("float").alias("p"), (-F.log("back")).cast("float").alias("back"),
    ).toArrow()
    names = sorted(rows["lang"].unique().to_pylist())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are trusted")
    out = []
    for name in names:
        own = rows.filter(pc.equal(rows["lang"], name))
        k, code, p, back = (own[c].to_numpy() for c in ("k", "code", "p", "back"))
        levels = []
        for length in range(order + 1):
            at = np.flatnonzero(k == length)
            at = at[np.argsort(code[at])]
            levels.append((code[at].astype(np.uint32 if order <= 4 else np.uint64).tobytes(), p[at].tobytes(), back[at].tobytes()))
        out.append((name, tuple(levels)))
    return tuple(out)


class Scorer:
    """Losses of every byte after every context of one language, seen or not, by searching sorted n-grams."""

    def __init__(self, levels: tuple[tuple[bytes, bytes, bytes], ...]):
        self.order = len(levels) - 1
        kind = np.uint32 if self.order <= 4 else np.uint64
        self.grams, self.contexts = [], []
        for codes, p, back in levels:
            codes, p, back = np.frombuffer(codes, kind), np.frombuffer(p, np.float32), np.frombuffer(back, np.float32)
            self.grams.append((codes, p))
            contexts, first = np.unique(codes >> kind(8), return_index=True)
            self.contexts.append((contexts, back[first]))

    @staticmethod
    def _look(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = table
        at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        return keys[at] == codes, values[at]

    def _loss(self, codes: np.ndarray) -> np.ndarray:
        """An n-gram that is not seen costs its context's weight, if that is seen, and what the next shorter one costs."""
        loss, todo = np.zeros(len(codes), np.float32), np.arange(len(codes))
        for k in range(self.order, 0, -1):
            seen, cost = self._look(self.grams[k], codes)
            loss[todo[seen]] += cost[seen]
            todo, codes = todo[~seen], codes[~seen]
            if not len(todo):
                return loss
            seen, cost = self._look(self.contexts[k], codes >> codes.dtype.type(8))
            loss[todo] += np.where(seen, cost, np.float32(0))
            codes = codes & codes.dtype.type((1 << (8 * (k - 1))) - 1)
        loss[todo] += self.grams[0][1][0]
        return loss

    def losses(self, texts: list[bytes]) -> np.ndarray:
        """Sum of the negative log probabilities of each text's bytes."""
        pad = b"\n" * (self.order - 1)
        joined = pad + pad.join(texts)
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes + self.order - 1) - sizes - (self.order - 1)
        total = np.zeros(len(joined) - self.order + 2)
        for at in range(0, len(total) - 1, PASS_BYTES):
            part = self._loss(_codes(joined[at : at + PASS_BYTES + self.order - 1], self.order))
            total[at + 1 : at + 1 + len(part)] = part
        np.cumsum(total, out=total)
        return total[begin + sizes] - total[begin]


@lru_cache(maxsize=1)
def _scorers(packed: tuple) -> dict[str, Scorer]:
    return {lang: Scorer(levels) for lang, levels in packed}


def losses(
    docs: DataFrame, packed: tuple, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``id, model, n_bytes, loss`` of every row: the sum of losses under the model of its language, or under the model
    with the smallest sum if its language is null or has none; null where there is no text or no model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scorers = _scorers(packed)
            names, sizes, sums = [None] * len(batch), np.zeros(len(batch), np.int64), [None] * len(batch)
            langs = batch.column(1).to_pylist()
            groups: dict[str, list[tuple[int, bytes]]] = {}

            def judge(lang):
                rows = groups.pop(lang, [])
                for i, loss in zip((i for i, _ in rows), scorers[lang].losses([t for _, t in rows]) if rows else ()):
                    if sums[i] is None or loss < sums[i]:
                        names[i], sums[i] = lang, float(loss)

            for i, cell in enumerate(batch.column(2)):
                text = cell.as_py() or b""
                sizes[i] = len(text)
                for lang in (langs[i],) if langs[i] in scorers else tuple(scorers):
                    if text:
                        groups.setdefault(lang, []).append((i, text))
                        if sum(len(t) for _, t in groups[lang][-1:]) > PASS_BYTES or len(groups[lang]) >= 512:
                            judge(lang)
            for lang in list(groups):
                judge(lang)
            yield pa.record_batch([
                batch.column(0), pa.array(names, pa.string()), pa.array(sizes), pa.array(sums, pa.float64())
            ], names=["id", "model", "n_bytes", "loss"])

    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("model", T.StringType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("loss", T.DoubleType()),
    ])
    rows = docs.select(docs[id_col].alias("id"), docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("binary").alias("text"))
    return in_small_batches(rows).mapInArrow(run, schema)


def _perplexity(typical: Column) -> Column:
    return F.exp((F.col("loss") + typical * PRIOR_BYTES) / (F.col("n_bytes") + PRIOR_BYTES))


def judged(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    low: float = LOW, high: float = HIGH, slack: float = SLACK,
) -> DataFrame:
    """``id, model, n_bytes, perplexity, lowest, highest, kept`` of every row of ``docs``.

    A model per language is trained on the whole text of all its trusted documents; perplexity is per byte over the whole text, with
    :data:`PRIOR_BYTES` bytes of the language's median loss.  A document is kept if its perplexity lies between the ``low``
    and ``high`` quantiles of all trusted documents of its language, ``slack`` beyond them included: gibberish is harder to
    predict than trusted text, repetition is easier.  Rows of a language without trusted text go to the model that predicts
    them best.

    Null and empty texts, and all rows if nothing is trusted, have a null perplexity and are not kept.  Repeated rows give
    repeated results; labels may repeat; an empty table gives an empty result; other columns are ignored.
    """
    packed = model(training_text(docs, labels, id_col, text_col, lang_col))
    scored = pin(losses(docs, packed, id_col, text_col, lang_col))
    trusted = scored.filter("n_bytes > 0").join(trusted_ids(labels, id_col), "id", "left_semi")
    typical = sized(trusted.groupBy("model").agg(F.percentile_approx(F.col("loss") / F.col("n_bytes"), 0.5, 10_000).alias("typical")))
    rated = trusted.join(typical, "model").select("model", _perplexity(F.col("typical")).alias("perplexity"))
    bounds = rated.groupBy("model").agg(F.percentile_approx("perplexity", [low, high], 10_000).alias("q"))
    limits = sized(bounds.join(typical, "model").select(
        "model", "typical", (F.col("q")[0] * (1 - slack)).alias("lowest"), (F.col("q")[1] * (1 + slack)).alias("highest")
    ))
    found = scored.join(limits, "model", "left").withColumn("perplexity", _perplexity(F.col("typical")))
    return found.select(
        "id", "model", "n_bytes", "perplexity", "lowest", "highest",
        F.coalesce(F.col("perplexity").between(F.col("lowest"), F.col("highest")), F.lit(False)).alias("kept"),
    )


def filtered(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are."""
    kept = judged(docs, labels, id_col, text_col).filter("kept").select("id").distinct()
    side = sized(kept.toDF("_kept"))
    return docs.join(side, docs[id_col] == side["_kept"], "left_semi")
