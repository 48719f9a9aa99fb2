"""Personal data: entities by pattern, and terms that reveal them by corpus co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrack.lineage import pin
from airtrack.llm.common import pin_counted, sized

#: A term discloses an entity if it carries so much of the entity's information, in so many different lines at least.
DISCLOSURE, SUPPORT = 0.75, 4
#: Letters of the stem that a term is generalised to.
STEM = 4

# The base patterns.  A run of characters that a pattern can begin with is entered at its beginning or where the
# last match ended, and repeated groups do not give back, so that time and stack stay in proportion to the text.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_WORD = r"[\p{L}]{4,}"

_SPANS = "array<struct<kind:string,start:int,stop:int,value:string>>"


def _matches(text: Column, kind: str, pattern: Column, possible: Column, keep) -> Column:
    """Spans of a pattern's leftmost matches that ``keep`` accepts; texts without ``possible`` are not searched.

    The text is split at the matches; lengths of gaps and matches give their places in one scan.
    """
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.transform(
        F.split(text, pattern, -1), lambda gap, i: F.struct(F.length(gap).alias("gap"), F.get(values, i).alias("value"))
    )
    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state, part):
        begin = state["at"] + part["gap"]
        stop = begin + F.coalesce(F.length(part["value"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), stop.alias("stop"), part["value"].alias("value"))
        found = F.when(part["value"].isNotNull() & keep(part["value"]), F.array(span).cast(_SPANS)).otherwise(none)
        return F.struct(stop.alias("at"), F.concat(state["spans"], found).alias("spans"))

    return F.when(possible, F.aggregate(parts, start, step)["spans"]).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """16 to 19 digits whose Luhn sum is a multiple of ten."""
    numbers = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: d.cast("int"))
    total = F.aggregate(
        F.transform(numbers, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)),
        F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)),
    )
    return F.length(_digits(value)).between(16, 19) & (total % 10 == 0)


def _address(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))


def base_spans(text: Column) -> Column:
    """E-mail addresses, IP addresses, card numbers and phone numbers of a text, by kind as listed, then by place."""
    return F.concat(
        _matches(text, "email", F.lit(_EMAIL), F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        _matches(text, "ip", F.lit(_IP), text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), _address),
        _matches(text, "card", F.lit(_CARD), text.rlike(r"(?:[0-9][\x20-]?){15}[0-9]"), _luhn),
        _matches(text, "phone", F.lit(_PHONE), F.contains(text, F.lit("+")), lambda v: F.length(_digits(v)).between(8, 15)),
    )


def _entity(span: Column) -> Column:
    """The same address or number, however it is written."""
    plain = F.when(span["kind"] == "email", F.lower(span["value"])).otherwise(F.regexp_replace(span["value"], r"[^0-9.]", ""))
    return F.concat_ws(":", span["kind"], plain)


def _terms(text: Column) -> Column:
    """Distinct words of a text in lower case, and their stems, marked with a star."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))
    return F.array_distinct(F.concat(words, F.transform(words, lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*")))))


def _blanked(text: Column, spans: Column) -> Column:
    return F.aggregate(spans, text, lambda t, s: F.replace(t, s["value"], F.lit(" ")))


def disclosing_terms(rows: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``term, general``: words that reveal a protected entity, and the stem that does not, or null.

    ``rows`` has ``text`` and its base ``spans``; the sample space is the lines of all texts.  With ``n`` lines, an entity
    ``e`` in ``n_e``, a term ``t`` in ``n_t`` and both in ``n_te`` of them, the term gives ``log(n n_te / (n_t n_e))`` of the
    entity's information ``log(n / n_e)``.  A term discloses the entity if that share is at least ``disclosure`` and the two
    meet in at least ``support`` different lines: copies of one line are no evidence.  Pairs are only formed with entities
    and within lines, and terms are counted in the corpus after joining with the candidates.
    """
    lines = rows.filter(F.size("spans") > 0).select(F.explode(F.split("text", "\n")).alias("line"))
    held = lines.withColumn("spans", base_spans(F.col("line"))).filter(F.size("spans") > 0)
    met = pin(held.select(
        F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity"),
        _terms(_blanked(F.col("line"), F.col("spans"))).alias("terms"), F.xxhash64("line").alias("line"),
    ))
    each = met.groupBy("entity", "line").agg(F.count(F.lit(1)).alias("n"))
    entities = each.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count(F.lit(1)).alias("lines")).filter(F.col("lines") >= support)
    joint, found = pin_counted(
        met.join(sized(entities.select("entity", "n_e")), "entity")
        .select("entity", "n_e", "line", F.explode("terms").alias("term"))
        .groupBy("entity", "n_e", "term", "line").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("entity", "n_e", "term").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("lines"))
        .filter(F.col("lines") >= support)
    )
    if not found:
        return joint.select("term", F.lit(None).cast("string").alias("general"))
    line_count = F.regexp_count("text", F.lit("\n")) + 1
    n = F.lit(float(rows.agg(F.sum(line_count.cast("long"))).first()[0]))
    counted = (
        rows.select(F.explode(F.split("text", "\n")).alias("line")).select(F.explode(_terms(F.col("line"))).alias("term"))
        .join(sized(joint.select("term").distinct()), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    )
    share = F.log(F.col("n_te") * n / (F.col("n_t") * F.col("n_e"))) / F.log(n / F.col("n_e"))
    flagged = pin(joint.join(counted, "term").filter(share >= disclosure).select("term").distinct())
    stems = flagged.filter(F.endswith("term", F.lit("*"))).select(F.col("term").alias("stem"), F.lit(True).alias("reveals"))
    words = flagged.filter(~F.endswith("term", F.lit("*"))).withColumn("stem", F.concat(F.substring("term", 1, STEM), F.lit("*")))
    return words.join(stems, "stem", "left").select("term", F.when(F.col("reveals").isNull(), F.col("stem")).alias("general"))


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT
) -> DataFrame:
    """``id, text, spans`` of every row: base spans, and the terms that disclose one of the corpus's entities.

    A span has ``kind, start, stop, value``, in code points, stop exclusive; spans are ordered by kind, then by place.  The
    value of a term's span is what replaces it: its stem, or nothing.  A term is marked wherever it occurs outside of base
    spans.  A null text counts as empty.  Repeated rows give repeated results; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("spans", base_spans(F.col("text")))
    terms, n = pin_counted(disclosing_terms(rows, disclosure, support))
    return _with_terms(rows, terms) if n else rows


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Texts that hold terms are found by joining their distinct words with the terms; only those are searched again."""
    key = F.sha2("text", 256)
    hits = (
        rows.select(key.alias("key"), F.explode(_terms(F.col("text"))).alias("term")).join(sized(terms), "term")
        .groupBy("key").agg(F.sort_array(F.collect_set(F.struct("term", "general"))).alias("terms"))
    )
    found = rows.withColumn("key", key).join(sized(hits), "key", "left")
    names = F.array_join(F.transform("terms", lambda t: t["term"]), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.coalesce(names, F.lit("")), F.lit(r")(?!\p{L})"))
    places = _matches(F.col("text"), "term", pattern, F.col("terms").isNotNull(), lambda v: F.lit(True))
    outside = F.filter(places, lambda t: ~F.exists("spans", lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"])))
    general = F.map_from_entries("terms")
    replaced = F.transform(outside, lambda t: t.withField("value", F.coalesce(F.try_element_at(general, F.lower(t["value"])), F.lit(""))))
    return found.select("id", "text", F.concat("spans", replaced).alias("spans"))


def sanitised(found: DataFrame) -> DataFrame:
    """``id, text``: the result of :func:`find` with entities replaced by their kind, and terms by their stem or nothing."""
    spans = F.array_sort("spans", lambda a, b: b["start"] - a["start"])

    def replace(text, s):
        new = F.when(s["kind"] == "term", s["value"]).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(F.substr(text, F.lit(1), s["start"]), new, F.substr(text, s["stop"] + 1))

    return found.select("id", F.aggregate(_apart(spans), F.col("text"), replace).alias("text"))


def _apart(spans: Column) -> Column:
    """Of overlapping spans of different kinds, in the order from back to front, the first."""
    none = F.array().cast(_SPANS)
    return F.aggregate(spans, none, lambda kept, s: F.when(
        F.exists(kept, lambda k: (k["start"] < s["stop"]) & (s["start"] < k["stop"])), kept
    ).otherwise(F.concat(kept, F.array(s).cast(_SPANS))))
