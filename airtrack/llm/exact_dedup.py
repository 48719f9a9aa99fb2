"""Exact duplicates by progressive refinement: length, then a hash of the first characters, then the full digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtrack.lineage import pin
from airtrack.llm.common import only, sized, without

PREFIX_CHARS = 256


def duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS,
    digests: bool = False,
) -> DataFrame:
    """``id, keep_id, group_size, kept`` of every row whose text occurs more than once; the largest id stays.

    Rows are refined in three steps, and only survivors of one step enter the next: texts of a length that occurs
    twice, then texts that also share the hash of their first ``prefix_chars`` characters, then texts that share their
    SHA-256.  The first two steps move two numbers per row; the full content is read for survivors only.

    With ``digests`` every row is returned, unique ones as groups of one, with ``text_sha256``; every text is then
    digested in the first reading, and the last step uses that digest.

    A null text equals the empty text.  A null id is smaller than any other.  Rows that repeat the largest id of their
    group all stay.  An empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(text, 256)
    columns = [
        docs[id_col].alias("id"), F.octet_length(text).alias("length"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("head"),
    ]
    rows = pin(docs.select(*columns, *([digest.alias("text_sha256")] if digests else [])))
    lengths = rows.groupBy("length").count().filter("count > 1").select("length")
    heads = (
        rows.join(sized(lengths), "length", "left_semi").groupBy("length", "head").count().filter("count > 1")
        .select("length", "head")
    )
    suspects = rows.join(sized(heads), ["length", "head"], "left_semi")
    if not digests:
        named = docs.select(docs[id_col].alias("id"), text.alias("text"))
        again = only(named, suspects.select("id").distinct(), "id").unionByName(named.filter("id is null"))
        suspects = pin(again.select("id", F.octet_length("text").alias("length"), F.sha2("text", 256).alias("text_sha256")))
    groups = sized(
        suspects.groupBy("length", "text_sha256")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    )
    found = (rows if digests else suspects).join(groups, ["length", "text_sha256"], "left" if digests else "inner")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        "id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), *(["text_sha256"] if digests else []),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are; rows with a null id stay."""
    found = duplicates(docs, id_col, text_col)
    return without(docs, found.filter(~F.col("kept")).select("id").distinct(), id_col)
