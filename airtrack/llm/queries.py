"""Registered queries of the text operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from airtrack.llm import (
    decontaminate,
    divergence,
    exact_dedup,
    language,
    licences,
    line_dedup,
    main_text,
    mixing,
    packing,
    quality,
    sanitise,
    search,
    shingle_join,
)
from airtrack.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shingle_join.similar_components(table(spark, sf_dir, "documents"), n=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.sample(docs))
    return found.select(F.col("id").alias("doc_id"), language.held_out("id").alias("held_out"), "lang_pred", "score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, sf_dir, "documents"), digests=True)
    return found.withColumnRenamed("id", "doc_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.without_repeats(docs).select("doc_id", "text")


def op8_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = listed(F.filter("spans", lambda s: s["kind"] != "term"))
    return found.select(
        F.col("id").alias("doc_id"), *map(count, ("email", "ip", "card", "phone")), F.sha2(base, 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "source"
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = main_text.main_text(pages, main_text.weights(main_text.training_pages(pages)))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assigned(found).select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_ngram_join": op2_ngram_join,
        "op3_quality": op3_quality,
        "op4_licences": op4_licences,
        "op5_language_id": op5_language_id,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_line_dedup": op7_line_dedup,
        "op8_sanitise": op8_sanitise,
        "op9_source_mix": op9_source_mix,
        "op10_main_text": op10_main_text,
        "op11_source_divergence": op11_source_divergence,
        "op12_lexical_search": op12_lexical_search,
        "op13_packing": op13_packing,
        "pipeline": corpus_pipeline.run,
    }
