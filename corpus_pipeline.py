"""A corpus from raw documents: language, exact and near duplicates, benchmark passages, and the mix of sources.

Every stage takes what the stage before kept and returns the columns of ``documents``; the last one returns the mix, one row
per document that is left: how often it is taken.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from airtrack.lineage import shared_folder
from airtrack.llm import decontaminate, exact_dedup, language, mixing, shingle_join
from airtrack.llm.common import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a text whose language can be told go."""
    return language.known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles the one with the smallest id stays."""
    return shingle_join.one_of_each(docs, n=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every document."""
    return mixing.mix(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("source_mix", source_mix),
]

#: Cross-parsing and dependent rounding are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    folder = f"{shared_folder(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
