"""The stages against brute force, each on what the stage before kept."""

import corpus_pipeline
from airtrack.llm import decontaminate, language
from tests.llm.test_mixing import check
from tests.llm.test_shingle_join import brute

SCALE = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SCALE}/documents.parquet")
    columns = docs.columns
    extra = [
        (900, docs.first().text, "en", "src0", 1), (901, "... 12 !", "en", "src1", 1), (902, None, None, None, None), (903, "", "en", "src2", 0),
        (904, docs.first().text + " one more word", "en", "src3", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    rows = {r.doc_id: r for r in docs.collect()}
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SCALE}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = set(kept or rows)
        docs = stage(spark, docs, SCALE)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            assert set(kept) == {i for i in before if language.letters(rows[i].text)}
        elif name == "exact_copies":
            last = {rows[i].text: i for i in sorted(before)}
            assert set(kept) == set(last.values())
        elif name == "near_duplicates":
            groups = brute([(i, rows[i].text) for i in before], 5, 80)
            assert set(kept) == {g for _, g in groups.values()}
        else:
            assert {i for i in before if any(t in decontaminate.normal(rows[i].text) for t in items)} <= before - set(kept)
            assert len(kept) > 0.8 * len(before)
    found = corpus_pipeline.STAGES[-1][1](spark, docs, SCALE).withColumnRenamed("doc_id", "id").collect()
    check([(r.doc_id, r.text, r.source) for r in kept.values()], found)


def test_run_and_empty(spark):
    assert corpus_pipeline.run(spark, SCALE).count() > 100
    docs = spark.read.parquet(f"{SCALE}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SCALE)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)
