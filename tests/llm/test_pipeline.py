"""The pipeline's stages on awkward rows, and every stage's effect on the next one's input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tabmine.llm import near_dup

from . import messy


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(messy.rows(distinct_ids=True), messy.SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in messy.rows(distinct_ids=True)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "no document has these words in this order at all ever")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_keep_the_columns_whatever_their_names(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for c in ("__score", "__spans", "__gone", "__rid", "__copies", "__copy", "__n_words", "__hits", "__items", "y", "part"):
        docs = docs.withColumn(c, F.col("doc_id"))
    start = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == start, name
        assert docs.where("not (__score <=> doc_id and __rid <=> doc_id and __items <=> doc_id and __gone <=> doc_id)").count() == 0, name


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    want = {w[0] for w in messy.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()], 5) if w[3]}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert near_dup.near_duplicates(kept).where("not kept").count() == 0
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} <= want
    assert [r["start"] for r in sorted(out, key=lambda r: r["start"])][0] == 0


def test_stages_take_empty_tables(spark, folder, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0, name
