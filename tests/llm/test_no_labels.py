"""Toxicity without rows of both kinds."""

import corpus_pipeline
import pytest

from tabmine.llm import toxicity


@pytest.mark.parametrize("labels", [[], [(900, 1)], [(1, 1), (3, 1), (4, 1)], [(1, 0), (3, 0)]])
def test_nothing_is_flagged_without_both_kinds(spark, labels):
    docs = spark.createDataFrame([(k, f"some plain words {k}.") for k in range(12)] + [(None, None)], "doc_id long, text string")
    out = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == 13 and all(r["predicted"] == 0 and 0 <= r["score"] < toxicity.THRESHOLD and not r["spans"] for r in out)


def test_pipeline_stage_keeps_everything_without_labels(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(k, f"some plain words {k}.") for k in range(12)], "doc_id long, text string")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == 12
