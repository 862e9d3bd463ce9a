"""The training-data pipeline: stages over the documents table, each stage's rows written and read again by the next.

Stages, in order: toxicity (documents that are predicted toxic go), near duplicates (one document of each group stays),
benchmark decontamination (benchmark passages go, and documents mostly made of them), mixing to target weights (a document
appears as often as its copies say), token files (what the files hold, one row per written document).

In every stage a null text counts as empty: it is not toxic, near no other text, without benchmark words, of size 0 (so
the mix takes no copy of it). Rows that repeat a doc_id are each a row. Of ties the smallest doc_id stays. An empty table
stays empty. Further columns pass through, whatever their names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmine.llm import decontaminate, mixing, near_dup, token_files, toxicity
from tabmine.llm.common import shielded, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the threshold. The field is fitted on labelled rows of the stage's own input."""
    inner = shielded(docs, "doc_id", "text")
    field = toxicity.fit_on(inner, table(spark, sf_dir, "labels"))
    return toxicity.score(inner, field).where(F.col("__score") < toxicity.THRESHOLD).select(*inner.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by five-word shingles at a similarity of 0.8 or more;
    of rows that repeat one doc_id and set, each stays, as they are one document."""
    inner = shielded(docs, "doc_id", "text")
    gone = near_dup.near_duplicates(inner).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    gone = stored(gone, "gone")
    known = F.broadcast(gone) if gone.count() <= near_dup.SENT_IDS else gone
    return inner.join(known, F.col("doc_id") == F.col("__gone"), "left_anti").select(*inner.columns).toDF(*docs.columns)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ten words or more that the benchmark has too."""
    return decontaminate.remove_hits(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the target weights of their sources ask for."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every written document, read back from the token files."""
    return token_files.token_output(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_documents),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: SQL cannot say a trained field or byte-pair encoding; tests/llm checks the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on the documents of `sf_dir`; every stage's rows are stored before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
