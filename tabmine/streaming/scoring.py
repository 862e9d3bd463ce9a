"""Scoring fitted models on streaming DataFrames.

Fitted naive Bayes models, trees and linear SVMs are pure projections over
literal model state, so the same ``transform`` applies to a DataFrame from
``spark.readStream``; no state store is involved. Sinks keep their progress in
a checkpoint folder under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir


def read_table_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int = 1) -> DataFrame:
    """Parquet files arriving under ``path`` as a stream with the schema of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", max_files).parquet(path)


def score_stream(model, stream: DataFrame) -> DataFrame:
    """Apply a fitted model (anything with ``transform(df)``) to a stream."""
    return model.transform(stream)


def write_scores(scored: DataFrame, path: str, query_name: str | None = None) -> StreamingQuery:
    """Append scored rows to Parquet with a checkpoint in the shared folder."""
    base = ensure_checkpoint_dir(scored.sparkSession).rstrip("/")
    ckpt = f"{base}/stream-{query_name or uuid.uuid4().hex}"
    return (scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt)
            .outputMode("append").start())
