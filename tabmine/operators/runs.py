"""Run registry: clustering runs appended to a Parquet table and compared.

A run row: run_id, algo, params MAP<STRING,STRING>, dataset, features
ARRAY<STRING>, metrics (silhouette, calinski_harabasz, davies_bouldin,
inertia), cluster_sizes MAP<STRING,BIGINT>, n_clusters, ts.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

RUN_SCHEMA = (
    "run_id string, algo string, params map<string,string>, dataset string, features array<string>, "
    "silhouette double, calinski_harabasz double, davies_bouldin double, inertia double, "
    "cluster_sizes map<string,bigint>, n_clusters bigint, ts timestamp"
)


def run_id(n: int, algo: str, params: Mapping, auto: bool = False) -> str:
    """Run{n}_[Auto_]{algo}_{k3 | eps0.5_min5 | n2_ward | n2}."""
    if algo in ("KMeans", "K-Medoids"):
        p = f"k{params.get('n_clusters', 3)}"
    elif algo == "DBSCAN":
        p = f"eps{float(params.get('eps', 0.5)):.1f}_min{params.get('min_samples', 5)}"
    elif algo == "AGNES":
        p = f"n{params.get('n_clusters', 2)}_{params.get('linkage', 'ward')}"
    elif algo == "DIANA":
        p = f"n{params.get('n_clusters', 2)}"
    else:
        p = ""
    return f"Run{n}_{'Auto_' if auto else ''}{algo}_{p}"


def run_record(spark: SparkSession, n: int, algo: str, params: Mapping, dataset: str, features: Sequence[str],
               labels: DataFrame, metrics: DataFrame, cluster: str = "cluster", auto: bool = False,
               ts: _dt.datetime | None = None) -> DataFrame:
    """One run row built from a labels frame and a one-row metrics frame
    (all computed by Spark from the data)."""
    size = labels.groupBy(F.col(cluster).cast("string").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    # one row, built and kept on the executors whatever the number of clusters
    sizes = cut_lineage(size.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n")))).alias("cluster_sizes"),
                                 F.count_if(F.col("c") != "-1").alias("n_clusters")))
    m = metrics.first()
    vals = [None if m[c] is None else float(m[c]) for c in ("silhouette", "calinski_harabasz", "davies_bouldin", "inertia")]
    ts = ts or _dt.datetime.now(_dt.timezone.utc)
    row = (run_id(n, algo, params, auto), algo, {k: str(v) for k, v in params.items()}, dataset, list(features), *vals, ts)
    schema = T.StructType.fromDDL(RUN_SCHEMA)
    known = T.StructType([f for f in schema.fields if f.name not in sizes.columns])
    return spark.createDataFrame([row], known).crossJoin(sizes).select(*schema.names)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append to the registry table."""
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def runs_metrics_table(runs: DataFrame) -> DataFrame:
    """R2: one row per run, rounded 4 / 2 / 4 / 2; a true 0 stays 0."""
    return runs.select(
        "run_id", "algo", "dataset", F.array_join("features", ", ").alias("features"), "n_clusters",
        F.round("silhouette", 4).alias("silhouette"), F.round("calinski_harabasz", 2).alias("calinski_harabasz"),
        F.round("davies_bouldin", 4).alias("davies_bouldin"), F.round("inertia", 2).alias("inertia"))


def runs_params_long(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "algo", F.explode("params").alias("param", "value"))


def runs_params_table(runs: DataFrame) -> DataFrame:
    """Sparse parameter columns (pivot of the exploded params)."""
    long = runs_params_long(runs)
    names = sorted(r["param"] for r in long.select("param").distinct().collect())
    return long.groupBy("run_id", "algo").pivot("param", names).agg(F.first("value"))


def compare_runs(runs: DataFrame, a: str, b: str) -> DataFrame:
    """Metrics and parameters of two runs side by side (long form, full
    outer join on the name, 'N/A' where absent)."""
    def long(rid: str) -> DataFrame:
        r = runs.where(F.col("run_id") == rid)
        m = r.select(F.explode(F.create_map(
            *[x for c in ("silhouette", "calinski_harabasz", "davies_bouldin", "inertia")
              for x in (F.lit(c), F.round(F.col(c), 4).cast("string"))])).alias("name", "value")).withColumn("kind", F.lit("metric"))
        p = r.select(F.explode("params").alias("name", "value")).withColumn("kind", F.lit("param"))
        return m.unionByName(p)

    la = long(a).withColumnRenamed("value", "run_a")
    lb = long(b).withColumnRenamed("value", "run_b")
    j = la.join(lb, ["kind", "name"], "full_outer")
    return j.select("kind", "name", F.coalesce("run_a", F.lit("N/A")).alias("run_a"),
                    F.coalesce("run_b", F.lit("N/A")).alias("run_b"))


def compatible_runs(runs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Runs whose features are all columns of the given table."""
    cols = F.array(*[F.lit(c) for c in columns])
    return runs.where(F.size(F.array_except("features", cols)) == 0).select("run_id", "algo")


def latest(runs: DataFrame, key: str = "algo") -> DataFrame:
    """The last run per key (max_by on ts, then run_id)."""
    return runs.groupBy(key).agg(F.max_by("run_id", F.struct("ts", "run_id")).alias("latest_run"))
