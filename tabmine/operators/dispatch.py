"""Clustering dispatch by algorithm name with metrics and sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster_metrics import cluster_metrics

ALGORITHMS = ("KMeans", "K-Medoids", "DBSCAN", "AGNES", "DIANA")


def run_clustering(algo: str, params: dict, df: DataFrame, id_col: str, features: Sequence[str],
                   with_metrics: bool = True) -> dict:
    """Returns labels (id, cluster), model extras, metrics (one row) and
    cluster sizes; an unknown algorithm raises."""
    feats = list(features)
    extras: dict = {}
    if algo == "KMeans":
        from .kmeans import kmeans

        r = kmeans(df, id_col, feats, k=int(params.get("n_clusters", 3)), init=params.get("init", "k-means++"),
                   n_init=int(params.get("n_init", 10)), max_iter=int(params.get("max_iter", 100)),
                   seed=int(params.get("seed", 42)))
        labels, extras = r.labels, {"centroids": r.centers, "inertia": r.inertia, "n_iter": r.n_iter}
    elif algo == "K-Medoids":
        from .kmedoids import kmedoids

        r = kmedoids(df, id_col, feats, k=int(params.get("n_clusters", 3)), metric=params.get("metric", "euclidean"),
                     max_iter=int(params.get("max_iter", 300)), mode=params.get("mode", "exact"))
        labels, extras = r.labels, {"medoid_ids": r.medoid_ids, "inertia": r.inertia}
    elif algo == "DBSCAN":
        from .dbscan import dbscan

        labels = dbscan(df, id_col, feats, float(params.get("eps", 0.5)), int(params.get("min_samples", 5)))
    elif algo == "AGNES":
        from .hierarchy import agnes

        labels, link = agnes(df, id_col, feats, int(params.get("n_clusters", 2)), params.get("linkage", "ward"),
                             params.get("metric", "euclidean"), mode=params.get("mode", "exact"))
        extras = {"linkage": link}
    elif algo == "DIANA":
        from .diana import diana

        labels, hist = diana(df, id_col, feats, int(params.get("n_clusters", 2)), params.get("metric", "euclidean"))
        extras = {"history": hist}
    else:
        raise ValueError(f"unknown algorithm {algo!r}; expected one of {ALGORITHMS}")
    out = {"labels": labels.select(id_col, "cluster"), "extras": extras,
           "sizes": labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))}
    if with_metrics:
        vec = df.select(F.col(id_col), F.array(*[F.col(f).cast("double") for f in feats]).alias("vec"))
        out["metrics"] = cluster_metrics(vec.join(labels.select(id_col, "cluster"), id_col), id_col, "vec", "cluster")
    return out
