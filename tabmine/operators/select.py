"""Parameter search: elbow, silhouette curve, best parameters per algorithm,
k-distance curve and dendrogram cut height."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import running_sums
from ..functions.quantiles import order_statistics
from ..functions.vectors import np_distance_matrix
from . import packs, plane
from .dbscan import k_distances
from .kmeans import elbow, labels_of, vec_frame
from .pairs import DEFAULT_BLOCK_ROWS, _stack, block_join


def elbow_table(df: DataFrame, id_col: str, features: Sequence[str] | None = None, ks: Sequence[int] = range(2, 11),
                restarts: int = 5, vec_col: str | None = None, seed: int = 42) -> DataFrame:
    """Q7: best inertia per k (all runs share each iteration's job)."""
    table, _, _, _ = elbow(df, id_col, features, ks, restarts, vec_col, seed=seed)
    return table.select("k", F.round("inertia", 4).alias("inertia"))


def multi_silhouette(v: DataFrame, labels: DataFrame, n_runs: int, block_rows: int | None = None) -> dict:
    """Mean exact silhouette of many labelings of the same rows in one block
    join: each block pair's distances are computed once and reused by every
    labeling. ``labels``: (id, labs ARRAY<INT>) with one label per run. Rows of
    one or two dimensions go through k-d leaves instead, other rows with distinct
    ids and few distinct rows of labels through packs."""
    both = v.join(labels, "id").select("id", "vec", "labs")
    if plane.fits(both, "id", "vec", F.forall("labs", lambda c: c.isNotNull())):
        got = plane.silhouettes(both.select(*plane.places("vec"), F.col("labs").cast("array<bigint>").alias("labs")), n_runs)
        if got is not None:
            return dict(enumerate(got))
    if block_rows is None:
        block_rows = DEFAULT_BLOCK_ROWS
        known = both.select("labs").distinct().limit(packs.MAX_LABELS + 1).collect()
        if len(known) <= packs.MAX_LABELS and all(r["labs"] is not None and None not in r["labs"] for r in known) and packs.distinct_ids(both):
            x = both.withColumn("labs", F.col("labs").cast("array<int>"))
            if x.count() >= 2:
                return dict(enumerate(packs.silhouettes(packs.pack(x, labs=True), np.array([r["labs"] for r in known], np.int32))))
    x = both.select("id", "vec", F.to_json("labs").alias("lab"))
    id_type = dict(x.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"id": [], "run": [], "cluster": [], "s": [], "n": []})
        d = np_distance_matrix(_stack(qp["vec"]), _stack(bp["vec"]))
        same = qp["id"].to_numpy()[:, None] == bp["id"].to_numpy()[None, :]
        blabs = np.array([json.loads(s) for s in bp["lab"].to_numpy()])
        out = []
        for r in range(n_runs):
            col = blabs[:, r]
            for lab in np.unique(col):
                m = col == lab
                out.append(pd.DataFrame({"id": qp["id"].to_numpy(), "run": r, "cluster": int(lab),
                                         "s": d[:, m].sum(axis=1), "n": m.sum() - same[:, m].sum(axis=1)}))
        return pd.concat(out, ignore_index=True)

    sums = block_join(x, x, kernel, f"id {id_type}, run int, cluster int, s double, n bigint", block_rows).groupBy(
        "id", "run", "cluster").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    own = labels.select("id", F.posexplode("labs").alias("run", "own"))
    per = sums.join(own, ["id", "run"]).groupBy("id", "run").agg(
        F.max(F.when(F.col("cluster") == F.col("own"), F.col("s") / F.col("n"))).alias("a"),
        F.max(F.when(F.col("cluster") == F.col("own"), F.col("n"))).alias("na"),
        F.min(F.when(F.col("cluster") != F.col("own"), F.col("s") / F.col("n"))).alias("b"))
    sil = F.when((F.col("na") == 0) | F.col("na").isNull(), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    k_per_run = own.groupBy("run").agg(F.count_distinct("own").alias("k"))
    got = per.groupBy("run").agg(F.avg(sil).alias("sil")).join(k_per_run, "run").collect()
    return {r["run"]: (r["sil"] if r["k"] >= 2 else None) for r in got}


def elbow_and_silhouette(df: DataFrame, id_col: str, features: Sequence[str] | None = None, ks: Sequence[int] = range(2, 11),
                         restarts: int = 5, vec_col: str | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Q7 and Q8 of one batched K-Means sweep, with one multi-label block join."""
    spark = df.sparkSession
    table, _, fits, run_id = elbow(df, id_col, features, ks, restarts, vec_col, seed=seed)
    v = vec_frame(df, id_col, features, vec_col).persist(StorageLevel.MEMORY_AND_DISK)
    keys = sorted(run_id, key=lambda key: run_id[key])
    labels = v.select("id", labels_of(F.col("vec"), [fits[run_id[key]][0] for key in keys]).alias("labs"))
    sil = multi_silhouette(v, labels, len(keys))
    rows = []
    for k in ks:
        vals = [sil.get(run_id[(k, r)]) for r in range(restarts)]
        vals = [s for s in vals if s is not None]
        rows.append((int(k), round(float(max(vals)), 6) if vals else -1.0))
    v.unpersist()
    return table.select("k", F.round("inertia", 4).alias("inertia")), spark.createDataFrame(rows, "k int, silhouette double")


def silhouette_curve(df: DataFrame, id_col: str, features: Sequence[str] | None = None, ks: Sequence[int] = range(2, 11),
                     restarts: int = 5, vec_col: str | None = None, seed: int = 42) -> DataFrame:
    """Q8: best silhouette over the restarts of each k (-1 if no run has two labels)."""
    return elbow_and_silhouette(df, id_col, features, ks, restarts, vec_col, seed)[1]


def best_k(curve: DataFrame, metric: str = "silhouette") -> DataFrame:
    """Q11 for partition / hierarchical algorithms: argmax k (first k on ties)."""
    return curve.agg(F.min_by("k", F.struct(-F.col(metric), F.col("k"))).alias("best_k"))


def best_dbscan_params(df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """Q11 for DBSCAN: eps = ascending k-distance at index int(0.9 n) with
    k = min(4, n-1) counting the row itself (the 3rd true neighbour);
    min_samples = min(5, max(2, n // 2))."""
    spark = df.sparkSession
    n = df.count()
    k_true = max(1, min(4, n - 1) - 1)
    kd = k_distances(df, id_col, features, k_true)
    idx = int(0.9 * n)
    eps = order_statistics(kd, "k_dist", [idx])[0]
    ms = min(5, max(2, n // 2))
    return spark.createDataFrame([(None if eps is None else round(eps, 6), int(ms))], "eps double, min_samples int")


def kdistance_curve(df: DataFrame, id_col: str, features: Sequence[str], k: int = 4) -> DataFrame:
    """Q14: (idx, k_dist) in descending order; idx from range-bucketed running
    counts, not a single-partition window."""
    kd = k_distances(df, id_col, features, k).withColumn("one", F.lit(1))
    ranked = running_sums(kd, "k_dist", ["one"], descending=True, tie_cols=[id_col])
    return ranked.select((F.col("cum_one") - 1).cast("bigint").alias("idx"), F.round("k_dist", 6).alias("k_dist"))


def dendrogram_cut_height(linkage: DataFrame, k: int) -> DataFrame:
    """Q13: merge distance at index max(0, m - k + 1) of the step-ordered
    linkage table (m merges); the mean merge distance when out of range."""
    m = linkage.count()
    idx = max(0, m - k + 1)
    at = linkage.where(F.col("step") == idx).select(F.col("dist").alias("h"))
    if idx >= m:
        return linkage.agg(F.avg("dist").alias("cut_height"))
    return at.select(F.col("h").alias("cut_height"))
