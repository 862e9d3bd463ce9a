"""K-Medoids by alternating assignment and medoid update (Voronoi iteration).

Assignment is a projection over the k broadcast medoids. The update scores
candidate medoids per cluster: ``exact`` scores every member, by the sums over
k-d leaves in one or two dimensions under the euclidean metric, else through
the block join, which computes all pairs of two blocks and keeps those of one
cluster (bounded memory per task); ``sample`` scores a seeded sample of s
members plus the current medoid against every member in one pass (CLARA
idea), for large clusters. The caller chooses; the row count switches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import distance, nearest_center, np_distance_matrix
from . import plane
from .kmeans import kmeanspp_init, vec_frame
from .pairs import DEFAULT_BLOCK_ROWS, _stack, block_join


@dataclass
class KMedoidsResult:
    labels: DataFrame
    medoid_ids: list
    medoids: np.ndarray
    inertia: float
    n_iter: int


def _member_costs_exact(v: DataFrame, labels_col, metric: str, block_rows: int) -> DataFrame:
    """(id, cluster, cost) with cost = sum of distances to same-cluster rows."""
    x = v.select("id", "vec", labels_col.cast("string").alias("lab"))
    id_type = dict(x.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"id": [], "cost": []})
        d = np_distance_matrix(_stack(qp["vec"]), _stack(bp["vec"]), metric)
        same = qp["lab"].to_numpy()[:, None] == bp["lab"].to_numpy()[None, :]
        return pd.DataFrame({"id": qp["id"].to_numpy(), "cost": np.where(same, d, 0.0).sum(axis=1)})

    part = block_join(x, x, kernel, f"id {id_type}, cost double", block_rows)
    costs = part.groupBy("id").agg(F.sum("cost").alias("cost"))
    return costs.join(x.select("id", F.col("lab").cast("int").alias("cluster")), "id")


def _member_costs_leaves(at: DataFrame, leaves: plane.Leaves, medoids: np.ndarray) -> DataFrame:
    """(id, cluster, cost) of the rows that can be the medoid of their cluster, in one or two dimensions: every member's
    cost is summed through the leaves, those of the least ones row by row."""
    centres = np.zeros((len(medoids), 2))
    centres[:, :medoids.shape[1]] = medoids

    def label(xy: np.ndarray) -> np.ndarray:
        return np.sqrt((xy[:, :1] - centres[:, 0]) ** 2 + (xy[:, 1:] - centres[:, 1]) ** 2).argmin(1)

    got = plane.cheapest(plane.relabelled(leaves, label, len(medoids)))
    best = at.sparkSession.createDataFrame(got, "cluster int, cost double, x double, y double")
    return at.join(F.broadcast(best), ["x", "y"]).select("id", "cluster", "cost")


def _member_costs_sample(v: DataFrame, labels_col, ids: list, medoids: np.ndarray, metric: str, s: int, seed: int, it: int):
    """Candidates: s seeded members per cluster, drawn anew each iteration, plus the current medoid."""
    lab = v.select("id", "vec", labels_col.alias("cluster"))
    ranked = lab.withColumn("__o", F.xxhash64("id", F.lit(f"{seed}|{it}")))
    from pyspark.sql import Window

    w = Window.partitionBy("cluster").orderBy("__o", "id")
    cand = ranked.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= s).select(
        "cluster", F.col("id").alias("cid"), F.col("vec").alias("cvec")).collect()
    cands: dict = {c: {i: m} for c, (i, m) in enumerate(zip(ids, medoids))}
    for r in cand:
        cands[r["cluster"]].setdefault(r["cid"], r["cvec"])
    parts = []
    for cl, lst in cands.items():
        for cid, cvec in lst.items():
            parts.append(F.when(F.col("cluster") == cl, F.struct(
                F.lit(cid).alias("cid"), distance(F.col("vec"), F.array(*[F.lit(float(x)) for x in cvec]), metric).alias("d"))))
    ex = lab.select("cluster", F.explode(F.filter(F.array(*parts), lambda z: z.isNotNull())).alias("z"))
    return ex.groupBy("cluster", F.col("z.cid").alias("id")).agg(F.sum("z.d").alias("cost"))


def kmedoids(df: DataFrame, id_col: str, features: Sequence[str] | None = None, k: int = 3,
             vec_col: str | None = None, metric: str = "euclidean", max_iter: int = 300, seed: int = 42,
             init=None, mode: str = "exact", sample_size: int = 64,
             block_rows: int = DEFAULT_BLOCK_ROWS) -> KMedoidsResult:
    """C4: assign to the nearest medoid; each medoid becomes the member with
    the least total distance to its cluster (first id on ties); stop when
    the medoids do not change; an empty cluster keeps its medoid. Inertia is
    the sum of plain distances. ``init``: explicit medoid ids, else
    k-medoids++ (D^2 weighting under ``metric``). In mode 'sample' a medoid is
    only replaced by a strictly better candidate, so the cost never rises and
    the iteration ends when no sample holds one."""
    if mode not in ("exact", "sample"):
        raise ValueError("mode must be 'exact' or 'sample'")
    v = vec_frame(df, id_col, features, vec_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if init is None:
            start = kmeanspp_init(v, {0: (k, seed)}, metric)[0]
            ids = _ids_of(v, start)
        else:
            ids = list(init)
        med = _vecs_of(v, ids)
        leaves = None
        if mode == "exact" and metric == "euclidean" and plane.fits(v, "id", "vec"):
            at = v.select("id", *plane.places("vec"))
            leaves = plane.plant(at.groupBy("x", "y").agg(F.count(F.lit(1)).alias("m")).withColumn("labs", F.array().cast("array<bigint>")))
        it = 0
        for it in range(1, max_iter + 1):
            lab = nearest_center(F.col("vec"), med, metric)["idx"]
            if leaves is not None:
                costs = _member_costs_leaves(at, leaves, med)
            elif mode == "exact":
                costs = _member_costs_exact(v, lab, metric, block_rows)
            else:
                costs = _member_costs_sample(v, lab, ids, med, metric, sample_size, seed, it)
                now = F.element_at(F.array(*[F.lit(i) for i in ids]), F.col("cluster") + 1)
                costs = costs.select("cluster", "id", "cost", (F.col("id") != now).cast("int").alias("other"))
            # equal costs: the first id, in mode 'sample' the current medoid
            order = ("cost", "id") if mode == "exact" else ("cost", "other", "id")
            best = costs.groupBy("cluster").agg(F.min(F.struct(*order)).alias("b")).collect()
            new_ids = list(ids)
            for r in best:
                new_ids[int(r["cluster"])] = r["b"]["id"]
            if new_ids == ids:
                break
            ids = new_ids
            med = _vecs_of(v, ids)
        lab = nearest_center(F.col("vec"), med, metric)
        inertia = v.agg(F.sum(lab["dist"]).alias("i")).first()["i"]
        labels = v.select(F.col("id").alias(id_col), lab["idx"].cast("int").alias("cluster"))
        return KMedoidsResult(labels, ids, med, float(inertia), it)
    finally:
        v.unpersist()


def _ids_of(v: DataFrame, vecs: np.ndarray) -> list:
    """Row ids of given centre vectors (the rows they were drawn from)."""
    out = []
    for row in vecs:
        cond = F.col("vec") == F.array(*[F.lit(float(x)) for x in row])
        got = v.where(cond).agg(F.min("id").alias("id")).first()["id"]
        out.append(got)
    return out


def _vecs_of(v: DataFrame, ids: list) -> np.ndarray:
    got = {r["id"]: r["vec"] for r in v.where(F.col("id").isin(ids)).select("id", "vec").collect()}
    return np.array([got[i] for i in ids], dtype=np.float64)
