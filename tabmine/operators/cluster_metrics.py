"""Internal cluster quality: count, inertia, silhouette (exact / sampled /
squared), Calinski-Harabasz and Davies-Bouldin. Centroid work is one
``groupBy(cluster)`` per pass; centroid tables reach the driver only below ``BROADCAST_CELLS``."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import plane
from .pairs import DEFAULT_BLOCK_ROWS, block_join, cluster_distance_sums

#: Numbers of a centroid table that goes to every task; a larger one is joined by shuffle.
BROADCAST_CELLS = 1_000_000


def _dims(df: DataFrame, vec: str) -> int:
    return len(df.select(vec).first()[0])


def n_clusters(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Q1: distinct labels other than -1."""
    return df.agg(F.count_distinct(F.when(F.col(cluster) != -1, F.col(cluster))).cast("bigint").alias("n_clusters"))


def centroids(df: DataFrame, vec: str, cluster: str, d: int, include_noise: bool = True) -> DataFrame:
    src = df if include_noise else df.where(F.col(cluster) != -1)
    return src.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(d)])


def inertia(df: DataFrame, vec: str = "vec", cluster: str = "cluster") -> DataFrame:
    """Q2: sum of squared distances to the label mean, labels >= 0 only,
    as per-cluster population variance x count summed over dimensions."""
    d = _dims(df, vec)
    g = df.where(F.col(cluster) >= 0).groupBy(cluster).agg(
        *[(F.var_pop(F.col(vec)[i]) * F.count(F.lit(1))).alias(f"w{i}") for i in range(d)])
    total = sum((F.col(f"w{i}") for i in range(1, d)), F.col("w0"))
    return g.agg(F.coalesce(F.sum(total), F.lit(0.0)).alias("inertia"))


def _few(k: int, d: int) -> bool:
    """A table of k centroids may be broadcast."""
    return k * d <= BROADCAST_CELLS


def calinski_harabasz(df: DataFrame, vec: str = "vec", cluster: str = "cluster") -> DataFrame:
    """Q4: [tr(B)/(k-1)] / [tr(W)/(n-k)], 1.0 when W = 0; noise is a cluster.
    Aggregates of the per-cluster table; only sums over it reach the driver."""
    spark = df.sparkSession
    d = _dims(df, vec)
    per = cut_lineage(df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(d)],
        *[(F.var_pop(F.col(vec)[i]) * F.count(F.lit(1))).alias(f"w{i}") for i in range(d)]))
    t = per.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
                *[F.sum(F.col("n") * F.col(f"m{i}")).alias(f"m{i}") for i in range(d)],
                *[F.sum(f"w{i}").alias(f"w{i}") for i in range(d)]).first()
    n, k = t["n"], t["k"]
    if k < 2 or k >= n:
        val = None
    else:
        trw = float(sum(t[f"w{i}"] for i in range(d)))
        off = [F.col(f"m{i}") - F.lit(t[f"m{i}"] / n) for i in range(d)]
        trb = per.agg(F.sum(F.col("n") * sum((o * o for o in off[1:]), off[0] * off[0])).alias("b")).first()["b"]
        val = 1.0 if trw == 0 else float((trb / (k - 1)) / (trw / (n - k)))
    return spark.createDataFrame([(val,)], "calinski_harabasz double")


def davies_bouldin(df: DataFrame, vec: str = "vec", cluster: str = "cluster",
                   block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Q5: mean over clusters of max_j (s_i + s_j) / d(c_i, c_j), s = mean
    distance of members to their centroid; noise is a cluster. Rows are joined
    to the centroid table by cluster; a block join of that table with itself
    gives the maxima, so any number of clusters fits."""
    spark = df.sparkSession
    d = _dims(df, vec)
    # stored: both sides of the block join must see the same last bits
    cen = cut_lineage(centroids(df, vec, cluster, d).select(
        F.col("cluster").alias("id"), F.array(*[F.col(f"m{i}") for i in range(d)]).alias("c")))
    k = cen.count()
    if k < 2:
        return spark.createDataFrame([(None,)], "davies_bouldin double")
    rows = df.select(F.col(cluster).alias("__own"), F.col(vec).alias("__x"))
    j = rows.join(F.broadcast(cen) if _few(k, d) else cen, F.col("__own").eqNullSafe(F.col("id")))
    dist = F.sqrt(F.aggregate(F.zip_with("__x", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    s = j.groupBy("__own").agg(F.avg(dist).alias("lab"))
    c = cut_lineage(cen.join(s, F.col("id").eqNullSafe(F.col("__own"))).select("id", F.col("c").alias("vec"), "lab"))

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"id": [], "r": []})
        a, b = np.stack(qp["vec"].to_numpy()), np.stack(bp["vec"].to_numpy())
        d2 = np.zeros((len(a), len(b)))
        for i in range(a.shape[1]):
            d2 += (a[:, i, None] - b[None, :, i]) ** 2
        cd = np.sqrt(d2)
        cd[cd == 0] = np.inf  # coincident centroids (and the diagonal) score 0
        r = (qp["lab"].to_numpy()[:, None] + bp["lab"].to_numpy()[None, :]) / cd
        return pd.DataFrame({"id": qp["id"].to_numpy(), "r": r.max(axis=1)})

    part = block_join(c, c, kernel, f"id {dict(c.dtypes)['id']}, r double", block_rows, k, k)
    return part.groupBy("id").agg(F.max("r").alias("r")).agg(
        F.avg(F.coalesce("r", F.lit(float("nan")))).alias("davies_bouldin"))


def silhouette_rows(df: DataFrame, id_col: str = "id", vec: str = "vec", cluster: str = "cluster",
                    block_rows: int | None = None, queries: DataFrame | None = None) -> DataFrame:
    """Per-row silhouette from the block join's (row, cluster) distance sums;
    a row alone in its cluster scores 0. ``queries`` restricts the rows scored
    (sampled mode); distances always run against every row."""
    x = df.select(F.col(id_col).alias("id"), F.col(vec).alias("vec"), F.col(cluster).cast("bigint").alias("lab"))
    q = x if queries is None else queries.select(
        F.col(id_col).alias("id"), F.col(vec).alias("vec"), F.col(cluster).cast("bigint").alias("lab"))
    sums = cluster_distance_sums(q, x, block_rows)
    own = q.select("id", F.col("lab").alias("own"))
    per = sums.join(own, "id").groupBy("id", "own").agg(
        F.max(F.when(F.col("cluster") == F.col("own"), F.col("s") / F.col("n"))).alias("a"),
        F.max(F.when(F.col("cluster") == F.col("own"), F.col("n"))).alias("na"),
        F.min(F.when(F.col("cluster") != F.col("own"), F.col("s") / F.col("n"))).alias("b"),
    )
    sil = F.when((F.col("na") == 0) | F.col("na").isNull(), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.select(F.col("id").alias(id_col), F.col("own").alias(cluster), sil.alias("silhouette"))


def silhouette(df: DataFrame, id_col: str = "id", vec: str = "vec", cluster: str = "cluster",
               mode: str = "exact", sample_rows: int = 1000, seed: int = 42,
               block_rows: int | None = None) -> DataFrame:
    """Q3. ``exact``: mean over all rows (k-d leaves in one or two dimensions,
    else block join, O(n^2) distances);
    ``sample``: exact silhouettes of a seeded sample of rows against all rows;
    ``squared``: closed form on squared distances from per-cluster
    (n, sum, sum of squares) -- the metric Spark's ClusteringEvaluator uses.
    Noise (-1) counts as a cluster. Needs 2 <= k < n, else null."""
    spark = df.sparkSession
    k_n = df.agg(F.count_distinct(cluster).alias("k"), F.count(F.lit(1)).alias("n")).first()
    if not (2 <= k_n["k"] < k_n["n"]):
        return spark.createDataFrame([(None, mode)], "silhouette double, mode string")
    if mode == "squared":
        return _silhouette_squared(df, id_col, vec, cluster, block_rows or DEFAULT_BLOCK_ROWS)
    if mode == "exact":
        if plane.fits(df, id_col, vec, F.col(cluster).isNotNull()):
            got = plane.silhouettes(df.select(*plane.places(vec), F.array(F.col(cluster).cast("bigint")).alias("labs")), 1)
            if got is not None:
                return spark.createDataFrame([(got[0], mode)], "silhouette double, mode string")
        rows = silhouette_rows(df, id_col, vec, cluster, block_rows)
    elif mode == "sample":
        q = df.withColumn("__o", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))).orderBy(
            "__o", id_col).limit(sample_rows).drop("__o")
        rows = silhouette_rows(df, id_col, vec, cluster, block_rows, queries=q)
    else:
        raise ValueError("mode must be exact, sample or squared")
    return rows.agg(F.avg("silhouette").alias("silhouette")).withColumn("mode", F.lit(mode))


def _squared_parts(x: np.ndarray, own: np.ndarray, mean: np.ndarray, q: np.ndarray, n: np.ndarray):
    """(own mean squared distance without the row itself, least one of the other
    clusters) of each row against one list of clusters; ``own`` is the row's
    place in it or -1. NaN / inf where the list does not hold it."""
    m = (x * x).sum(1)[:, None] - 2 * x @ mean.T + q  # mean squared distance to every cluster
    at = np.flatnonzero(own >= 0)
    o = own[at]
    a = np.full(len(x), np.nan)
    a[at] = m[at, o] * n[o] / np.maximum(n[o] - 1, 1)
    m[at, o] = np.inf
    return a, m.min(1)


def _silhouette_squared(df: DataFrame, id_col: str, vec: str, cluster: str,
                        block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Squared-euclidean silhouette in closed form: mean squared distance from
    x to cluster C = ||x||^2 - 2 x.mu_C + mean_C ||y||^2. A cluster table of
    bounded size goes with the tasks, a larger one meets the rows in a block join."""
    d = _dims(df, vec)
    g = cut_lineage(df.groupBy(F.col(cluster).alias("c")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(d)],
        F.avg(F.aggregate(F.col(vec), F.lit(0.0), lambda s, v: s + v * v)).alias("q"),
    ))
    k = g.count()
    if not _few(k, d):
        return _silhouette_squared_join(df, id_col, vec, cluster, g, k, d, block_rows)
    g = g.collect()
    place = {r["c"]: i for i, r in enumerate(g)}
    mean = np.array([[r[f"m{i}"] for i in range(d)] for r in g], np.float64)
    q, n = np.array([r["q"] for r in g], np.float64), np.array([r["n"] for r in g], np.float64)
    step = max(1, block_rows * block_rows // k)  # bounds the rows x clusters matrix

    @F.pandas_udf("double")
    def rows(v: pd.Series, c: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=float)
        x = np.array(v.tolist(), np.float64)
        own = c.map(place).to_numpy()
        parts = [_squared_parts(x[i:i + step], own[i:i + step], mean, q, n) for i in range(0, len(x), step)]
        a, b = (np.concatenate(p) for p in zip(*parts))
        return pd.Series(np.where(n[own] <= 1, 0.0, (b - a) / np.maximum(a, b)))

    return df.select(
        rows(F.col(vec), F.col(cluster)).alias("s")).agg(F.avg("s").alias("silhouette")).withColumn("mode", F.lit("squared"))


def _silhouette_squared_join(df: DataFrame, id_col: str, vec: str, cluster: str, g: DataFrame, k: int, d: int,
                             block_rows: int) -> DataFrame:
    """The same with the cluster table dealt into blocks: a row meets every block
    and keeps its own cluster's part and the least of the others."""
    x = df.select(F.col(id_col).cast("string").alias("id"), F.col(vec).cast("array<double>").alias("vec"),
                  F.col(cluster).cast("string").alias("lab"))
    base = g.select(F.col("c").cast("string").alias("id"),
                    F.array(*[F.col(f"m{i}") for i in range(d)], "q", F.col("n").cast("double")).alias("vec"),
                    F.lit(None).cast("string").alias("lab"))

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0 or len(bp) == 0:
            return pd.DataFrame({"id": [], "a": [], "na": [], "b": []})
        v, c = np.stack(qp["vec"].to_numpy()), np.stack(bp["vec"].to_numpy())
        mean, q, n = c[:, :d], c[:, d], c[:, d + 1]
        place = {key: i for i, key in enumerate(bp["id"])}
        own = np.array([place.get(key, -1) for key in qp["lab"]])
        a, b = _squared_parts(v, own, mean, q, n)
        return pd.DataFrame({"id": qp["id"], "a": a, "na": np.where(own >= 0, n[own], np.nan), "b": b})

    part = block_join(x, base, kernel, "id string, a double, na double, b double", block_rows, n_base=k)
    per = part.groupBy("id").agg(F.max("a").alias("a"), F.max("na").alias("na"), F.min("b").alias("b"))
    sil = F.when(F.col("na") <= 1, F.lit(0.0)).otherwise(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return per.agg(F.avg(F.coalesce(sil, F.lit(float("nan")))).alias("silhouette")).withColumn("mode", F.lit("squared"))


def cluster_metrics(df: DataFrame, id_col: str = "id", vec: str = "vec", cluster: str = "cluster",
                    silhouette_mode: str = "exact") -> DataFrame:
    """Q6: all four metrics in one row (null when k is too small)."""
    spark = df.sparkSession
    k = n_clusters(df, cluster).first()["n_clusters"]
    ine = inertia(df, vec, cluster).first()["inertia"]
    sil = silhouette(df, id_col, vec, cluster, silhouette_mode).first()["silhouette"]
    ch = calinski_harabasz(df, vec, cluster).first()["calinski_harabasz"]
    db = davies_bouldin(df, vec, cluster).first()["davies_bouldin"]
    return spark.createDataFrame([(int(k), ine, sil, ch, db)],
                                 "n_clusters bigint, inertia double, silhouette double, calinski_harabasz double, "
                                 "davies_bouldin double")


def _finite(v):
    return v if v is not None and math.isfinite(v) else None
