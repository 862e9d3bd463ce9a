"""Pairwise distance work as block joins.

Rows are hashed into blocks of bounded size. A (query block, base block)
pair is one ``applyInPandas`` group holding at most two blocks of vectors, so
memory per task is bounded whatever the data size or key skew; the NumPy
kernel computes that block's distance matrix and emits only partial results
(top-k per query, counts within eps, sums per cluster), never the pairs.
The replication factor is the number of blocks on the other side, so the
shuffle is n * blocks rows -- the unavoidable price of exact all-pairs work;
callers offer sampled modes above a row bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import check_metric, distances_for_sums, nearest_pairs, np_distance_matrix, pair_distances, within

DEFAULT_BLOCK_ROWS = 2048
#: Rows of a block where the kernel works through its block in slices: fewer blocks mean fewer copies of every row.
LARGE_BLOCK_ROWS = 8192
#: Cells of the distance matrix of one slice.
SLICE_CELLS = 2_000_000


def _blocks(n: int, block_rows: int) -> int:
    return max(1, math.ceil(n / max(1, block_rows)))


def _large(n: int, block_rows: int | None, spark) -> int:
    """Rows of a block unless the caller names them: enough blocks for every core, at most LARGE_BLOCK_ROWS."""
    if block_rows is not None:
        return block_rows
    sides = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
    return min(LARGE_BLOCK_ROWS, max(DEFAULT_BLOCK_ROWS, math.ceil(n / sides)))


def _slices(n: int, other: int):
    step = max(1, SLICE_CELLS // max(1, other))
    return [slice(s, min(n, s + step)) for s in range(0, n, step)]


def block_join(
    queries: DataFrame,
    base: DataFrame,
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    n_queries: int | None = None,
    n_base: int | None = None,
    by: Sequence[str] = ("id",),
    base_rows: int | None = None,
) -> DataFrame:
    """Run ``kernel(q_pdf, b_pdf)`` on every (query block, base block) pair.
    Rows with equal ``by`` columns share a block.

    ``queries`` and ``base`` must share the columns ``id``, ``vec`` and ``lab``
    (``lab`` may be null); the kernel receives both blocks as pandas frames
    with those columns, base rows sorted by id.
    """
    nq = n_queries if n_queries is not None else queries.count()
    nb = n_base if n_base is not None else base.count()
    qb, bb = _blocks(nq, block_rows), _blocks(nb, base_rows or block_rows)
    cols = ["id", "vec", "lab"]
    q = queries.select(
        *cols, F.pmod(F.xxhash64(*by, F.lit("q")), F.lit(qb)).alias("__qb"),
        F.explode(F.sequence(F.lit(0), F.lit(bb - 1))).alias("__bb"), F.lit(0).alias("__side"),
    )
    b = base.select(
        *cols, F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("__qb"),
        F.pmod(F.xxhash64(*by, F.lit("b")), F.lit(bb)).alias("__bb"), F.lit(1).alias("__side"),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["__side"].to_numpy()
        qp = pdf.loc[side == 0, cols].reset_index(drop=True)
        bp = pdf.loc[side == 1, cols].sort_values("id", kind="stable").reset_index(drop=True)
        if len(qp) == 0 or len(bp) == 0:
            return kernel(qp.iloc[:0], bp.iloc[:0])
        return kernel(qp, bp)

    return q.unionByName(b).groupBy("__qb", "__bb").applyInPandas(run, schema)


def _large_block_join(queries: DataFrame, base: DataFrame, kernel, schema, block_rows: int | None) -> DataFrame:
    """``block_join`` for kernels that go through a block in slices."""
    nq, nb, spark = queries.count(), base.count(), queries.sparkSession
    return block_join(queries, base, kernel, schema, _large(nq, block_rows, spark), nq, nb, base_rows=_large(nb, block_rows, spark))


def _stack(s: pd.Series) -> np.ndarray:
    if len(s) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in s.to_numpy()])


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    metric: str = "euclidean",
    exclude_self: bool = False,
    block_rows: int | None = None,
    lab_type: str = "string",
) -> DataFrame:
    """The k nearest base rows of every query row.

    Output (q_id, b_id, b_lab, dist, rank) with rank 1..k ordered by
    (dist, base id). Two stages: top-k per (query, base block) in the kernel,
    then top-k over the blocks' candidates per query.
    """
    check_metric(metric)
    id_type = dict(queries.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"q_id": [], "b_id": [], "b_lab": [], "dist": []})
        q, b = _stack(qp["vec"]), _stack(bp["vec"])
        qid, bid, blab = qp["id"].to_numpy(), bp["id"].to_numpy(), bp["lab"].to_numpy()
        kk, out = min(k, len(b)), []
        for sl in _slices(len(q), len(b)):
            same = qid[sl, None] == bid[None, :] if exclude_self else None
            got = nearest_pairs(q[sl], b, kk, same) if metric == "euclidean" else None
            if got is None:
                d = np_distance_matrix(q[sl], b, metric)
                if exclude_self:
                    d = np.where(same, np.inf, d)
                order = np.argsort(d, axis=1, kind="stable")[:, :kk]  # base sorted by id: ties by id
                rows = np.repeat(np.arange(d.shape[0]), kk)
                cols = order.ravel()
                got = rows, cols, d[rows, cols]
            rows, cols, dist = got
            keep = np.isfinite(dist)
            out.append((qid[sl][rows[keep]], bid[cols[keep]], blab[cols[keep]], dist[keep]))
        return pd.DataFrame({c: np.concatenate(v) for c, v in zip(("q_id", "b_id", "b_lab", "dist"), zip(*out))})

    schema = f"q_id {id_type}, b_id {id_type}, b_lab {lab_type}, dist double"
    part = _large_block_join(queries, base, kernel, schema, block_rows)
    w = Window.partitionBy("q_id").orderBy("dist", "b_id")
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def cluster_distance_sums(df: DataFrame, base: DataFrame | None = None, block_rows: int | None = None,
                          squared: bool = False) -> DataFrame:
    """Per (query row, cluster): sum of distances to that cluster's base rows
    and their count (self excluded). Columns id, vec, lab (cluster); the base
    defaults to the queries themselves."""
    base = df if base is None else base
    id_type = dict(df.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"id": [], "cluster": [], "s": [], "n": []})
        q, labs = _stack(qp["vec"]), bp["lab"].to_numpy()
        order = np.argsort(labs, kind="stable")
        b, bid, labs, qid = _stack(bp["vec"])[order], bp["id"].to_numpy()[order], labs[order], qp["id"].to_numpy()
        names, start = np.unique(labs, return_index=True)
        size, out = np.diff(np.append(start, len(labs))), []
        known = ~pd.isna(names)
        for sl in _slices(len(q), len(b)):
            d = np_distance_matrix(q[sl], b, "sqeuclidean") if squared else distances_for_sums(q[sl], b)
            s = np.add.reduceat(d, start, axis=1)
            i, j = np.nonzero(qid[sl, None] == bid[None, :])
            n = np.repeat(size[None, :], len(d), axis=0)
            np.subtract.at(n, (i, np.searchsorted(start, j, "right") - 1), 1)
            s[:, ~known], n[:, ~known] = 0.0, 0
            out.append(pd.DataFrame({"id": np.repeat(qid[sl], len(names)), "cluster": np.tile(names, len(d)), "s": s.ravel(), "n": n.ravel()}))
        return pd.concat(out, ignore_index=True)

    part = _large_block_join(df, base, kernel, f"id {id_type}, cluster bigint, s double, n bigint", block_rows)
    return part.groupBy("id", "cluster").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def _close(q: np.ndarray, b: np.ndarray, eps: float, metric: str) -> np.ndarray:
    return within(q, b, eps) if metric == "euclidean" else np_distance_matrix(q, b, metric) <= eps


def eps_neighbour_counts(df: DataFrame, eps: float, metric: str = "euclidean",
                         block_rows: int | None = None) -> DataFrame:
    """J3 (dense fallback): per row, the number of rows within eps (self included). In one or two dimensions from k-d leaves."""
    from . import plane

    if block_rows is None and metric == "euclidean" and eps >= 0 and plane.fits(df, "id", "vec"):
        rows = df.select("id", *plane.places("vec"))
        return rows.join(plane.within_counts(rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("m")), eps), ["x", "y"]).select("id", "n")
    id_type = dict(df.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"id": [], "n": []})
        q, b = _stack(qp["vec"]), _stack(bp["vec"])
        n = [_close(q[sl], b, eps, metric).sum(axis=1) for sl in _slices(len(q), len(b))]
        return pd.DataFrame({"id": qp["id"].to_numpy(), "n": np.concatenate(n)})

    part = _large_block_join(df, df, kernel, f"id {id_type}, n bigint", block_rows)
    return part.groupBy("id").agg(F.sum("n").alias("n"))


def eps_edges(queries: DataFrame, base: DataFrame, eps: float, metric: str = "euclidean",
              block_rows: int | None = None) -> DataFrame:
    """Pairs within eps between two row sets, for callers whose query rows have
    few of them (DBSCAN's border rows)."""
    id_type = dict(queries.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"a": [], "b": [], "dist": []})
        q, b = _stack(qp["vec"]), _stack(bp["vec"])
        out = []
        for sl in _slices(len(q), len(b)):
            i, j = np.nonzero(_close(q[sl], b, eps, metric))
            dist = pair_distances(q[sl], b, i, j) if metric == "euclidean" else np_distance_matrix(q[sl], b, metric)[i, j]
            out.append(pd.DataFrame({"a": qp["id"].to_numpy()[sl][i], "b": bp["id"].to_numpy()[j], "dist": dist}))
        return pd.concat(out, ignore_index=True)

    return _large_block_join(queries, base, kernel, f"a {id_type}, b {id_type}, dist double", block_rows)


def eps_links(df: DataFrame, eps: float, metric: str = "euclidean", block_rows: int | None = None) -> DataFrame:
    """Pairs (a, b) that tie together what the pairs within eps tie together: a
    pair of blocks yields a star for each of its own components, so a row is
    named at most once per block, however dense the rows are."""
    id_type = dict(df.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"a": [], "b": []})
        q, b = _stack(qp["vec"]), _stack(bp["vec"])
        qid, bid = qp["id"].to_numpy(), bp["id"].to_numpy()
        lab, met = np.arange(len(b)), np.full(len(q), -1)  # component of each base row: its first row
        for sl in _slices(len(q), len(b)):
            close = _close(q[sl], b, eps, metric)
            low, high = np.where(close, lab, len(b)).min(axis=1), np.where(close, lab, -1).max(axis=1)
            met[sl] = np.where(high >= 0, close.argmax(axis=1), -1)
            for i in np.flatnonzero(low < high):
                some = np.unique(lab[close[i]])
                if len(some) > 1:
                    lab[np.isin(lab, some)] = some[0]
        i, j = np.flatnonzero(met >= 0), np.flatnonzero(lab != np.arange(len(b)))
        return pd.DataFrame({"a": np.concatenate([bid[lab[met[i]]], bid[lab[j]]]), "b": np.concatenate([qid[i], bid[j]])})

    links = _large_block_join(df, df, kernel, f"a {id_type}, b {id_type}", block_rows)
    return links.where(F.col("a") != F.col("b")).distinct()


def closest_pairs(df: DataFrame, n: int, metric: str = "euclidean", block_rows: int | None = None) -> DataFrame:
    """J2 bare form, bounded: the n closest pairs (a < b). Every pair of the
    global top n is among the n nearest neighbours of both its rows, so the
    top-n join output (rows x n) holds them all."""
    nn = knn_join(df, df, n, metric, exclude_self=True, block_rows=block_rows)
    pairs = nn.select(F.least("q_id", "b_id").alias("a"), F.greatest("q_id", "b_id").alias("b"), "dist").distinct()
    return pairs.orderBy("dist", "a", "b").limit(n)
