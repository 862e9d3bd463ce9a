"""DBSCAN as joins and connected components.

Low dimensions (d <= 3): grid of side eps/sqrt(d) (Gan & Tao 2015). Every
cell has diameter <= eps, so a cell holding >= min_samples rows is all core
and internally connected; only rows of sparse cells need neighbour counts,
and only pairs of neighbouring core *cells* need a connectivity test. Joins
against a cell are salted by chunks of at most ``chunk_rows`` rows, so a cell
holding a third of the data is spread over many tasks.

Higher dimensions: neighbour counts and core-core links come from the block
join (bounded memory per task); a pair of blocks yields stars over its own
components, not every core-core pair.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import distance
from .components import connected_components
from .pairs import eps_edges, eps_links, eps_neighbour_counts

CHUNK_ROWS = 4096


def _offsets(d: int) -> list[tuple[int, ...]]:
    r = math.ceil(math.sqrt(d))
    out = []
    for o in itertools.product(range(-r, r + 1), repeat=d):
        gap = math.sqrt(sum(max(abs(v) - 1, 0) ** 2 for v in o)) / math.sqrt(d)
        if gap <= 1.0 + 1e-12:
            out.append(o)
    return out


def _cell_plus(cell, o):
    return F.array(*[cell[i] + F.lit(v) for i, v in enumerate(o)])


def _neighbour_rows(src: DataFrame, targets: DataFrame, offsets, chunk_rows: int) -> DataFrame:
    """Pairs (src row, target row in a neighbouring cell), joined on
    (cell, salt) with the target cells split into chunks."""
    tcount = targets.groupBy("cell").agg(F.count(F.lit(1)).alias("tn"))
    salted_t = targets.join(tcount, "cell").withColumn(
        "salt", F.pmod(F.xxhash64("id"), F.ceil(F.col("tn") / F.lit(chunk_rows)).cast("bigint")))
    off = F.array(*[F.array(*[F.lit(v) for v in o]) for o in offsets])
    s = src.select("*", F.explode(off).alias("__o"))
    s = s.withColumn("tcell", F.transform(F.col("cell"), lambda x, i: x + F.col("__o")[i])).drop("__o")
    s = s.join(tcount.withColumnRenamed("cell", "tcell"), "tcell").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.ceil(F.col("tn") / F.lit(chunk_rows)).cast("bigint") - 1))).drop("tn")
    t = salted_t.select(F.col("cell").alias("tcell"), "salt", F.col("id").alias("t_id"), F.col("vec").alias("t_vec"),
                        *[F.col(x).alias(f"t_{x}") for x in targets.columns if x not in ("cell", "id", "vec")])
    return s.join(t, ["tcell", "salt"])


def dbscan(df: DataFrame, id_col: str, features: Sequence[str], eps: float = 0.5, min_samples: int = 5,
           order_col: str | None = None, border: str = "textbook", chunk_rows: int = CHUNK_ROWS,
           max_grid_dims: int = 3) -> DataFrame:
    """C6 / C6b. Returns (id, cluster, is_core); noise is -1. Clusters are
    numbered by their first core row in ``order_col`` order (default id);
    a border row joins the earliest cluster it touches. ``border='reference'``
    reproduces the reference's quirk: a border row ordered before a cluster's
    start core joins it only when it neighbours that start core."""
    if eps <= 0:
        raise ValueError("eps must be > 0")
    if border not in ("textbook", "reference"):
        raise ValueError("border must be 'textbook' or 'reference'")
    d = len(features)
    order_col = order_col or id_col
    pts = df.select(F.col(id_col).alias("id"), F.array(*[F.col(f).cast("double") for f in features]).alias("vec"),
                    F.col(order_col).alias("ord"))
    if d <= max_grid_dims:
        core, edges = _grid_core(pts, eps, min_samples, d, chunk_rows)
    else:
        core, edges = _block_core(pts, eps, min_samples)
    # core: id, vec, ord, cell (grid) or cell = id, is_core ; edges between cells (a, b)
    core = core.cache()
    core = core.withColumn("ckey", _key(F.col("cell")) if d <= max_grid_dims else F.col("cell"))
    core_pts = core.where("is_core")
    cells = core_pts.select(F.col("ckey").alias("id")).distinct()
    comp = connected_components(cells, edges)
    cp = core_pts.join(comp.withColumnRenamed("id", "ckey"), "ckey")
    start = cp.groupBy("comp").agg(F.min(F.struct("ord", "id", "vec")).alias("s"))
    start = _number_clusters(start)
    cp = cp.join(start.select("comp", "cluster"), "comp")
    core_lab = cp.select("id", "cluster", F.lit(True).alias("is_core"))
    # border rows: non-core rows with a core neighbour
    nonc = core.where(~F.col("is_core")).select("id", "vec", "ord", "cell")
    targets = cp.join(start.select("cluster", F.col("s.ord").alias("s_ord"), F.col("s.vec").alias("s_vec")), "cluster")
    targets = targets.select("id", "vec", "cell", "cluster", "s_ord", "s_vec")
    if d <= max_grid_dims:
        pairs = _neighbour_rows(nonc, targets, _offsets(d), chunk_rows)
    else:
        pairs = nonc.join(edges_rows_for_border(nonc, targets, eps), "id")
    dd = d if d <= 16 else None
    within = distance(F.col("vec"), F.col("t_vec"), dims=dd) <= F.lit(eps)
    ok = within
    if border == "reference":
        ok = within & ((F.col("ord") > F.col("t_s_ord")) | (distance(F.col("vec"), F.col("t_s_vec"), dims=dd) <= F.lit(eps)))
    bl = pairs.where(ok).groupBy("id").agg(F.min("t_cluster").alias("cluster"))
    nonc_lab = nonc.select("id").join(bl, "id", "left").select(
        "id", F.coalesce("cluster", F.lit(-1)).cast("int").alias("cluster"), F.lit(False).alias("is_core"))
    return core_lab.unionByName(nonc_lab).withColumnRenamed("id", id_col)


def _number_clusters(start: DataFrame) -> DataFrame:
    """cluster = rank of the start core's (ord, id) among all clusters, from
    range-partitioned running counts (no global single-partition window over a
    cluster table that can grow with n)."""
    from ..functions.ordered import row_index

    flat = start.select("comp", "s", F.col("s.ord").alias("s_ord"), F.col("s.id").alias("s_id"))
    ranked = row_index(flat, ["s_ord", "s_id"], "cluster")
    return ranked.select("comp", "s", F.col("cluster").cast("int").alias("cluster"))


def edges_rows_for_border(nonc: DataFrame, targets: DataFrame, eps: float) -> DataFrame:
    """High-d border candidates: block join of non-core rows against core rows."""
    q = nonc.select("id", "vec", F.lit(None).cast("string").alias("lab"))
    b = targets.select("id", "vec", F.lit(None).cast("string").alias("lab"))
    e = eps_edges(q, b, eps)
    t = targets.select(F.col("id").alias("b"), F.col("vec").alias("t_vec"), F.col("cluster").alias("t_cluster"),
                       F.col("s_ord").alias("t_s_ord"), F.col("s_vec").alias("t_s_vec"))
    return e.join(t, "b").select(F.col("a").alias("id"), "t_vec", "t_cluster", "t_s_ord", "t_s_vec")


def _grid_core(pts: DataFrame, eps: float, min_samples: int, d: int, chunk_rows: int):
    side = eps / math.sqrt(d)
    offsets = _offsets(d)
    g = pts.withColumn("cell", F.transform("vec", lambda x: F.floor(x / F.lit(side)).cast("bigint")))
    cnt = g.groupBy("cell").agg(F.count(F.lit(1)).alias("cn"))
    g = g.join(cnt, "cell")
    dense = g.where(F.col("cn") >= min_samples)
    sparse = g.where(F.col("cn") < min_samples).select("id", "vec", "ord", "cell")
    pairs = _neighbour_rows(sparse, g.select("id", "vec", "cell"), offsets, chunk_rows)
    nc = pairs.where(distance(F.col("vec"), F.col("t_vec"), dims=d) <= F.lit(eps)).groupBy("id").agg(
        F.count(F.lit(1)).alias("nn"))
    sp = sparse.join(nc, "id", "left").select("id", "vec", "ord", "cell",
                                              (F.coalesce("nn", F.lit(0)) >= min_samples).alias("is_core"))
    core = dense.select("id", "vec", "ord", "cell", F.lit(True).alias("is_core")).unionByName(sp)
    core = core.cache()
    edges = _core_cell_edges(core.where("is_core"), eps, offsets, chunk_rows)
    return core, edges


def _core_cell_edges(cp: DataFrame, eps: float, offsets, chunk_rows: int) -> DataFrame:
    """Links between neighbouring core cells that hold a pair of core rows
    within eps. Each (cell pair, chunk pair) group is bounded; the kernel
    returns at most one row per group."""
    cc = cp.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk_rows)).cast("bigint").alias("chunks"))
    p = cp.join(cc, "cell").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    nz = [o for o in offsets if any(o)]
    off = F.array(*[F.array(*[F.lit(v) for v in o]) for o in nz])
    x = p.select("id", "vec", "cell", "chunk", F.explode(off).alias("__o"))
    x = x.withColumn("other", F.transform("cell", lambda v, i: v + F.col("__o")[i])).drop("__o")
    x = x.join(cc.select(F.col("cell").alias("other"), F.col("chunks").alias("ochunks")), "other")
    x = x.select(
        "id", "vec",
        F.least("cell", "other").alias("ca"), F.greatest("cell", "other").alias("cb"),
        (F.col("cell") < F.col("other")).alias("is_a"), "chunk",
        F.explode(F.sequence(F.lit(0), F.col("ochunks") - 1)).alias("ochunk"),
    )
    x = x.select("id", "vec", "ca", "cb", "is_a",
                 F.when(F.col("is_a"), F.col("chunk")).otherwise(F.col("ochunk")).alias("ka"),
                 F.when(F.col("is_a"), F.col("ochunk")).otherwise(F.col("chunk")).alias("kb"))

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        a = pdf[pdf["is_a"]]
        b = pdf[~pdf["is_a"]]
        if len(a) and len(b):
            va = np.stack([np.asarray(v, dtype=np.float64) for v in a["vec"].to_numpy()])
            vb = np.stack([np.asarray(v, dtype=np.float64) for v in b["vec"].to_numpy()])
            for s in range(0, len(va), 512):
                diff = va[s:s + 512, None, :] - vb[None, :, :]
                if (np.sqrt((diff * diff).sum(axis=2)) <= eps).any():
                    return pd.DataFrame({"a": [str(pdf["ka_key"].iloc[0])], "b": [str(pdf["kb_key"].iloc[0])]})
        return pd.DataFrame({"a": pd.Series([], dtype=object), "b": pd.Series([], dtype=object)})

    x = x.select("vec", "is_a", "ka", "kb", _key(F.col("ca")).alias("ka_key"), _key(F.col("cb")).alias("kb_key"))
    hit = x.groupBy("ka_key", "kb_key", "ka", "kb").applyInPandas(kernel, "a string, b string")
    return hit.distinct()


def _key(cell):
    """Cell coordinates as a string key (component ids are compared only for equality and min)."""
    return F.concat_ws(",", F.transform(cell, lambda v: v.cast("string")))


def _block_core(pts: DataFrame, eps: float, min_samples: int):
    """High-d: neighbour counts and links between core rows from the block join;
    each core row is its own 'cell'."""
    v = pts.select("id", "vec", F.lit(None).cast("string").alias("lab"))
    nc = eps_neighbour_counts(v, eps)
    core = pts.join(nc, "id").select("id", "vec", "ord", F.col("id").alias("cell"),
                                    (F.col("n") >= min_samples).alias("is_core")).cache()
    cv = core.where("is_core").select("id", "vec", F.lit(None).cast("string").alias("lab"))
    return core, eps_links(cv, eps)


def k_distances(df: DataFrame, id_col: str, features: Sequence[str], k: int = 4,
                block_rows: int | None = None) -> DataFrame:
    """Distance to the k-th nearest other row (k capped at n-1). In one or
    two dimensions from k-d leaves, else from the block join."""
    from . import plane
    from .pairs import knn_join

    n = df.count()
    kk = max(1, min(k, n - 1))
    v = df.select(F.col(id_col).alias("id"), F.array(*[F.col(f).cast("double") for f in features]).alias("vec"),
                  F.lit(None).cast("string").alias("lab"))
    if plane.fits(v, "id", "vec"):
        rows = v.select("id", *plane.places("vec"))
        kd = plane.kth_distances(rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("m")), kk)
        return rows.join(kd, ["x", "y"]).select(F.col("id").alias(id_col), "k_dist")
    nn = knn_join(v, v, kk, exclude_self=True, block_rows=block_rows)
    kd = nn.where(F.col("rank") == kk).select(F.col("q_id").alias(id_col), F.col("dist").alias("k_dist"))
    return kd
