"""DIANA (divisive analysis) as a driver loop of block-join jobs.

Each division: the cluster with the largest diameter (first on ties; only
the two clusters changed by the last division are re-measured) is split by
the splinter method. Splinter rounds move, all at once, every A-row whose
mean distance to B is below its mean distance to the rest of A. The sums
are maintained incrementally: a round only computes distances from the
remaining A-rows to the rows that moved in the previous round, so each
pair of the split cluster is computed once over the whole split.

Rows with distinct ids are packed (``packs``): the driver keeps cluster and
sums of every row, and the jobs read the packs where they lie. A cluster of up
to ONE_TASK_ROWS rows does all its rounds in one task. Repeated ids take the
block join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import distances_for_sums, np_distance_matrix
from ..session import cut_lineage
from . import packs, plane
from .kmeans import vec_frame
from .pairs import DEFAULT_BLOCK_ROWS, _slices, _stack, block_join

#: Rows of a cluster up to which one task does all rounds of its split.
ONE_TASK_ROWS = 32_768
#: Rows that moved whose vectors the driver holds at once.
MOVED_ROWS = 16_384


def _sum_to(q: DataFrame, b: DataFrame, metric: str, block_rows: int, how: str = "sum") -> DataFrame:
    """Per query row: sum (or max) of distances to the base rows (self excluded)."""
    id_type = dict(q.dtypes)["id"]

    def kernel(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0:
            return pd.DataFrame({"id": pd.Series([], dtype=object), "s": pd.Series([], dtype=float)})
        x, y = _stack(qp["vec"]), _stack(bp["vec"])
        d = distances_for_sums(x, y) if metric == "euclidean" and how == "sum" else np_distance_matrix(x, y, metric)
        d = np.where(qp["id"].to_numpy()[:, None] == bp["id"].to_numpy()[None, :], 0.0, d)
        return pd.DataFrame({"id": qp["id"].to_numpy(), "s": d.sum(axis=1) if how == "sum" else d.max(axis=1)})

    part = block_join(q.select("id", "vec", F.lit(None).cast("string").alias("lab")),
                      b.select("id", "vec", F.lit(None).cast("string").alias("lab")),
                      kernel, f"id {id_type}, s double", block_rows)
    agg = F.sum("s") if how == "sum" else F.max("s")
    return part.groupBy("id").agg(agg.alias("s"))


def cluster_diameter(v: DataFrame, metric: str = "euclidean", block_rows: int | None = None) -> float:
    """C14: largest pairwise distance of the rows (0 for fewer than 2). In one or two dimensions between corners of their hull."""
    if v.limit(2).count() < 2:
        return 0.0
    if block_rows is None and metric == "euclidean" and plane.fits(v, "id", "vec"):
        got = plane.diameter(v.select(*plane.places("vec")))
        if got is not None:
            return got
    if block_rows is None and v.count() > DEFAULT_BLOCK_ROWS and packs.distinct_ids(v):
        p = packs.pack(v)
        return packs.diameters(p, p.split(np.zeros(p.n, np.int32)), [0], metric)[0]
    block_rows = block_rows or DEFAULT_BLOCK_ROWS
    r = _sum_to(v, v, metric, block_rows, "max").agg(F.max("s").alias("m")).first()["m"]
    return float(r or 0.0)


def _rounds(tot: np.ndarray, sums_to: Callable[[np.ndarray, np.ndarray], np.ndarray], compat: bool) -> np.ndarray:
    """Marks of the rows that stay in A. ``tot``: the rows' sums of distances to all, in id order; ``sums_to(rest, moved)``: the
    sums of distances from the rows ``rest`` marks to those ``moved`` marks."""
    n = len(tot)
    in_a = np.ones(n, bool)
    in_a[int(np.argmax(tot / (n - 1)))] = False
    sum_b = sums_to(in_a, ~in_a)
    sum_a = tot - sum_b
    while True:  # every round moves a row out of A, so rounds end
        n_a = int(in_a.sum())
        gap = (sum_a / (n_a - 1) if n_a > 1 else np.full(n, np.inf)) - sum_b / (n - n_a)
        move = in_a & (gap > 0)
        if not compat and move.sum() >= n_a:
            cand = np.flatnonzero(move)
            move[cand[np.lexsort([cand, gap[cand]])[0]]] = False  # the least eager row stays in A
        if not move.any():
            return in_a
        in_a &= ~move
        d = sums_to(in_a, move)
        sum_a, sum_b = sum_a - d, sum_b + d


def _split(p: packs.Packs, member: np.ndarray, metric: str, compat: bool) -> np.ndarray:
    """Marks of the member rows that splinter_split() moves to B."""
    marks = p.split(member)
    if member.sum() > ONE_TASK_ROWS:
        def to_moved(rest: np.ndarray, moved: np.ndarray) -> np.ndarray:
            s, places = np.zeros(len(rest)), np.flatnonzero(moved)
            for k in range(0, len(places), MOVED_ROWS):
                some = np.zeros(p.n, bool)
                some[at[places[k:k + MOVED_ROWS]]] = True
                left = np.zeros(p.n, bool)
                left[at[rest]] = True
                s += np.concatenate(packs.sums_to(p, p.split(left), packs.vectors(p, p.split(some)), metric))[at]
            return s

        at = np.flatnonzero(member)
        in_a = _rounds(np.concatenate(packs.pair_sums(p, marks, metric))[at], to_moved, compat)
    else:
        def take(q, _ids, x, _lab):
            return pd.DataFrame({"blk": [q], "s": [x[marks[q]].tobytes()]})

        def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            got = sorted((q, s) for b in batches for q, s in zip(b["blk"], b["s"]) if marks[q].any())
            if not got:
                return
            x = np.concatenate([np.frombuffer(s, np.float64).reshape(int(marks[q].sum()), -1) for q, s in got])

            def sums_to(rest: np.ndarray, moved: np.ndarray) -> np.ndarray:
                s, i, to = np.zeros(len(rest)), np.flatnonzero(rest), x[moved]
                for sl in _slices(len(i), len(to)):
                    s[i[sl]] = packs._apart(x[i[sl]], to, metric).sum(axis=1)
                return s

            every = np.ones(len(x), bool)
            yield pd.DataFrame({"a": [_rounds(sums_to(every, every), sums_to, compat).tobytes()]})

        got = packs.over_blocks(p, take, "blk int, s binary").repartition(1).mapInPandas(split, "a binary").first()
        in_a = np.frombuffer(got["a"], bool)
    out = np.zeros(p.n, bool)
    out[np.flatnonzero(member)[~in_a]] = True
    return out


def _named(p: packs.Packs, values: np.ndarray, name: str) -> DataFrame:
    """(id, ``name``) of every row."""
    by = p.split(values.astype(np.int32))
    return packs.over_blocks(p, lambda q, ids, _x, _lab: pd.DataFrame({"id": list(ids), name: by[q]}), f"id {p.id_type}, {name} int")


def _diana_packed(p: packs.Packs, n_clusters: int, metric: str, compat: bool) -> tuple[np.ndarray, list]:
    """Cluster of every row and the division history, as diana() has them."""
    lab, diam, history, changed = np.zeros(p.n, np.int32), {}, [], [0]
    for new in range(1, n_clusters):
        sizes = np.bincount(lab, minlength=new)
        some = [c for c in changed if sizes[c] >= 2]
        diam |= dict.fromkeys(changed, -1.0) | (packs.diameters(p, p.split(lab), some, metric) if some else {})
        eligible = [c for c in range(new) if sizes[c] >= 2]
        if not eligible:
            break
        target = max(eligible, key=lambda c: (diam[c], -c))
        lab[_split(p, lab == target, metric, compat)] = new
        history.append((target, new, float(diam[target])))
        changed = [target, new]
    return lab, history


def splinter_split(v: DataFrame, metric: str = "euclidean", compat: bool = False,
                   block_rows: int | None = None) -> DataFrame:
    """(id, side) with side 1 for the splinter group B. ``compat=True``
    keeps the reference's behaviour that a lone A-row (mean distance inf)
    also moves, so A can empty; by default A keeps at least one row."""
    n = v.count()
    if n < 2:
        return v.select("id", F.lit(0).alias("side"))
    if block_rows is None and n > DEFAULT_BLOCK_ROWS and packs.distinct_ids(v):
        p = packs.pack(v)
        return _named(p, _split(p, np.ones(n, bool), metric, compat), "side")
    block_rows = block_rows or DEFAULT_BLOCK_ROWS
    if n <= block_rows:  # one block: the same rounds on its distance matrix, without a job per round
        return _splinter_block(v, metric, compat)
    tot = _sum_to(v, v, metric, block_rows)
    first = tot.select("id", (F.col("s") / F.lit(n - 1)).alias("avg")).orderBy(F.desc("avg"), "id").first()
    s_id = first["id"]
    d_s = _sum_to(v, v.where(F.col("id") == F.lit(s_id)), metric, block_rows)
    st = v.join(tot.withColumnRenamed("s", "tot"), "id").join(d_s.withColumnRenamed("s", "ds"), "id").select(
        "id", "vec", (F.col("id") != F.lit(s_id)).alias("inA"),
        (F.col("tot") - F.col("ds")).alias("sumA"), F.col("ds").alias("sumB"))
    st = cut_lineage(st)
    n_a, n_b = n - 1, 1
    while True:  # every round moves a row out of A, so rounds end
        avg_a = F.when(F.lit(n_a - 1) > 0, F.col("sumA") / F.lit(max(n_a - 1, 1))).otherwise(F.lit(float("inf")))
        avg_b = F.col("sumB") / F.lit(n_b)
        cand = st.where(F.col("inA") & (avg_b < avg_a)).select("id", (avg_a - avg_b).alias("gap"))
        n_m = cand.count()
        if n_m == 0:
            break
        if not compat and n_m >= n_a:
            keep = cand.orderBy("gap", "id").first()["id"]  # the least eager row stays in A
            cand = cand.where(F.col("id") != F.lit(keep))
            n_m -= 1
            if n_m == 0:
                break
        movers = st.join(cand.select("id"), "id").select("id", "vec")
        rest = st.where(F.col("inA")).join(cand.select("id"), "id", "left_anti").select("id", "vec")
        dm = _sum_to(rest, movers, metric, block_rows)
        moved = cand.select("id", F.lit(True).alias("mv"))
        st = cut_lineage(st.join(moved, "id", "left").join(dm.withColumnRenamed("s", "dm"), "id", "left").select(
            "id", "vec", (F.col("inA") & F.col("mv").isNull()).alias("inA"),
            (F.col("sumA") - F.coalesce("dm", F.lit(0.0))).alias("sumA"),
            (F.col("sumB") + F.coalesce("dm", F.lit(0.0))).alias("sumB")))
        n_a -= n_m
        n_b += n_m
    return st.select("id", F.when(F.col("inA"), 0).otherwise(1).alias("side"))


def _splinter_block(v: DataFrame, metric: str, compat: bool) -> DataFrame:
    """splinter_split() of at most one block of rows, as one task."""
    id_type = dict(v.dtypes)["id"]

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        x = _stack(pdf["vec"])
        d = np_distance_matrix(x, x, metric)
        np.fill_diagonal(d, 0.0)
        n = len(x)
        in_a = np.ones(n, bool)
        in_a[int(np.argmax(d.sum(1) / (n - 1)))] = False
        while True:
            n_a, n_b = int(in_a.sum()), int((~in_a).sum())
            avg_a = d[:, in_a].sum(1) / (n_a - 1) if n_a > 1 else np.full(n, np.inf)
            gap = avg_a - d[:, ~in_a].sum(1) / n_b
            move = in_a & (gap > 0)
            if not compat and move.sum() >= n_a:
                cand = np.flatnonzero(move)
                move[cand[np.lexsort([cand, gap[cand]])[0]]] = False  # the least eager row stays in A
            if not move.any():
                break
            in_a &= ~move
        return pd.DataFrame({"id": pdf["id"].to_numpy(), "side": (~in_a).astype(np.int32)})

    return v.groupBy(F.lit(0).alias("block")).applyInPandas(split, f"id {id_type}, side int")


def diana(df: DataFrame, id_col: str, features: Sequence[str] | None = None, n_clusters: int = 2,
          metric: str = "euclidean", vec_col: str | None = None, compat: bool = False,
          block_rows: int | None = None):
    """Labels and the division history (split cluster, new cluster,
    diameter). The new label is the number of divisions so far + 1."""
    spark = df.sparkSession
    v = vec_frame(df, id_col, features, vec_col)
    if block_rows is None and v.count() > DEFAULT_BLOCK_ROWS and packs.distinct_ids(v):
        p = packs.pack(v)
        cluster, history = _diana_packed(p, n_clusters, metric, compat)
        return (_named(p, cluster, "cluster").withColumnRenamed("id", id_col),
                spark.createDataFrame(history, "split_cluster int, new_cluster int, split_diameter double"))
    block_rows = block_rows or DEFAULT_BLOCK_ROWS
    lab = cut_lineage(v.select("id", "vec", F.lit(0).alias("cluster")))
    diam: dict[int, float] = {}
    sizes: dict[int, int] = {0: lab.count()}
    history = []
    current = 1
    changed = [0]
    while current < n_clusters:
        for c in changed:
            sub = lab.where(F.col("cluster") == c)
            diam[c] = cluster_diameter(sub, metric, block_rows) if sizes.get(c, 0) >= 2 else -1.0
        eligible = [c for c in range(current) if sizes.get(c, 0) >= 2]
        if not eligible:
            break
        target = max(eligible, key=lambda c: (diam[c], -c))
        sub = lab.where(F.col("cluster") == target).select("id", "vec")
        sides = splinter_split(sub, metric, compat, block_rows)
        new_id = current
        lab = cut_lineage(lab.join(sides, "id", "left").select(
            "id", "vec", F.when(F.col("side") == 1, F.lit(new_id)).otherwise(F.col("cluster")).alias("cluster")))
        cnt = {r["cluster"]: r["n"] for r in lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = {c: int(cnt.get(c, 0)) for c in range(current + 1)}
        history.append((target, new_id, float(diam[target])))
        current += 1
        changed = [target, new_id]
    labels = lab.select(F.col("id").alias(id_col), "cluster")
    hist = spark.createDataFrame(history, "split_cluster int, new_cluster int, split_diameter double")
    return labels, hist


def diana_curve(df: DataFrame, id_col: str, features: Sequence[str] | None = None, ks: Sequence[int] = range(2, 11),
                metric: str = "euclidean", vec_col: str | None = None, compat: bool = False) -> DataFrame:
    """Q10: the hierarchy is nested, so run once to max(k) and replay the
    divisions: labels at k = labels with every cluster >= k folded back into
    the cluster it split from; silhouette per k in one multi-label job."""
    from .select import multi_silhouette

    spark = df.sparkSession
    kmax = max(ks)
    labels, hist = diana(df, id_col, features, kmax, metric, vec_col, compat)
    h = hist.collect()
    parent = {r["new_cluster"]: r["split_cluster"] for r in h}

    def at_k(c: int, k: int) -> int:
        while c >= k:
            c = parent[c]
        return c

    ks = list(ks)
    maps = [F.create_map(*[x for c in range(kmax) for x in (F.lit(c), F.lit(at_k(c, k) if c in parent or c == 0 else c))])
            for k in ks]
    v = vec_frame(df, id_col, features, vec_col)
    lab = labels.select(F.col(id_col).alias("id"), F.array(*[F.element_at(m, F.col("cluster")) for m in maps]).alias("labs"))
    sil = multi_silhouette(v, lab, len(ks))
    rows = [(int(k), None if sil.get(i) is None else round(float(sil[i]), 6)) for i, k in enumerate(ks)]
    return spark.createDataFrame(rows, "k int, silhouette double")
