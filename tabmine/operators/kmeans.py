"""K-Means with batched restarts and sweeps.

Every Lloyd iteration is ONE Spark job for all runs (restarts x k values):
each row's nearest centre per run is a projection over broadcast literal
centres, exploded to (run, cluster) and summed with map-side partial
aggregation. The driver holds runs x k x d numbers. Seeded hashes replace
random draws, so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import nearest_center


@dataclass
class KMeansResult:
    labels: DataFrame  # id, cluster
    centers: np.ndarray
    inertia: float
    n_iter: int
    run: int


def vec_frame(df: DataFrame, id_col: str, features: Sequence[str] | None = None, vec_col: str | None = None) -> DataFrame:
    if vec_col is not None:
        return df.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col), lambda v: v.cast("double")).alias("vec"))
    return df.select(F.col(id_col).alias("id"), F.array(*[F.col(f).cast("double") for f in features]).alias("vec"))


def _uniform(seed_key: Sequence) -> F.Column:
    """Deterministic u in (0, 1] from a hash of the row id and a key."""
    h = F.xxhash64(F.col("id"), *[F.lit(str(x)) for x in seed_key])
    return (F.pmod(h, F.lit(1 << 53)).cast("double") + F.lit(1.0)) / F.lit(float(1 << 53))


def random_init(v: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k rows with the smallest seeded hash (distinct rows)."""
    rows = v.withColumn("__o", F.md5(F.concat(F.col("id").cast("string"), F.lit(str(seed))))).orderBy(
        "__o", "id").limit(k).collect()
    return np.array([r["vec"] for r in rows], dtype=np.float64)


def kmeanspp_init(v: DataFrame, ks: dict, metric: str = "sqeuclidean") -> dict:
    """C2/C5 for many runs at once: the next centre of every run is drawn with
    probability proportional to D^2 by Efraimidis-Spirakis keys -ln(u)/w
    (u from a seeded hash of the row id), one job per step for all runs:
    partitions return their best (key, row) per run and the driver keeps the
    minimum. If every weight is 0 the draw is uniform."""
    import pandas as pd

    runs = list(ks)
    chosen: dict = {r: [] for r in runs}
    kmax = max(k for k, _ in ks.values())
    for step in range(kmax):
        active = [r for r in runs if len(chosen[r]) < ks[r][0]]
        if not active:
            break
        us = [_uniform((ks[r][1], "pp", step)).alias(f"u{j}") for j, r in enumerate(active)]
        cen = {r: (np.vstack(chosen[r]) if chosen[r] else None) for r in active}

        def part(it, active=active, cen=cen):
            best = {}
            for pdf in it:
                if len(pdf) == 0:
                    continue
                X = np.stack([np.asarray(x, dtype=np.float64) for x in pdf["vec"].to_numpy()])
                for j, r in enumerate(active):
                    tie = -np.log(pdf[f"u{j}"].to_numpy(np.float64))
                    if cen[r] is None:
                        key = tie
                    else:
                        w = _least_weight(X, cen[r], metric in ("sqeuclidean", "euclidean"))
                        with np.errstate(divide="ignore", invalid="ignore"):
                            key = np.where(w > 0, tie / w, np.inf)
                    first = np.flatnonzero(key == key.min())
                    i = first[tie[first].argmin()]
                    cand = (float(key[i]), float(tie[i]), X[i].tolist())
                    if r not in best or cand[:2] < best[r][:2]:
                        best[r] = cand
            if best:
                yield pd.DataFrame([(r, k_, t_, x_) for r, (k_, t_, x_) in best.items()],
                                   columns=["run", "key", "tie", "vec"])

        got = v.select("vec", *us).mapInPandas(
            part, "run int, key double, tie double, vec array<double>").collect()
        pick: dict = {}
        for row in got:
            cand = (row["key"], row["tie"])
            if row["run"] not in pick or cand < pick[row["run"]][0]:
                pick[row["run"]] = (cand, row["vec"])
        all_inf = [r for r in active if pick[r][0][0] == float("inf")]
        for r in active:
            chosen[r].append(np.array(pick[r][1], dtype=np.float64))
        _ = all_inf  # all weights 0: the tie key (uniform draw) decided
    return {r: np.vstack(chosen[r]) for r in runs}


def _least_weight(X: np.ndarray, C: np.ndarray, squared: bool) -> np.ndarray:
    """D^2 of every row to its nearest of the centres, a centre at a time."""
    least = None
    for c in C:
        diff = X - c
        diff = diff * diff if squared else np.abs(diff)
        if len(c) < 8:  # column by column: adds in the order of a row sum
            d = diff[:, 0].copy()
            for j in range(1, len(c)):
                d += diff[:, j]
        else:
            d = diff.sum(1)
        least = d if least is None else np.minimum(least, d)
    return least if squared else least ** 2


def lloyd(v: DataFrame, init: dict, max_iter: int = 100, tol: float = 1e-4, seed: int = 42):
    """Batched Lloyd iterations. ``init`` maps run -> k x d centres.
    Returns run -> (assign_centres, reported_centres, n_iter): labels come
    from ``assign_centres``; on convergence (every coordinate moved < tol)
    the pre-update centres are kept, as in the reference."""
    centers = {r: np.array(c, dtype=np.float64) for r, c in init.items()}
    assign = dict(centers)
    n_iter = {r: 0 for r in centers}
    active = set(centers)
    d = next(iter(centers.values())).shape[1]
    for it in range(max_iter):
        if not active:
            break
        runs = sorted(active)
        agg = _partial_sums(v, {r: centers[r] for r in runs}, d)
        by_run: dict = {r: {} for r in runs}
        for row in agg:
            by_run[row["run"]][row["c"]] = row
        for r in runs:
            old = centers[r]
            new = old.copy()
            for j in range(old.shape[0]):
                row = by_run[r].get(j)
                if row is None or row["n"] == 0:
                    pick = v.withColumn("__o", F.md5(F.concat(F.col("id").cast("string"), F.lit(f"{seed}|{r}|{it}|{j}")))
                                        ).orderBy("__o", "id").limit(1).collect()
                    new[j] = np.array(pick[0]["vec"], dtype=np.float64)
                else:
                    new[j] = np.array([row[f"s{i}"] for i in range(d)], dtype=np.float64) / row["n"]
            assign[r] = old
            n_iter[r] = it + 1
            if np.all(np.abs(old - new) < tol):
                active.discard(r)
            else:
                centers[r] = new
    return {r: (assign[r], centers[r], n_iter[r]) for r in centers}


def _spread(v: DataFrame) -> DataFrame:
    """Over all cores: a small file is read by few tasks, and every iteration would run on as few."""
    cores = v.sparkSession.sparkContext.defaultParallelism
    return v.repartition(cores) if v.rdd.getNumPartitions() < cores else v


def _scalar_cols(v: DataFrame, d: int) -> DataFrame:
    """Vector elements as plain DOUBLE columns: Arrow hands them to NumPy as
    contiguous arrays (no per-row object conversion)."""
    return v.select(*[F.col("vec")[i].alias(f"x{i}") for i in range(d)])


def _nearest(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of every row (ties to the lowest), one centre and coordinate at a time:
    memory is a few numbers a row."""
    if np.isfinite(C).all():
        cols = np.ascontiguousarray(X.T)
        lab, least = np.zeros(len(X), np.int64), None
        for i, c in enumerate(C):
            d2 = np.zeros(len(X))
            for x, y in zip(cols, c):
                t = x - y
                t *= t
                d2 += t
            if least is None:
                least = d2
                continue
            lab[d2 < least] = i
            np.minimum(least, d2, out=least)
        return lab
    d2 = np.zeros((len(X), len(C)))
    for j in range(X.shape[1]):
        t = X[:, j, None] - C[None, :, j]
        t *= t
        d2 += t
    return d2.argmin(axis=1)


def labels_of(vec: Column, centers: Sequence[np.ndarray]) -> Column:
    """ARRAY<INT>: the nearest centre of each of ``centers`` (runs x k x d), as ``nearest_center`` has it. Arrow and NumPy: as
    one expression, some dozens of runs make more generated code than a driver compiles."""
    import pandas as pd

    cen = [np.asarray(c, dtype=np.float64) for c in centers]

    def label(*cols: pd.Series) -> pd.Series:
        X = [c.to_numpy(dtype=np.float64) for c in cols]
        labs = np.zeros((len(X[0]), len(cen)), np.int32)
        with np.errstate(invalid="ignore"):
            for r, C in enumerate(cen):
                least = np.full(len(X[0]), np.nan)
                for i, c in enumerate(C):
                    dist = np.zeros(len(X[0]))
                    for x, y in zip(X, c):
                        dist += (x - y) * (x - y)
                    dist = np.sqrt(dist)
                    closer = (dist < least) | (np.isnan(least) & ~np.isnan(dist))
                    labs[closer, r] = i
                    least = np.where(closer, dist, least)
        return pd.Series(list(labs))

    label.__annotations__ = {"cols": pd.Series, "return": pd.Series}
    return F.pandas_udf(label, "array<int>")(*[vec[i] for i in range(cen[0].shape[1])])


def _partial_sums(v: DataFrame, centers: dict, d: int) -> list:
    """One job: every partition assigns its rows to the nearest centre of
    every run with NumPy (ties -> lowest index) and emits per (run, cluster)
    count and coordinate sums; the tiny partial tables are summed by Spark."""
    import pandas as pd

    runs = sorted(centers)
    cen = [np.asarray(centers[r], dtype=np.float64) for r in runs]

    def part(it):
        acc = {}
        for pdf in it:
            if len(pdf) == 0:
                continue
            X = pdf.to_numpy(dtype=np.float64)
            for r, C in zip(runs, cen):
                lab = _nearest(X, C)
                cnt = np.bincount(lab, minlength=len(C)).astype(np.int64)
                sums = np.stack([np.bincount(lab, weights=X[:, j], minlength=len(C)) for j in range(d)], axis=1)
                if r in acc:
                    acc[r][0] += cnt
                    acc[r][1] += sums
                else:
                    acc[r] = [cnt, sums]
        rows = []
        for r, (cnt, sums) in acc.items():
            for j in range(len(cnt)):
                if cnt[j]:
                    rows.append((r, j, int(cnt[j]), sums[j].tolist()))
        if rows:
            yield pd.DataFrame(rows, columns=["run", "c", "n", "s"])

    parts = _scalar_cols(v, d).mapInPandas(part, "run int, c int, n bigint, s array<double>")
    got = parts.select("run", "c", "n", F.posexplode("s").alias("i", "x")).groupBy("run", "c", "i").agg(
        F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    out: dict = {}
    for r in got:
        row = out.setdefault((r["run"], r["c"]), {"run": r["run"], "c": r["c"], "n": r["n"]})
        row[f"s{r['i']}"] = r["x"]
    return list(out.values())


def inertia_of(v: DataFrame, fits: dict) -> dict:
    """Sum of squared distances of every row to the reported centre of its
    assigned cluster, for all runs in one job (NumPy per partition)."""
    import pandas as pd

    runs = sorted(fits)

    def part(it):
        tot = {r: 0.0 for r in runs}
        for pdf in it:
            if len(pdf) == 0:
                continue
            X = pdf.to_numpy(dtype=np.float64)
            for r in runs:
                a, rep, _ = fits[r]
                lab = _nearest(X, np.asarray(a))
                e = X - np.asarray(rep)[lab]
                tot[r] += float((e * e).sum())
        yield pd.DataFrame({"run": runs, "i": [tot[r] for r in runs]})

    d = np.asarray(fits[runs[0]][0]).shape[1]
    got = _scalar_cols(v, d).mapInPandas(part, "run int, i double").groupBy("run").agg(F.sum("i").alias("i")).collect()
    return {row["run"]: float(row["i"]) for row in got}


def kmeans(df: DataFrame, id_col: str, features: Sequence[str] | None = None, k: int = 3, vec_col: str | None = None,
           init="k-means++", n_init: int = 10, max_iter: int = 100, tol: float = 1e-4, seed: int = 42) -> KMeansResult:
    """Best of ``n_init`` restarts by inertia (first on ties). ``init`` is
    'k-means++', 'random' or an explicit k x d array (then one run)."""
    v = _spread(vec_frame(df, id_col, features, vec_col)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if isinstance(init, str):
            if init == "k-means++":
                starts = kmeanspp_init(v, {r: (k, seed + r) for r in range(n_init)})
            elif init == "random":
                starts = {r: random_init(v, k, seed + r) for r in range(n_init)}
            else:
                raise ValueError("init must be 'k-means++', 'random' or an array of centres")
        else:
            starts = {0: np.asarray(init, dtype=np.float64)}
        fits = lloyd(v, starts, max_iter, tol, seed)
        ine = inertia_of(v, fits)
        best = min(sorted(fits), key=lambda r: (ine[r], r))
        a, rep, n_it = fits[best]
        labels = df.select(F.col(id_col), nearest_center(_vec_expr(features, vec_col), a)["idx"].cast("int").alias("cluster"))
        return KMeansResult(labels, rep, ine[best], n_it, best)
    finally:
        v.unpersist()


def _vec_expr(features, vec_col):
    if vec_col is not None:
        return F.transform(F.col(vec_col), lambda x: x.cast("double"))
    return F.array(*[F.col(f).cast("double") for f in features])


def elbow(df: DataFrame, id_col: str, features: Sequence[str] | None = None, ks: Sequence[int] = range(2, 11),
          restarts: int = 5, vec_col: str | None = None, max_iter: int = 100, tol: float = 1e-4, seed: int = 42):
    """Q7: best inertia per k over ``restarts`` k-means++ runs; all
    (k, restart) runs share every iteration's job. Returns (table, fits)."""
    spark = df.sparkSession
    v = _spread(vec_frame(df, id_col, features, vec_col)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        spec = {}
        for k in ks:
            for r in range(restarts):
                spec[(k, r)] = (k, seed + r)
        keys = sorted(spec)
        run_id = {key: i for i, key in enumerate(keys)}
        starts = kmeanspp_init(v, {run_id[key]: spec[key] for key in keys})
        fits = lloyd(v, starts, max_iter, tol, seed)
        ine = inertia_of(v, fits)
    finally:
        v.unpersist()
    rows = []
    best = {}
    for k in ks:
        cand = [(ine[run_id[(k, r)]], r) for r in range(restarts)]
        i, r = min(cand)
        best[k] = (run_id[(k, r)], fits[run_id[(k, r)]])
        rows.append((int(k), float(i)))
    return spark.createDataFrame(rows, "k int, inertia double"), best, fits, run_id
