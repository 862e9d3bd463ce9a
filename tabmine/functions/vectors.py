"""Vector Column expressions (JVM side, whole-stage codegen) and the NumPy
kernels used inside Arrow batches by the block joins."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("euclidean", "manhattan", "minkowski", "cosine", "sqeuclidean")


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    return metric


def as_vector(cols: Sequence[str]) -> Column:
    """Feature columns -> ARRAY<DOUBLE>."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def _fold(a: Column, b: Column, term) -> Column:
    return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: x.cast("double") * y.cast("double"))


def _unrolled(a: Column, b: Column, dims: int, metric: str, p: float) -> Column:
    """Plain arithmetic over known dimensions: stays inside whole-stage codegen
    (higher-order functions are interpreted)."""
    def el(v, i):
        return v[i].cast("double")

    if metric in ("euclidean", "sqeuclidean"):
        terms = [(el(a, i) - el(b, i)) * (el(a, i) - el(b, i)) for i in range(dims)]
    elif metric == "manhattan":
        terms = [F.abs(el(a, i) - el(b, i)) for i in range(dims)]
    elif metric == "minkowski":
        terms = [F.pow(F.abs(el(a, i) - el(b, i)), F.lit(p)) for i in range(dims)]
    else:
        dot_ = sum((el(a, i) * el(b, i) for i in range(1, dims)), el(a, 0) * el(b, 0))
        na = F.sqrt(sum((el(a, i) * el(a, i) for i in range(1, dims)), el(a, 0) * el(a, 0)))
        nb = F.sqrt(sum((el(b, i) * el(b, i) for i in range(1, dims)), el(b, 0) * el(b, 0)))
        return F.lit(1.0) - dot_ / (na * nb)
    s = terms[0]
    for t in terms[1:]:
        s = s + t
    if metric == "euclidean":
        return F.sqrt(s)
    if metric == "minkowski":
        return F.pow(s, F.lit(1.0 / p))
    return s


def distance(a: Column, b: Column, metric: str = "euclidean", p: float = 2.0, dims: int | None = None) -> Column:
    """Distance between two ARRAY columns of equal length. With ``dims``
    (small) the expression is unrolled so it compiles into generated code."""
    check_metric(metric)
    if dims is not None and dims <= 16:
        return _unrolled(a, b, dims, metric, p)
    if metric in ("euclidean", "sqeuclidean"):
        s = _fold(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
        return s if metric == "sqeuclidean" else F.sqrt(s)
    if metric == "manhattan":
        return _fold(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    if metric == "minkowski":
        s = _fold(a, b, lambda x, y: F.pow(F.abs(x.cast("double") - y.cast("double")), F.lit(p)))
        return F.pow(s, F.lit(1.0 / p))
    na = F.sqrt(dot(a, a))
    nb = F.sqrt(dot(b, b))
    return F.lit(1.0) - dot(a, b) / (na * nb)


def kernel(a: Column, b: Column, kind: str = "linear", gamma: float = 1.0, degree: int = 3, coef0: float = 0.0) -> Column:
    """SVM kernels: linear, poly (x.y+1)^degree, rbf exp(-gamma d2),
    sigmoid tanh(gamma x.y + coef0). Unknown kind raises."""
    if kind == "linear":
        return dot(a, b)
    if kind == "poly":
        return F.pow(dot(a, b) + F.lit(1.0), F.lit(float(degree)))
    if kind == "rbf":
        return F.exp(F.lit(-gamma) * distance(a, b, "sqeuclidean"))
    if kind == "sigmoid":
        return F.tanh(F.lit(gamma) * dot(a, b) + F.lit(coef0))
    raise ValueError(f"unknown kernel {kind!r}")


def nearest_center(vec: Column, centers: Sequence[Sequence[float]], metric: str = "euclidean") -> Column:
    """STRUCT(dist, idx) of the nearest of a small broadcast list of centres;
    ties go to the lowest index. Pure projection, no shuffle."""
    d = len(centers[0]) if len(centers) else 0
    if 0 < d and len(centers) * d <= 512:
        # unrolled: every centre's distance is plain arithmetic (codegen)
        structs = [F.struct(distance(vec, F.array(*[F.lit(float(v)) for v in c]), metric, dims=min(d, 16)
                                     if d <= 16 else None).alias("dist"), F.lit(i).alias("idx"))
                   for i, c in enumerate(centers)]
        return F.array_min(F.array(*structs))
    arr = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
    pairs = F.transform(arr, lambda c, i: F.struct(distance(vec, c, metric).alias("dist"), i.alias("idx")))
    return F.array_min(pairs)


# ---- NumPy kernels for Arrow blocks ---------------------------------------

def np_distance_matrix(a: np.ndarray, b: np.ndarray, metric: str = "euclidean", p: float = 2.0) -> np.ndarray:
    """Exact distance matrix between row blocks; chunked differences keep the
    rounding identical to a plain sum of squared differences."""
    a = np.asarray(a, dtype=np.float64)
    b = np.asarray(b, dtype=np.float64)
    if metric == "cosine":
        na = np.linalg.norm(a, axis=1)[:, None]
        nb = np.linalg.norm(b, axis=1)[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            return 1.0 - (a @ b.T) / (na * nb)
    out = np.empty((a.shape[0], b.shape[0]), dtype=np.float64)
    step = max(1, 4_000_000 // max(1, b.shape[0] * max(1, a.shape[1])))
    for s in range(0, a.shape[0], step):
        diff = a[s : s + step, None, :] - b[None, :, :]
        if metric == "euclidean":
            out[s : s + step] = np.sqrt(np.sum(diff * diff, axis=2))
        elif metric == "sqeuclidean":
            out[s : s + step] = np.sum(diff * diff, axis=2)
        elif metric == "manhattan":
            out[s : s + step] = np.sum(np.abs(diff), axis=2)
        elif metric == "minkowski":
            out[s : s + step] = np.sum(np.abs(diff) ** p, axis=2) ** (1.0 / p)
        else:
            raise ValueError(f"unknown metric {metric!r}")
    return out


def _gram(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Squared distances by one matrix product, and a bound of their error for each row of ``a``; None if they overflow or
    are no numbers."""
    mid = b.mean(axis=0)
    x, y = a - mid, b - mid
    with np.errstate(over="ignore", invalid="ignore"):
        nx, ny = (x * x).sum(axis=1), (y * y).sum(axis=1)
        most = np.maximum((a * a).sum(axis=1), nx) + max((b * b).sum(axis=1).max(), ny.max())
        if not np.isfinite(most).all():
            return None
        d2 = x @ y.T
    d2 *= -2.0
    d2 += nx[:, None]
    d2 += ny[None, :]
    return d2, 8 * (a.shape[1] + 8) * np.finfo(np.float64).eps * most


def pair_distances(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs (a[i], b[j]), with the rounding of ``np_distance_matrix``."""
    out = np.empty(len(i))
    step = max(1, 1_000_000 // max(1, a.shape[1]))
    for s in range(0, len(i), step):
        diff = a[i[s:s + step]] - b[j[s:s + step]]
        out[s:s + step] = np.sqrt(np.sum(diff * diff, axis=1))
    return out


def distances_for_sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance matrix by one matrix product, for sums of distances: the relative error stays below 1e-10, as
    pairs close together against their distance from the middle are computed from their differences."""
    got = _gram(a, b) if len(a) and len(b) else None
    if got is None:
        return np_distance_matrix(a, b)
    d2, err = got
    i, j = np.nonzero(d2 <= err[:, None] * 1e10)
    np.maximum(d2, 0.0, out=d2)
    np.sqrt(d2, out=d2)
    d2[i, j] = pair_distances(a, b, i, j)
    return d2


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Matrix of the pairs whose distance is at most eps, as ``np_distance_matrix`` decides: a matrix product settles the
    clear ones, the others are computed."""
    got = _gram(a, b) if len(a) and len(b) and np.isfinite(eps) else None
    if got is None:
        return np_distance_matrix(a, b) <= eps
    d2, err = got
    err = err + 8 * np.finfo(np.float64).eps * eps * eps
    out = d2 <= eps * eps
    d2 -= eps * eps
    i, j = np.nonzero(np.abs(d2, out=d2) <= err[:, None])
    out[i, j] = pair_distances(a, b, i, j) <= eps
    return out


def nearest_pairs(a: np.ndarray, b: np.ndarray, k: int, hidden: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(row of a, row of b, distance) of the k nearest rows of ``b`` for each row of ``a``, ascending, ties to the lower row;
    ``hidden``: pairs left out. A matrix product leaves out what cannot be among them. None: use the plain matrix."""
    got = _gram(a, b) if len(a) and len(b) else None
    if got is None:
        return None
    d2, err = got
    if hidden is not None:
        d2[hidden] = np.inf
    k = min(k, len(b))
    upto = np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * err
    i, j = np.nonzero((d2 <= upto[:, None]) & (d2 < np.inf))
    dist = pair_distances(a, b, i, j)
    order = np.lexsort([j, dist, i])
    i, j, dist = i[order], j[order], dist[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep], dist[keep]
