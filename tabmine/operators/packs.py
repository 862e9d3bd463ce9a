"""All pairs of rows of many dimensions without copies of the rows on disk.

A pack is one row that holds the ids of a block of rows and their matrix. The partitions of the packs are crossed where they
lie: a task reads two packs of the checkpoint, and only sums, maxima or nearest rows leave it. What the driver knows of the
rows (cluster, sums: a few numbers each) travels with the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import row_index
from ..functions.vectors import _gram, distances_for_sums, np_distance_matrix, pair_distances
from ..session import cut_lineage
from .pairs import _blocks, _large, _slices, _stack

#: Distinct rows of labels up to which a pass over all pairs adds up the distances to each.
MAX_LABELS = 64


@dataclass
class Packs:
    rows: DataFrame  # blk, ids, vec (matrix of doubles, row by row), lab (matrix of ints); one row a block
    sizes: list[int]
    id_type: str

    @property
    def n(self) -> int:
        return sum(self.sizes)

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        """Values of all rows in id order, by blocks."""
        return np.split(values, np.cumsum(self.sizes)[:-1])


def distinct_ids(v: DataFrame) -> bool:
    """Every row has an id of its own and a vector."""
    got = v.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.count("vec").alias("vecs")).first()
    return got["n"] == got["ids"] == got["vecs"]


def pack(v: DataFrame, block_rows: int | None = None, labs: bool = False) -> Packs:
    """Packs of (id, vec), with ``labs`` also labs ARRAY<INT>; blocks and the rows in them come in the order of the ids."""
    n = v.count()
    block = _large(n, block_rows, v.sparkSession)
    nb = _blocks(n, block)
    id_type = dict(v.dtypes)["id"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx", kind="stable")
        lab = np.array(pdf["labs"].tolist(), np.int32) if labs else np.zeros(0, np.int32)
        return pd.DataFrame({"blk": [int(pdf["blk"].iloc[0])], "ids": [pdf["id"].tolist()], "vec": [_stack(pdf["vec"]).tobytes()], "lab": [lab.tobytes()]})

    rows = row_index(v, ["id"]).withColumn("blk", F.floor(F.col("idx") / F.lit(block)).cast("int"))
    rows = rows.groupBy("blk").applyInPandas(one, f"blk int, ids array<{id_type}>, vec binary, lab binary")
    return Packs(cut_lineage(rows.repartitionByRange(nb, "blk")), [min(block, n - s) for s in range(0, n, block)], id_type)


def _matrix(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(n, -1)


def over_pairs(p: Packs, kernel: Callable[..., list[tuple]], schema: str, columns: Sequence[str]) -> DataFrame:
    """``kernel(block, matrix, labels, other block, its matrix, its labels)`` of every two blocks, the first not above the
    second; it returns rows."""
    sizes = p.sizes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for q, x, xl, o, y, yl in zip(b["blk"], b["vec"], b["lab"], b["blk2"], b["vec2"], b["lab2"]):
                n, m = sizes[q], sizes[o]
                got = kernel(q, _matrix(x, n), np.frombuffer(xl, np.int32).reshape(n, -1), o, _matrix(y, m), np.frombuffer(yl, np.int32).reshape(m, -1))
                if got:
                    yield pd.DataFrame(got, columns=columns)

    left = p.rows.select("blk", "vec", "lab")
    right = p.rows.select(F.col("blk").alias("blk2"), F.col("vec").alias("vec2"), F.col("lab").alias("lab2"))
    met = left.hint("shuffle_replicate_nl").join(right, F.col("blk") <= F.col("blk2"))
    return met.mapInPandas(run, schema)


def over_blocks(p: Packs, kernel: Callable[..., pd.DataFrame], schema: str) -> DataFrame:
    """``kernel(block, ids, matrix, labels)`` of every block."""
    sizes = p.sizes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for q, ids, x, lab in zip(b["blk"], b["ids"], b["vec"], b["lab"]):
                yield kernel(q, ids, _matrix(x, sizes[q]), np.frombuffer(lab, np.int32).reshape(sizes[q], -1))

    return p.rows.mapInPandas(run, schema)


def _apart(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    return distances_for_sums(a, b) if metric == "euclidean" else np_distance_matrix(a, b, metric)


def _added(parts: DataFrame) -> DataFrame:
    """blk, s: the matrices ``s`` of a block added up."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["s"].iloc[0], np.float64).copy()
        for s in pdf["s"].iloc[1:]:
            total += np.frombuffer(s, np.float64)
        return pd.DataFrame({"blk": [pdf["blk"].iloc[0]], "s": [total.tobytes()]})

    return parts.groupBy("blk").applyInPandas(add, "blk int, s binary")


def _by_block(p: Packs, got: DataFrame) -> list[np.ndarray]:
    out = [np.zeros(n) for n in p.sizes]
    for r in got.collect():
        out[r["blk"]] = np.frombuffer(r["s"], np.float64)
    return out


def pair_sums(p: Packs, member: list[np.ndarray], metric: str = "euclidean") -> list[np.ndarray]:
    """Of every member row, the sum of its distances to all members (0 of the others)."""

    def kernel(q, x, _xl, o, y, _yl):
        i, j = np.flatnonzero(member[q]), np.flatnonzero(member[o])
        if not len(i) or not len(j):
            return []
        mine, other, y = np.zeros(len(x)), np.zeros(len(y)), y[j]
        for sl in _slices(len(i), len(j)):
            d = _apart(x[i[sl]], y, metric)
            mine[i[sl]] = d.sum(axis=1)
            if q != o:
                other[j] += d.sum(axis=0)
        return [(q, mine.tobytes())] + [(o, other.tobytes())] * (q != o)

    return _by_block(p, _added(over_pairs(p, kernel, "blk int, s binary", ["blk", "s"])))


def sums_to(p: Packs, member: list[np.ndarray], to: np.ndarray, metric: str = "euclidean") -> list[np.ndarray]:
    """Of every member row, the sum of its distances to the rows ``to`` (0 of the others)."""

    def kernel(q, _ids, x, _lab):
        i, s = np.flatnonzero(member[q]), np.zeros(len(x))
        for sl in _slices(len(i), len(to)):
            s[i[sl]] = _apart(x[i[sl]], to, metric).sum(axis=1)
        return pd.DataFrame({"blk": [q], "s": [s.tobytes()]})

    return _by_block(p, over_blocks(p, kernel, "blk int, s binary"))


def vectors(p: Packs, some: list[np.ndarray]) -> np.ndarray:
    """Vectors of the rows that ``some`` marks, in order."""

    def kernel(q, _ids, x, _lab):
        return pd.DataFrame({"blk": [q], "s": [x[some[q]].tobytes()]})

    got = sorted((r["blk"], r["s"]) for r in over_blocks(p, kernel, "blk int, s binary").where(F.length("s") > 0).collect())
    return np.concatenate([_matrix(s, int(some[q].sum())) for q, s in got])


def _farthest(a: np.ndarray, b: np.ndarray, metric: str) -> float:
    """Largest distance of a row of ``a`` and one of ``b``, with the rounding of ``np_distance_matrix``."""
    most = 0.0
    for sl in _slices(len(a), len(b)):
        got = _gram(a[sl], b) if metric == "euclidean" else None
        if got is None:
            most = float(np.maximum(most, np_distance_matrix(a[sl], b, metric).max()))
            continue
        d2, err = got
        err = 2 * err[:, None]
        i, j = np.nonzero(d2 + err >= max((d2 - err).max(), most * most * (1 - 1e-12)))
        if len(i):
            most = float(np.maximum(most, pair_distances(a[sl], b, i, j).max()))
    return most


def diameters(p: Packs, lab: list[np.ndarray], clusters: Sequence[int], metric: str = "euclidean") -> dict[int, float]:
    """Largest distance of two rows of each of ``clusters``."""

    def kernel(q, x, _xl, o, y, _yl):
        out = []
        for c in clusters:
            i, j = np.flatnonzero(lab[q] == c), np.flatnonzero(lab[o] == c)
            if len(i) and len(j):
                out.append((int(c), _farthest(x[i], y[j], metric)))
        return out

    got = over_pairs(p, kernel, "c int, d double", ["c", "d"]).groupBy("c").agg(F.max("d").alias("d")).collect()
    return {r["c"]: float(r["d"]) for r in got}


def silhouettes(p: Packs, labels: np.ndarray) -> list[float | None]:
    """Mean silhouette of every labeling of the packs' rows (euclidean); ``labels``: the distinct rows of labels."""
    runs = labels.shape[1]
    place = {tuple(r): k for k, r in enumerate(labels.tolist())}

    def hot(lab):
        out = np.zeros((len(lab), len(labels)))
        out[np.arange(len(lab)), [place[tuple(r)] for r in lab.tolist()]] = 1.0
        return out

    def kernel(q, x, xl, o, y, yl):
        mine, other = hot(xl), hot(yl)
        s, t = np.zeros(mine.shape), np.zeros(other.shape)
        for sl in _slices(len(x), len(y)):
            d = distances_for_sums(x[sl], y)
            s[sl] = d @ other
            if q != o:
                t += d.T @ mine[sl]
        return [(q, s.tobytes())] + [(o, t.tobytes())] * (q != o)

    counted = over_blocks(p, lambda q, _ids, _x, lab: pd.DataFrame({"n": [hot(lab).sum(0).tolist()]}), "n array<double>").collect()
    size = np.sum([r["n"] for r in counted], axis=0)
    sums = _added(over_pairs(p, kernel, "blk int, s binary", ["blk", "s"])).withColumnRenamed("blk", "b")
    names = [np.unique(labels[:, r], return_inverse=True) for r in range(runs)]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data, s in zip(b["lab"], b["s"]):
                lab = np.frombuffer(data, np.int32).reshape(-1, runs)
                s, at, out = np.frombuffer(s, np.float64).reshape(len(lab), -1), np.arange(len(lab)), []
                for r, (values, back) in enumerate(names):
                    if len(values) < 2:
                        continue
                    into = np.zeros((len(labels), len(values)))
                    into[np.arange(len(labels)), back.ravel()] = 1.0
                    n, own = size @ into, np.searchsorted(values, lab[:, r])
                    sum_ = s @ into
                    a = sum_[at, own] / np.maximum(n[own] - 1, 1)
                    mean = sum_ / n
                    mean[at, own] = np.inf
                    near = mean.min(axis=1)
                    most = np.maximum(a, near)
                    sil = np.where((n[own] <= 1) | (most == 0), 0.0, (near - a) / np.where(most == 0, 1.0, most))
                    out.append((r, float(sil.sum()), len(sil)))
                yield pd.DataFrame(out, columns=["run", "s", "n"])

    got = sums.join(p.rows.select("blk", "lab"), F.col("b") == F.col("blk")).select("lab", "s").mapInPandas(score, "run int, s double, n long")
    mean = {r["run"]: r["m"] for r in got.groupBy("run").agg((F.sum("s") / F.sum("n")).alias("m")).collect()}
    return [mean.get(r) for r in range(runs)]
