"""Rows of one or two dimensions: k-d leaves instead of all pairs of blocks.

The distinct points (with the number of their rows) are dealt into leaves of about LEAF_POINTS points by a binary tree of
boxes, laid out on a sample of bounded size; the sample decides the leaves' sizes, never a result. A leaf is one row.

- ``kth_distances``: the k nearest rows inside the leaf bound the answer; only leaves whose box lies within that bound are
  asked. The cost grows with the points.
- ``within_counts``: a leaf asks the leaves within eps; boxes wholly within it are counted whole.
- ``diameter``: between corners of the convex hull.
- ``leaf_sums``: for every point and cluster the sum of Euclidean distances to the cluster's rows. Leaves near the point's
  leaf are summed pair by pair. A far box acts through weights at ORDER Chebyshev points a side, which carry its rows'
  sums: seen from GAP sides away the distance is analytic there, so the error falls as 6^-ORDER (about 1e-10 of the sum
  at worst). A point so meets some near leaves and a few boxes a level, not all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

LEAF_POINTS = 1024
#: Sampled points that lay out the tree, and the fewest of them in a leaf: up to SAMPLE_POINTS / SAMPLE_LEAF leaves.
SAMPLE_POINTS, SAMPLE_LEAF = 200_000, 8
#: Chebyshev points a side of a far box, and the distance in sides from which a box is far.
ORDER, GAP = 12, 1.5
#: Boxes of more leaves are always taken in parts, which bounds the messages of one box.
TOP_LEAVES = 256
#: Part of the least cost by which a sum may be off, with room.
SLACK = 1e-8
#: Clusters of all labelings together that one matrix holds.
MAX_COLUMNS = 4096
#: Corners of tasks' hulls that the driver takes.
HULL_POINTS = 16_384
#: Coordinates up to which squares stay finite.
LARGEST = 1e150

_BLOB = "leaf int, n long, x0 double, x1 double, y0 double, y1 double, xy binary, m binary, lab binary"


@dataclass
class Tree:
    axis: np.ndarray  # -1: leaf
    cut: np.ndarray
    kids: np.ndarray
    box: np.ndarray | None = None  # x0, x1, y0, y1 of the points
    points: np.ndarray | None = None
    rows: np.ndarray | None = None
    leaves: np.ndarray | None = None

    def leaf_of(self, xy: np.ndarray) -> np.ndarray:
        at, row = np.zeros(len(xy), np.int64), np.arange(len(xy))
        while True:
            a = self.axis[at]
            if (a < 0).all():
                return at
            right = xy[row, np.maximum(a, 0)] >= self.cut[at]
            at = np.where(a >= 0, self.kids[at, right.astype(int)], at)

    def tops(self) -> list[int]:
        """Largest boxes of at most TOP_LEAVES leaves."""
        out, todo = [], [0]
        while todo:
            q = todo.pop()
            if self.points[q]:
                if self.leaves[q] <= TOP_LEAVES:
                    out.append(q)
                else:
                    todo.extend(self.kids[q].tolist())
        return out


@dataclass
class Leaves:
    blobs: DataFrame
    tree: Tree
    runs: int
    sizes: list[np.ndarray]  # rows of each cluster, per labeling


def fits(df: DataFrame, id_col: str, vec: str, labels: Column | None = None) -> bool:
    """The leaves serve tables of one or two dimensions whose ids are distinct, whose coordinates are finite numbers and
    whose labels (a number or an array) are known."""
    first = df.select(vec).first()
    dims = len(first[0]) if first and first[0] is not None else 0
    if not 1 <= dims <= 2:
        return False
    v = F.col(vec)
    ok = v.isNotNull() & (F.size(v) == dims) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    if labels is not None:
        ok = ok & labels
    got = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("ids"), F.count_if(F.coalesce(ok, F.lit(False))).alias("ok")).first()
    return got["n"] == got["ids"] == got["ok"]


def places(vec: str) -> list[Column]:
    """x and y of a vector of one or two dimensions."""
    v = F.col(vec)
    return [v[0].cast("double").alias("x"), F.coalesce(F.get(v, 1).cast("double"), F.lit(0.0)).alias("y")]


def _lay_out(sample: np.ndarray, share: float, leaf_points: int) -> Tree:
    axis, cut, kids = [], [], []
    todo = [(sample, -1, 0)]
    while todo:
        s, parent, side = todo.pop()
        k = len(axis)
        axis.append(-1)
        cut.append(0.0)
        kids.append([-1, -1])
        if parent >= 0:
            kids[parent][side] = k
        if len(s) * share <= leaf_points or len(s) < 2 * SAMPLE_LEAF:
            continue
        a = int(np.argmax(np.ptp(s, axis=0)))
        v = np.sort(s[:, a])
        c = v[len(v) // 2]
        if c == v[0]:
            above = v[v > c]
            if not len(above):
                continue
            c = above[0]
        axis[k], cut[k] = a, c
        right = s[:, a] >= c
        todo += [(s[right], k, 1), (s[~right], k, 0)]
    return Tree(np.array(axis), np.array(cut), np.array(kids))


def plant(points: DataFrame, labelings: Sequence[Sequence[int]] = (), leaf_points: int | None = None) -> Leaves:
    """``points``: x, y, m (rows at the point), labs ARRAY<BIGINT> of the point in each labeling; no two rows with equal
    x, y and labs. ``labelings``: the sorted labels of each labeling."""
    leaf_points = leaf_points or LEAF_POINTS
    points = cut_lineage(points.select("x", "y", "m", "labs"))
    spots = points.select("x", "y").distinct()
    n = points.count()
    rate = max(4, -(-n // SAMPLE_POINTS))
    some = spots.where(F.pmod(F.xxhash64("x", "y"), F.lit(rate)) == 0) if n > leaf_points else spots.limit(1)
    sample = np.array([(r["x"], r["y"]) for r in some.collect()] or [(0.0, 0.0)], np.float64)
    tree = _lay_out(sample, n / len(sample), leaf_points)
    values = [np.asarray(v, np.int64) for v in labelings]

    @F.pandas_udf("int")
    def leaf(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(tree.leaf_of(np.stack([x.to_numpy(np.float64), y.to_numpy(np.float64)], 1)).astype(np.int32))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        xy = pdf[["x", "y"]].to_numpy(np.float64)
        lab = np.array(pdf["labs"].tolist(), np.int64).reshape(len(xy), len(values))
        lab = np.stack([np.searchsorted(v, lab[:, r]) for r, v in enumerate(values)], 1) if values else lab
        (x0, y0), (x1, y1) = xy.min(0), xy.max(0)
        return pd.DataFrame({"leaf": [pdf["leaf"].iloc[0]], "n": [len(xy)], "x0": [x0], "x1": [x1], "y0": [y0], "y1": [y1],
                             "xy": [xy.tobytes()], "m": [pdf["m"].to_numpy(np.int64).tobytes()], "lab": [lab.astype(np.int32).tobytes()]})

    blobs = cut_lineage(points.withColumn("leaf", leaf("x", "y")).groupBy("leaf").applyInPandas(pack, _BLOB))
    return _measured(Leaves(blobs, tree, len(values), []), [len(v) for v in values])


def _measured(leaves: Leaves, ks: Sequence[int]) -> Leaves:
    """With the boxes of the nodes and the sizes of the clusters."""
    t, runs = leaves.tree, len(ks)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for leaf, n, m, lab in zip(b["leaf"], b["n"], b["m"], b["lab"]):
                m, lab = np.frombuffer(m, np.int64), np.frombuffer(lab, np.int32).reshape(n, runs)
                out = [(leaf, -1, -1, int(m.sum()))]
                for r in range(runs):
                    got = np.bincount(lab[:, r], m).astype(np.int64)
                    out += [(-1, r, int(c), int(got[c])) for c in np.flatnonzero(got)]
                yield pd.DataFrame(out, columns=["leaf", "run", "lab", "m"])

    counted = leaves.blobs.select("leaf", "n", "m", "lab").mapInPandas(rows, "leaf int, run int, lab int, m long")
    counted = counted.groupBy("leaf", "run", "lab").agg(F.sum("m").alias("m")).collect()
    sizes = [np.zeros(k, np.int64) for k in ks]
    nodes = len(t.axis)
    box = np.tile([np.inf, -np.inf, np.inf, -np.inf], (nodes, 1))
    points, total, below = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    for r in counted:
        if r["run"] < 0:
            total[r["leaf"]] = r["m"]
        else:
            sizes[r["run"]][r["lab"]] = r["m"]
    for r in leaves.blobs.select("leaf", "n", "x0", "x1", "y0", "y1").collect():
        box[r["leaf"]], points[r["leaf"]], below[r["leaf"]] = (r["x0"], r["x1"], r["y0"], r["y1"]), r["n"], 1
    for q in range(nodes - 1, -1, -1):  # children come after their parent
        if t.axis[q] >= 0:
            a, b = t.kids[q]
            box[q] = [min(box[a][0], box[b][0]), max(box[a][1], box[b][1]), min(box[a][2], box[b][2]), max(box[a][3], box[b][3])]
            points[q], total[q], below[q] = points[a] + points[b], total[a] + total[b], below[a] + below[b]
    return replace(leaves, tree=replace(t, box=box, points=points, rows=total, leaves=below), sizes=sizes, runs=runs)


def relabelled(leaves: Leaves, label: Callable[[np.ndarray], np.ndarray], k: int) -> Leaves:
    """The same leaves with one labeling, computed from the coordinates: 0 to k - 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["lab"] = [label(np.frombuffer(xy, np.float64).reshape(-1, 2)).astype(np.int32).tobytes() for xy in b["xy"]]
            yield b

    return _measured(replace(leaves, blobs=leaves.blobs.mapInPandas(run, _BLOB)), [k])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a[:, :1] - b[None, :, 0]
    d *= d
    e = a[:, 1:] - b[None, :, 1]
    e *= e
    d += e
    return np.sqrt(d, out=d)


def _parts(leaves: Leaves) -> int:
    """Partitions of a job over the leaves: enough for every core, bounded leaves in each."""
    n = int(leaves.tree.leaves[0])
    return max(1, min(n, max(4 * leaves.blobs.sparkSession.sparkContext.defaultParallelism, n // 64)))


# ---- distance to the k-th nearest row ----------------------------------------------------


def _nearest(q: np.ndarray, xy: np.ndarray, m: np.ndarray, own: np.ndarray | None, k: int) -> np.ndarray:
    """Ascending distances to the k nearest rows (inf: there are fewer); ``own``: the queries' places in xy."""
    out = np.full((len(q), k), np.inf)
    step = max(1, 1_000_000 // max(1, len(xy)))
    for i in range(0, len(q), step):
        d = _distances(q[i:i + step], xy)
        w = np.broadcast_to(m, d.shape)
        if own is not None:
            w = w.copy()
            w[np.arange(len(d)), own[i:i + step]] -= 1
        least = min(k + 1, d.shape[1])
        at = np.argpartition(d, least - 1, axis=1)[:, :least]
        near = np.take_along_axis(d, at, 1)
        by = np.argsort(near, axis=1, kind="stable")
        near, w = np.take_along_axis(near, by, 1), np.take_along_axis(np.take_along_axis(w, at, 1), by, 1)
        upto = np.cumsum(w, axis=1)
        for r in range(k):
            has = upto[:, -1] > r
            out[i:i + step][has, r] = near[has, (upto[has] > r).argmax(1)]
    return out


def kth_distances(points: DataFrame, k: int) -> DataFrame:
    """x, y, k_dist (distance to the k-th nearest other row) of every point of ``points`` (x, y, m)."""
    leaves = plant(points.select("x", "y", "m", F.array().cast("array<bigint>").alias("labs")))
    t = leaves.tree
    ids = np.flatnonzero((t.axis < 0) & (t.points > 0))
    box, rows = t.box[ids], t.rows[ids]
    schema = "ask int, x double, y double, d array<double>"

    def gaps(q: np.ndarray, b: np.ndarray) -> np.ndarray:
        dx = np.maximum(0, np.maximum(b[None, :, 0] - q[:, :1], q[:, :1] - b[None, :, 1]))
        dy = np.maximum(0, np.maximum(b[None, :, 2] - q[:, 1:], q[:, 1:] - b[None, :, 3]))
        return np.sqrt(dx * dx + dy * dy)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for leaf, xy, m in zip(b["leaf"], b["xy"], b["m"]):
                xy, m = np.frombuffer(xy, np.float64).reshape(-1, 2), np.frombuffer(m, np.int64)
                d = _nearest(xy, xy, m, np.arange(len(xy)), k)
                yield pd.DataFrame({"ask": -1, "x": xy[:, 0], "y": xy[:, 1], "d": list(d)})
                bound = d[:, -1].copy()
                lone = np.flatnonzero(~np.isfinite(bound))
                full = np.flatnonzero((rows >= k) & (ids != leaf))
                if len(lone) and len(full):  # too few rows here: another leaf has enough, however far its corners are
                    far_x = np.maximum(np.abs(xy[lone, :1] - box[None, full, 0]), np.abs(xy[lone, :1] - box[None, full, 1]))
                    far_y = np.maximum(np.abs(xy[lone, 1:] - box[None, full, 2]), np.abs(xy[lone, 1:] - box[None, full, 3]))
                    bound[lone] = np.sqrt(far_x * far_x + far_y * far_y).min(1)
                own = t.box[leaf]
                dx = np.maximum(0, np.maximum(box[:, 0] - own[1], own[0] - box[:, 1]))
                dy = np.maximum(0, np.maximum(box[:, 2] - own[3], own[2] - box[:, 3]))
                some = np.flatnonzero((np.sqrt(dx * dx + dy * dy) <= bound.max() * (1 + 1e-9)) & (ids != leaf))
                step = max(1, 1_000_000 // max(1, len(some)))
                for i in range(0, len(xy) if len(some) else 0, step):
                    q, s = np.nonzero(gaps(xy[i:i + step], box[some]) <= bound[i:i + step, None] * (1 + 1e-9))
                    if len(q):  # a column of no lists has no type that Arrow makes lists of
                        yield pd.DataFrame({"ask": ids[some[s]].astype(np.int32), "x": xy[i + q, 0], "y": xy[i + q, 1], "d": [[]] * len(q)})

    spread = leaves.blobs.select("leaf", "xy", "m").repartition(_parts(leaves), "leaf")
    first = cut_lineage(spread.mapInPandas(local, schema))

    def answer(asked: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({"ask": pd.Series([], dtype="int32"), "x": pd.Series([], dtype=float), "y": pd.Series([], dtype=float), "d": pd.Series([], dtype=object)})
        xy, m = np.frombuffer(base["xy"].iloc[0], np.float64).reshape(-1, 2), np.frombuffer(base["m"].iloc[0], np.int64)
        d = _nearest(asked[["x", "y"]].to_numpy(np.float64), xy, m, None, k)
        return pd.DataFrame({"ask": -1, "x": asked["x"], "y": asked["y"], "d": list(d)})

    asked = first.where("ask >= 0").withColumnRenamed("ask", "leaf").select("leaf", "x", "y")
    more = asked.repartition(_parts(leaves), "leaf").groupBy("leaf").cogroup(spread.groupBy("leaf")).applyInPandas(answer, schema)
    every = first.where("ask < 0").unionByName(more).groupBy("x", "y").agg(F.array_sort(F.flatten(F.collect_list("d"))).alias("d"))
    kth = F.element_at("d", k)
    return every.select("x", "y", kth.alias("k_dist")).where(F.col("k_dist") < F.lit(float("inf")))


# ---- rows within a distance ----------------------------------------------------------------


def within_counts(points: DataFrame, eps: float) -> DataFrame:
    """x, y, n (rows within eps, its own included) of every point of ``points`` (x, y, m): a leaf asks those whose boxes lie
    within eps of its own."""
    leaves = plant(points.select("x", "y", "m", F.array().cast("array<bigint>").alias("labs")))
    t = leaves.tree
    ids = np.flatnonzero((t.axis < 0) & (t.points > 0))
    box, rows, reach = t.box[ids], t.rows[ids], eps * (1 + 1e-9)

    def inside(leaf: int) -> np.ndarray:
        """Leaves of which all points lie within eps of all of this leaf's."""
        x0, x1, y0, y1 = t.box[leaf]
        dx, dy = np.maximum(x1 - box[:, 0], box[:, 1] - x0), np.maximum(y1 - box[:, 2], box[:, 3] - y0)
        return np.sqrt(dx * dx + dy * dy) <= eps * (1 - 1e-9)

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for leaf in b["leaf"]:
                x0, x1, y0, y1 = t.box[leaf]
                dx = np.maximum(0, np.maximum(box[:, 0] - x1, x0 - box[:, 1]))
                dy = np.maximum(0, np.maximum(box[:, 2] - y1, y0 - box[:, 3]))
                src = ids[(np.sqrt(dx * dx + dy * dy) <= reach) & ~inside(leaf)]
                yield pd.DataFrame({"leaf": np.int32(leaf), "src": src.astype(np.int32)})

    def whole(q: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Points that have all of a box within eps."""
        dx = np.maximum(np.abs(q[:, 0] - b[0]), np.abs(q[:, 0] - b[1]))
        dy = np.maximum(np.abs(q[:, 1] - b[2]), np.abs(q[:, 1] - b[3]))
        return np.sqrt(dx * dx + dy * dy) <= eps * (1 - 1e-9)

    def none(q: np.ndarray, b: np.ndarray) -> np.ndarray:
        dx = np.maximum(0, np.maximum(b[0] - q[:, 0], q[:, 0] - b[1]))
        dy = np.maximum(0, np.maximum(b[2] - q[:, 1], q[:, 1] - b[3]))
        return np.sqrt(dx * dx + dy * dy) > reach

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for leaf, src, xy, sxy, m in zip(b["leaf"], b["src"], b["xy"], b["sxy"], b["m"]):
                xy, sxy, m = np.frombuffer(xy, np.float64).reshape(-1, 2), np.frombuffer(sxy, np.float64).reshape(-1, 2), np.frombuffer(m, np.int64)
                n = np.where(whole(xy, t.box[src]), m.sum(), 0)
                some = np.flatnonzero((n == 0) & ~none(xy, t.box[src]))
                for i in range(0, len(some), 512):
                    n[some[i:i + 512]] = np.where(_distances(xy[some[i:i + 512]], sxy) <= eps, m, 0).sum(1)
                yield pd.DataFrame({"leaf": [leaf], "n": [n.astype(np.int64).tobytes()]})

    def add(pdf: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        xy = np.frombuffer(base["xy"].iloc[0], np.float64).reshape(-1, 2)
        n = np.full(len(xy), rows[inside(int(base["leaf"].iloc[0]))].sum())
        for v in pdf["n"]:
            n += np.frombuffer(v, np.int64)
        return pd.DataFrame({"x": xy[:, 0], "y": xy[:, 1], "n": n})

    parts = _parts(leaves)
    pairs = leaves.blobs.select("leaf").repartition(parts, "leaf").mapInPandas(asked, "leaf int, src int")
    own = leaves.blobs.select("leaf", "xy")
    other = leaves.blobs.select(F.col("leaf").alias("src"), F.col("xy").alias("sxy"), "m")
    met = pairs.join(other, "src").join(own, "leaf").select("leaf", "src", "xy", "sxy", "m")
    counted = met.mapInPandas(count, "leaf int, n binary")
    return counted.repartition(parts, "leaf").groupBy("leaf").cogroup(own.groupBy("leaf")).applyInPandas(add, "x double, y double, n long")


# ---- largest distance ------------------------------------------------------------------------


def _hull(xy: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of some points."""
    xy = xy[np.lexsort([xy[:, 1], xy[:, 0]])]
    start = np.flatnonzero(np.append(True, xy[1:, 0] != xy[:-1, 0]))
    low, high = xy[start], xy[np.append(start[1:], len(xy)) - 1]

    def chain(points: list, turn: int) -> list:
        out: list = []
        for x, y in points:
            while len(out) > 1 and turn * ((out[-1][0] - out[-2][0]) * (y - out[-2][1]) - (out[-1][1] - out[-2][1]) * (x - out[-2][0])) <= 0:
                out.pop()
            out.append((x, y))
        return out

    return np.unique(chain(low.tolist(), 1) + chain(high.tolist(), -1), axis=0)


def diameter(points: DataFrame) -> float | None:
    """Largest distance of two of ``points`` (x, y): it lies between corners of their hull, which is that of the tasks' hulls.
    None: more than HULL_POINTS corners."""

    def corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros((0, 2))
        for b in batches:
            if len(b):
                own = _hull(np.concatenate([own, b[["x", "y"]].to_numpy(np.float64)]))
        yield pd.DataFrame({"x": own[:, 0], "y": own[:, 1]})

    got = points.select("x", "y").mapInPandas(corners, "x double, y double").distinct().limit(HULL_POINTS + 1).collect()
    if len(got) > HULL_POINTS:
        return None
    xy = _hull(np.array([(r["x"], r["y"]) for r in got], np.float64))
    step = max(1, 1_000_000 // len(xy))
    return max(float(_distances(xy[i:i + step], xy).max()) for i in range(0, len(xy), step))


# ---- distance sums -----------------------------------------------------------------------


def _grid(box: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chebyshev places of a box: along x, along y, and all of them; a side without length has one."""
    t = np.cos((2 * np.arange(ORDER) + 1) * np.pi / (2 * ORDER))
    gx, gy = ((lo + hi) / 2 + (t if hi > lo else np.zeros(1)) * (hi - lo) / 2 for lo, hi in (box[:2], box[2:]))
    return gx, gy, np.stack([np.repeat(gx, len(gy)), np.tile(gy, len(gx))], 1)


def _basis(v: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """Lagrange polynomials of the Chebyshev places at v."""
    if hi <= lo:
        return np.ones((len(v), 1))
    k = np.arange(ORDER)
    at = np.arccos(np.clip((v - (lo + hi) / 2) / ((hi - lo) / 2), -1, 1))
    nodes = (2 * k + 1) * np.pi / (2 * ORDER)
    c = np.cos(k[:, None] * nodes[None, :]) * (2 / ORDER)
    c[0] /= 2
    return np.cos(at[:, None] * k[None, :]) @ c


def _shares(lab: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label rows and the rows' numbers (label rows x points): one label row for each distinct row of ``lab``, or for each
    single label if these are fewer; a label of -1 counts in no cluster."""
    place, runs = np.arange(len(lab)), lab.shape[1]
    single = [np.unique(lab[:, r], return_inverse=True) for r in range(runs)]
    rows, back = (single[0][0][:, None], single[0][1]) if runs == 1 else np.unique(lab, axis=0, return_inverse=True)
    if len(rows) <= sum(len(v) for v, _ in single):
        out = np.zeros((len(rows), len(lab)))
        out[back.ravel(), place] = m
        return rows, out
    labs, out, at = np.full((sum(len(v) for v, _ in single), runs), -1, lab.dtype), [], 0
    for r, (values, back) in enumerate(single):
        labs[at:at + len(values), r] = values
        part = np.zeros((len(values), len(lab)))
        part[back.ravel(), place] = m
        out.append(part[values >= 0])
        at += len(values)
    return labs[(labs >= 0).any(1)], np.concatenate(out)


def _moments(leaves: Leaves) -> DataFrame:
    """node, lab, w: the weights of every box at its Chebyshev places, by label rows."""
    t, runs = leaves.tree, leaves.runs
    up = np.full(len(t.axis), -1)
    for q in range(len(t.axis)):
        if t.axis[q] >= 0:
            up[t.kids[q]] = q

    def of_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for leaf, n, xy, m, lab in zip(b["leaf"], b["n"], b["xy"], b["m"], b["lab"]):
                xy = np.frombuffer(xy, np.float64).reshape(-1, 2)
                labs, share = _shares(np.frombuffer(lab, np.int32).reshape(n, runs), np.frombuffer(m, np.int64))
                rows, q = [], leaf
                while q >= 0 and t.leaves[q] <= TOP_LEAVES:
                    x0, x1, y0, y1 = t.box[q]
                    w = share @ (_basis(xy[:, 0], x0, x1)[:, :, None] * _basis(xy[:, 1], y0, y1)[:, None, :]).reshape(n, -1)
                    rows.append((q, labs.tobytes(), w.tobytes()))
                    q = int(up[q])
                yield pd.DataFrame(rows, columns=["node", "lab", "w"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        lab = np.concatenate([np.frombuffer(v, np.int32).reshape(-1, runs) for v in pdf["lab"]])
        w = np.concatenate([np.frombuffer(w, np.float64).reshape(len(v) // (4 * runs), -1) for v, w in zip(pdf["lab"], pdf["w"])])
        lab, share = _shares(lab, np.ones(len(lab)))
        w = share @ w
        return pd.DataFrame({"node": [pdf["node"].iloc[0]], "lab": [lab.tobytes()], "w": [w.tobytes()]})

    schema = "node int, lab binary, w binary"
    spread = leaves.blobs.select("leaf", "n", "xy", "m", "lab").repartition(_parts(leaves), "leaf")
    return spread.mapInPandas(of_leaf, schema).repartition(_parts(leaves), "node").groupBy("node").applyInPandas(add, schema)


def _seen(t: Tree, tops: list[int], leaf: int) -> tuple[list[int], list[int]]:
    """Leaves near a leaf (itself included) and far boxes, which together hold every point once."""
    x0, x1, y0, y1 = t.box[leaf]
    near, far, todo = [], [], list(tops)
    while todo:
        q = todo.pop()
        if not t.points[q]:
            continue
        a0, a1, b0, b1 = t.box[q]
        gap = np.hypot(max(0.0, a0 - x1, x0 - a1), max(0.0, b0 - y1, y0 - b1))
        sides = (ORDER if a1 > a0 else 1) * (ORDER if b1 > b0 else 1)
        if gap > 0 and gap >= GAP * max(a1 - a0, b1 - b0) and (t.axis[q] >= 0 or t.points[q] > sides):
            far.append(q)
        elif t.axis[q] < 0:
            near.append(q)
        else:
            todo.extend(t.kids[q].tolist())
    return near, far


def leaf_sums(leaves: Leaves, kernel: Callable[..., pd.DataFrame], schema: str) -> DataFrame:
    """``kernel(xy, m, lab, sums)`` of every leaf: ``sums[r]`` is (clusters x points), the distances from each point to
    all rows of each cluster of labeling r."""
    t, runs = leaves.tree, leaves.runs
    ks = [len(s) for s in leaves.sizes]
    first = np.concatenate([[0], np.cumsum(ks)])
    tops = t.tops()

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for leaf in b["leaf"]:
                near, far = _seen(t, tops, leaf)
                yield pd.DataFrame({"leaf": np.int32(leaf), "far": np.repeat([False, True], [len(near), len(far)]), "src": np.array(near + far, np.int32)})

    asked = leaves.blobs.select("leaf").repartition(_parts(leaves), "leaf").mapInPandas(pairs, "leaf int, far boolean, src int")
    blobs = leaves.blobs.select(F.col("leaf").alias("src"), "xy", "m", "lab")
    near = asked.where("not far").join(blobs, "src").select("leaf", "far", "src", "xy", F.col("m").alias("w"), "lab")
    none = F.lit(None).cast("binary")
    far = asked.where("far").join(_moments(leaves), F.col("src") == F.col("node")).select("leaf", "far", "src", none.alias("xy"), "w", "lab")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf = int(pdf["leaf"].iloc[0])
        own = pdf[(pdf["src"] == leaf) & ~pdf["far"]].iloc[0]
        xy = np.frombuffer(own["xy"], np.float64).reshape(-1, 2)
        sums = np.zeros((int(first[-1]), len(xy)))
        for far_, src, sxy, w, lab in zip(pdf["far"], pdf["src"], pdf["xy"], pdf["w"], pdf["lab"]):
            lab = np.frombuffer(lab, np.int32).reshape(-1, runs)
            if far_:
                places, weights = _grid(t.box[src])[2], np.frombuffer(w, np.float64).reshape(len(lab), -1)
            else:
                places, m = np.frombuffer(sxy, np.float64).reshape(-1, 2), np.frombuffer(w, np.int64)
                lab, weights = _shares(lab, m)
            got = np.zeros((len(lab), len(xy)))
            for i in range(0, len(places), 256):
                got += weights[:, i:i + 256] @ _distances(xy, places[i:i + 256]).T
            for r in range(runs):
                some = lab[:, r] >= 0
                np.add.at(sums, first[r] + lab[some, r], got[some])
        lab = np.frombuffer(own["lab"], np.int32).reshape(-1, runs)
        return kernel(xy, np.frombuffer(own["w"], np.int64), lab, [sums[first[r]:first[r + 1]] for r in range(runs)])

    return near.unionByName(far).repartition(_parts(leaves), "leaf").groupBy("leaf").applyInPandas(run, schema)


def silhouettes(rows: DataFrame, n_runs: int) -> list[float | None] | None:
    """Mean silhouette of each labeling of ``rows`` (x, y, labs ARRAY<BIGINT>); None if the clusters are too many for one
    matrix. A row alone in its cluster scores 0, a labeling of one cluster None."""
    found = rows.select(F.posexplode("labs").alias("run", "lab")).groupBy("run", "lab").count().limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        return None
    labelings = [sorted(r["lab"] for r in found if r["run"] == k) for k in range(n_runs)]
    points = rows.groupBy("x", "y", "labs").agg(F.count(F.lit(1)).alias("m"))
    leaves = plant(points, labelings)
    sizes = leaves.sizes

    def kernel(xy, m, lab, sums):
        out, at = [], np.arange(len(xy))
        for r, s in enumerate(sums):
            n, own = sizes[r].astype(np.float64)[:, None], lab[:, r]
            if len(n) < 2:
                continue
            a = s[own, at] / np.maximum(n[own, 0] - 1, 1)
            mean = s / n
            mean[own, at] = np.inf
            b = mean.min(0)
            most = np.maximum(a, b)
            sil = np.where((n[own, 0] <= 1) | (most == 0), 0.0, (b - a) / np.where(most == 0, 1.0, most))
            out.append((r, float((sil * m).sum()), int(m.sum())))
        return pd.DataFrame(out, columns=["run", "s", "m"])

    got = leaf_sums(leaves, kernel, "run int, s double, m long").groupBy("run").agg((F.sum("s") / F.sum("m")).alias("s")).collect()
    mean = {r["run"]: r["s"] for r in got}
    return [mean.get(r) for r in range(n_runs)]


def cheapest(leaves: Leaves) -> list[tuple[int, float, float, float]]:
    """(cluster, cost, x, y) of the points that can have the least distance to the rows of their cluster (first labeling):
    those that the sums of ``leaf_sums`` leave within SLACK of it, with costs added up row by row."""

    def kernel(xy, m, lab, sums):
        cost = sums[0][lab[:, 0], np.arange(len(xy))]
        least = np.full(len(sums[0]), np.inf)
        np.minimum.at(least, lab[:, 0], cost)
        some = np.flatnonzero(cost <= least[lab[:, 0]] * (1 + SLACK))
        return pd.DataFrame({"c": lab[some, 0], "cost": cost[some], "x": xy[some, 0], "y": xy[some, 1]})

    near = cut_lineage(leaf_sums(leaves, kernel, "c int, cost double, x double, y double"))
    least = near.groupBy("c").agg(F.min("cost").alias("least"))
    left = near.join(F.broadcast(least), "c").where(F.col("cost") <= F.col("least") * (1 + SLACK)).select("c", "x", "y").collect()
    place = np.array([(r["x"], r["y"]) for r in left], np.float64)
    cluster = np.array([r["c"] for r in left])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(place))
        for b in batches:
            for xy, m, lab in zip(b["xy"], b["m"], b["lab"]):
                xy, m, lab = np.frombuffer(xy, np.float64).reshape(-1, 2), np.frombuffer(m, np.int64), np.frombuffer(lab, np.int32)
                for i in range(0, len(place), 256):
                    total[i:i + 256] += (_distances(place[i:i + 256], xy) * np.where(cluster[i:i + 256, None] == lab, m, 0)).sum(1)
        yield pd.DataFrame({"at": np.arange(len(place)), "cost": total})

    spread = leaves.blobs.select("leaf", "xy", "m", "lab").repartition(_parts(leaves), "leaf")
    costs = spread.mapInPandas(exact, "at long, cost double").groupBy("at").agg(F.sum("cost").alias("cost")).collect()
    return [(left[r["at"]]["c"], r["cost"], left[r["at"]]["x"], left[r["at"]]["y"]) for r in costs]
