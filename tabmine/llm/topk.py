"""Exact top-k by integer inner product with a pivot table.

For a pivot p the triangle inequality gives |q - x| >= | |q - p| - |x - p| |, so with the distances of every row to many
pivots, the score q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 is at most (|q|^2 + |x|^2 - max_p(|q - p| - |x - p|)^2) / 2. Queries
and rows are dealt into blocks; a block pair is one task group. Rows are evaluated in the order of their bounds, until
the k-th best score is above the next bound. A first pass over the rows nearest the query's best pivot sets a start score
that holds for all blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 1024
PIVOTS = 48
#: Rows of which the pivots are picked, by hash of vec_id (a documented bounded sample: it changes the speed, never the result).
PIVOT_SAMPLE = 2000
BLOCK_ROWS, QUERY_ROWS = 8192, 1024
#: Rows evaluated between two looks at the bounds.
CHUNK = 512


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double, whole numbers): floor(1024 x) of each component. Rows with a null vec_id or vector, or a
    null, NaN or infinite component (1024 x beyond a double is infinite) take no part; equal rows count once."""
    x = F.col("embedding")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x")).where("vec_id is not null and x is not null")
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e * SCALE) == F.lit(float("inf"))))
    # doubles from 2^53 on are whole already; floor() itself gives a long
    floor = F.transform("x", lambda e: F.when(F.abs(e * SCALE) < 2**53, F.floor(e * SCALE).cast("double")).otherwise(e * SCALE))
    return v.where(~bad).select("vec_id", floor.alias("v")).dropDuplicates()


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pivots of a sample of vectors."""
    if not len(sample):
        return sample
    chosen, near = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(d2, 0))


def _exact(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors in a type that holds every product sum: no partial sum of q.x is above |q| |x|. float64 holds whole
    numbers up to 2^53, int64 up to 2^63; beyond, Python integers."""
    with np.errstate(over="ignore"):
        top = float(np.sqrt((q**2).sum(1).max(initial=0))) * float(np.sqrt((x**2).sum(1).max(initial=0)))
    if top < 2**52:
        return q, x
    if top < 2**62 and max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) < 2**62:
        return q.astype(np.int64), x.astype(np.int64)
    return tuple(np.array([int(v) for v in a.ravel().tolist()], object).reshape(a.shape) for a in (q, x))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return np.lexsort([ids, -scores])[:k]


def _evaluate(q: np.ndarray, qid: np.ndarray, qd: np.ndarray, x: np.ndarray, xid: np.ndarray, xd: np.ndarray, k: int, floor: np.ndarray, far: float = 0.0):
    """Best k of the rows for each query, skipping rows whose bound is under the start score. Scores are exact. Bounds are
    raised by a margin for the rounding of the distances: squared distances of whole numbers are exact below 2^53, and
    above lose up to some 1e-16 of the squared lengths, of which `far` is the largest of a pivot. Where a bound overflows,
    nothing is skipped."""
    with np.errstate(over="ignore"):
        q2, x2 = (q**2).sum(1), (x**2).sum(1)
        part = 1e-9 if 4 * max(q2.max(initial=0), x2.max(initial=0), far) < 2**53 else 1e-6
    whole_q, whole_x = _exact(q, x)
    out, looked = [], 0
    for i in range(len(q)):
        with np.errstate(over="ignore", invalid="ignore"):
            low = np.abs(xd - qd[i]).max(1) if xd.shape[1] else np.zeros(len(x))
            bound = (q2[i] + x2 - low**2) / 2
            bound += part * (q2[i] + x2 + (far if part > 1e-9 else 0)) + 1
        bound = np.where(np.isfinite(bound), bound, np.inf)
        cand = np.flatnonzero((bound >= floor[i]) & (xid != qid[i]))
        cand = cand[np.argsort(-bound[cand], kind="stable")]
        best_s, best_id, kth = np.zeros(0, whole_x.dtype), np.zeros(0, np.int64), None
        for a in range(0, len(cand), CHUNK):
            some = cand[a : a + CHUNK]
            if kth is not None and float(bound[some[0]]) < kth:
                break
            looked += len(some)
            best_s = np.concatenate([best_s, whole_x[some] @ whole_q[i]])
            best_id = np.concatenate([best_id, xid[some]])
            order = _best(best_s, best_id, k)
            best_s, best_id = best_s[order], best_id[order]
            kth = best_s[-1] if len(best_s) >= k else None
        out.append((best_s, best_id))
    return out, looked


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(col.combine_chunks().flatten(), np.float64).reshape(len(col), dim)


def _columns(scores: list[np.ndarray]) -> list[pa.Array]:
    """Scores as sortable columns: side, above 0 or below for one beyond a long; the long or null; and for one beyond a
    long its digits with their number in front (those of negative ones by complement)."""
    values = [int(v) for part in scores for v in part.tolist()]
    side = [(v >= 2**63) - (v < -(2**63)) for v in values]
    digits = [f"{len(str(abs(v))):06d}{abs(v)}" if o else None for v, o in zip(values, side)]
    turned = str.maketrans("0123456789", "9876543210")
    digits = [d.translate(turned) if o < 0 else d for d, o in zip(digits, side)]
    return [pa.array(side, pa.int32()), pa.array([None if o else v for v, o in zip(values, side)], pa.int64()), pa.array(digits, pa.string())]


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows by integer inner product for each row whose vec_id is divisible by
    `every`, among the rows with another vec_id; ties to the smaller vec_id.

    Cases: vectors of different lengths never meet, a query is compared with vectors of its own length. Rows that repeat a
    vec_id with other vectors are one query, ranked over all its vectors. Scores are exact at any size and ranked so; one
    beyond a long is returned as null. Other columns are not read. No other rows, no result rows."""
    rows = stored(integer_vectors(vectors).withColumn("dim", F.size("v")), "vectors")
    n = rows.count()
    blocks = max(1, -(-n // BLOCK_ROWS))
    q_blocks = max(1, -(-rows.where(F.pmod("vec_id", F.lit(every)) == 0).count() // QUERY_ROWS))
    share = min(1.0, PIVOT_SAMPLE / max(n, 1))
    sample = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < int(share * (1 << 30))).collect()
    by_dim: dict[int, np.ndarray] = {}
    sampled: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in sample}:
        some = sorted((r["vec_id"], r["v"]) for r in sample if r["dim"] == dim)
        sampled[dim] = np.array([v for _, v in some], np.float64).reshape(len(some), dim), np.array([i for i, _ in some], np.int64)
        by_dim[dim] = pick_pivots(sampled[dim][0], pivots)

    def none(dim: int) -> np.ndarray:
        return np.zeros((0, dim))

    def measure(batches):
        for b in batches:
            v, dims = b.column("v"), np.asarray(b.column("dim"))
            flat, ends = np.asarray(v.flatten()), np.cumsum(dims)
            far = np.zeros(len(dims), object)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                for i, row in zip(at, _pivot_distances(x, by_dim.get(dim, none(dim)))):
                    far[i] = row
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(far.tolist(), pa.list_(pa.float64()))], names=[*b.schema.names, "far"])

    # the pivot table: every row's distances to the pivots, written once
    table = stored(rows.mapInArrow(measure, "vec_id long, v array<double>, dim int, far array<double>"), "pivot_table")
    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        dim = (left if len(left) else right).column("dim")[0].as_py()
        p = by_dim.get(dim, none(dim))
        qid, xid = (np.asarray(t.column("vec_id")).astype(np.int64) for t in (left, right))
        floor = np.asarray(left.column("start")).astype(np.float64)
        with np.errstate(over="ignore"):
            far = float((p**2).sum(1).max(initial=0))
        (q, qd), (x, xd) = ((_matrix(t.column("v"), dim), _matrix(t.column("far"), len(p))) for t in (left, right))
        got, _ = _evaluate(q, qid, qd, x, xid, xd, k, floor, far)
        ids = np.concatenate([np.zeros(0, np.int64), *(i for _, i in got)])
        columns = [pa.array(np.repeat(qid, [len(s) for s, _ in got])), pa.array(ids), *_columns([s for s, _ in got])]
        return pa.Table.from_arrays(columns, names=["query_id", "vec_id", "side", "score", "digits"])

    # start scores: the k-th best score of a query among the sampled rows, a bounded block, lowered by its rounding
    def start(batches):
        for b in batches:
            values = []
            for vec_id, v in zip(b.column("vec_id").to_pylist(), b.column("v")):
                own = np.asarray(v.values)
                x, ids = sampled.get(len(own), (none(len(own)), np.zeros(0, np.int64)))
                with np.errstate(over="ignore", invalid="ignore"):
                    s = np.sort((x @ own)[ids != vec_id])
                    low = s[-k] - 1e-9 * (own @ own + (x**2).sum(1).max(initial=0)) if len(s) >= k else -np.inf
                values.append(low if np.isfinite(low) else -np.inf)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, pa.float64())], names=[*b.schema.names, "start"])

    q = table.where(F.pmod("vec_id", F.lit(every)) == 0).mapInArrow(start, "vec_id long, v array<double>, dim int, far array<double>, start double")
    q = q.withColumn("qb", F.pmod(F.xxhash64("vec_id", "v"), F.lit(q_blocks))).withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    x = table.withColumn("bb", F.pmod(F.xxhash64("v", "vec_id"), F.lit(blocks)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    keys = ["dim", "qb", "bb"]
    partial = q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInArrow(kernel, "query_id long, vec_id long, side int, score long, digits string")
    w = Window.partitionBy("query_id").orderBy(F.desc("side"), F.desc("score"), F.desc("digits"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
