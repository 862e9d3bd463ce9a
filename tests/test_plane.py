"""Rows of two dimensions: k-d leaves give what all pairs give, without the block join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.operators import cluster_metrics, dbscan, kmedoids, pairs, plane, select


@pytest.fixture
def rows(spark, monkeypatch):
    """700 rows in clumps, on lines, in many copies at one place and far away; leaves of about 40 points."""
    def refuse(*a, **k):
        raise AssertionError("all pairs of blocks")

    for module in (pairs, kmedoids, select):
        monkeypatch.setattr(module, "block_join", refuse)
    monkeypatch.setattr(plane, "LEAF_POINTS", 40)
    monkeypatch.setattr(plane, "_parts", lambda leaves: 3)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.3, (150, 2)) for c in (0, 4, 8)] + [
        np.stack([rng.random(190) * 9, rng.integers(0, 4, 190) * 3.0], 1), np.full((50, 2), 2.5), [[900.0, -50.0]] * 3,
        rng.random((7, 2)) * 20])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double").repartition(3)
    return df, x, np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))


def _silhouette(d, lab):
    names, n = np.unique(lab), len(lab)
    mean = np.stack([d[:, lab == c].sum(1) / max(1, (lab == c).sum()) for c in names])
    own = np.searchsorted(names, lab)
    size = np.array([(lab == c).sum() for c in names])[own]
    a = mean[own, np.arange(n)] * size / np.maximum(size - 1, 1)
    mean[own, np.arange(n)] = np.inf
    b = mean.min(0)
    return float(np.where(size == 1, 0, (b - a) / np.maximum(a, b)).mean())


@pytest.mark.parametrize("k", [4, 60])
def test_k_distances(rows, k):
    df, x, d = rows
    got = {r["id"]: r["k_dist"] for r in dbscan.k_distances(df, "id", ["a", "b"], k).collect()}
    d = d.copy()
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, k - 1]
    assert len(got) == len(x) and np.allclose([got[i] for i in range(len(x))], want, rtol=1e-12, atol=0)


def test_silhouettes(rows):
    df, x, d = rows
    rng = np.random.default_rng(6)
    labs = np.stack([(x[:, 0] > 2).astype(int) + (x[:, 1] > 5), rng.integers(-1, 3, len(x)), np.where(x[:, 0] > 100, 7, np.arange(len(x)) % 2), np.zeros(len(x), int),
                     np.where(np.arange(len(x)) == 5, 1, 0)], 1)
    v = df.select("id", F.array("a", "b").alias("vec"))
    lab = v.sparkSession.createDataFrame([(i, r.tolist()) for i, r in enumerate(labs)], "id long, labs array<int>")
    got = select.multi_silhouette(v, lab, labs.shape[1])
    assert got[3] is None
    for r in (0, 1, 2, 4):
        assert got[r] == pytest.approx(_silhouette(d, labs[:, r]), abs=1e-10)
    one = v.join(lab, "id").withColumn("cluster", F.col("labs")[1])
    assert cluster_metrics.silhouette(one).first()[0] == pytest.approx(_silhouette(d, labs[:, 1]), abs=1e-10)


def test_medoids(rows):
    df, x, d = rows
    res = kmedoids.kmedoids(df, "id", ["a", "b"], k=4, init=[0, 200, 500, 600], max_iter=2)
    ids = [0, 200, 500, 600]
    for _ in range(2):
        lab = d[:, ids].argmin(1)
        ids = [int(np.flatnonzero(lab == c)[d[np.ix_(lab == c, lab == c)].sum(1).round(9).argmin()]) for c in range(4)]
    assert res.medoid_ids == ids


def test_k_distances_of_leaves_that_ask_nobody(spark, monkeypatch):
    """A leaf whose widest bound reaches another leaf, though no point of it does."""
    tree = plane.Tree(np.array([0, -1, -1]), np.array([2.0, 0.0, 0.0]), np.array([[1, 2], [-1, -1], [-1, -1]]))
    monkeypatch.setattr(plane, "_lay_out", lambda *a: tree)
    x = np.concatenate([[-5.0], np.linspace(0, 1, 39), np.linspace(3, 4, 40)])
    df = spark.createDataFrame([(i, float(a), 0.0) for i, a in enumerate(x)], "id long, a double, b double")
    got = {r["id"]: r["k_dist"] for r in dbscan.k_distances(df, "id", ["a", "b"], 2).collect()}
    want = np.sort(np.abs(x[:, None] - x[None]), axis=1)[:, 2]
    assert np.allclose([got[i] for i in range(len(x))], want, rtol=1e-12, atol=0)


@pytest.mark.parametrize("eps", [0.0, 0.4, 30.0])
def test_counts_within(rows, eps):
    df, x, d = rows
    v = df.select("id", F.array("a", "b").alias("vec"), F.lit(None).cast("string").alias("lab"))
    got = {r["id"]: r["n"] for r in pairs.eps_neighbour_counts(v, eps).collect()}
    assert [got[i] for i in range(len(x))] == (d <= eps).sum(1).tolist()
