"""Block kernels by matrix product: the same results as plain distance matrices, and no list of all close pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.functions import vectors as V
from tabmine.operators import cluster_metrics, dbscan, pairs


def _rows():
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(c, 1.0, (60, 8)) for c in (0, 3)])
    x[100:110] = x[0:10]  # copies, so ties
    return x + 1000.0


def _frame(spark, x):
    return spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id long, vec array<double>, label long").repartition(3)


def test_kernels_agree_with_the_plain_matrix():
    x = _rows()
    d = V.np_distance_matrix(x, x)
    assert np.allclose(V.distances_for_sums(x, x), d, rtol=1e-10, atol=0)
    for eps in (0.0, 2.5, float(d[3, 50])):
        assert (V.within(x, x, eps) == (d <= eps)).all()
    i, j, dist = V.nearest_pairs(x, x, 4)
    order = np.argsort(d, axis=1, kind="stable")[:, :4]
    assert (j.reshape(-1, 4) == order).all() and (dist.reshape(-1, 4) == np.take_along_axis(d, order, 1)).all()
    x[5, 2] = np.nan
    assert V.nearest_pairs(x, x, 4) is None


def test_joins_with_slices(spark, monkeypatch):
    x = _rows()
    d = V.np_distance_matrix(x, x)
    df = _frame(spark, x)
    monkeypatch.setattr(pairs, "SLICE_CELLS", 200)
    rows = df.select("id", "vec", F.lit(None).cast("string").alias("lab"))
    got = {(r["q_id"], r["rank"]): (r["b_id"], r["dist"]) for r in pairs.knn_join(rows, rows, 3, exclude_self=True, block_rows=50).collect()}
    far = d.copy()
    np.fill_diagonal(far, np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    assert got == {(i, r + 1): (order[i, r], far[i, order[i, r]]) for i in range(len(x)) for r in range(3)}
    counts = {r["id"]: r["n"] for r in pairs.eps_neighbour_counts(rows, 3.0, block_rows=50).collect()}
    assert counts == dict(enumerate((d <= 3.0).sum(1)))
    lab, n = np.arange(len(x)) % 3, np.array([40, 40, 40])
    mean = np.stack([d[:, lab == c].sum(1) / (n[c] - (lab == c)) for c in range(3)])
    a = mean[lab, np.arange(len(x))]
    mean[lab, np.arange(len(x))] = np.inf
    b = mean.min(0)
    assert cluster_metrics.silhouette(df, cluster="label", block_rows=50).first()[0] == pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-10)


def test_dense_rows_make_few_links(spark):
    x = np.random.default_rng(2).normal(size=(300, 5)) * 0.01
    x[150:] += 5.0
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").withColumn("lab", F.lit(None).cast("string"))
    links = pairs.eps_links(rows, 1.0, block_rows=100).collect()
    assert len(links) <= 300 * 6 and all((r["a"] < 150) == (r["b"] < 150) for r in links)
    wide = rows.select("id", *[F.col("vec")[k].alias(f"f{k}") for k in range(5)])
    got = {r["id"]: r["cluster"] for r in dbscan.dbscan(wide, "id", [f"f{k}" for k in range(5)], eps=1.0).collect()}
    assert got == {i: int(i >= 150) for i in range(300)}
