"""K-Means runs on all cores and takes nearest centres as the plain distances do."""

import numpy as np
from pyspark.sql import functions as F

from tabmine.functions.vectors import nearest_center
from tabmine.operators import kmeans as KM


def test_small_file_is_spread(spark, tmp_path):
    spark.range(500).selectExpr("id", "id * 1D as x", "id % 7 * 1D as y").coalesce(1).write.parquet(str(tmp_path / "t"))
    v = KM.vec_frame(spark.read.parquet(str(tmp_path / "t")), "id", ["x", "y"])
    cores = spark.sparkContext.defaultParallelism
    assert v.rdd.getNumPartitions() < cores
    out = KM._spread(v)
    assert out.rdd.getNumPartitions() == cores and out.count() == 500 and KM._spread(out).rdd.getNumPartitions() == cores


def test_nearest_and_weights_equal_plain_distances():
    rng = np.random.default_rng(4)
    for d in (1, 2, 9):
        X, C = rng.integers(0, 4, (400, d)).astype(float), rng.integers(0, 4, (6, d)).astype(float)
        X[::50, 0], X[1::50, 0] = np.nan, np.inf
        diff = X[:, None, :] - C[None]
        assert (KM._nearest(X, C) == (diff * diff).sum(2).argmin(1)).all()
        assert np.array_equal(KM._least_weight(X, C, True), (diff * diff).sum(2).min(1), equal_nan=True)
        assert np.array_equal(KM._least_weight(X, C, False), np.abs(diff).sum(2).min(1) ** 2, equal_nan=True)
    C[2, 0] = np.nan
    diff = X[:, None, :] - C[None]
    assert (KM._nearest(X, C) == (diff * diff).sum(2).argmin(1)).all()


def test_labels_of_many_runs(spark):
    """One Arrow column holds the labels of all runs: those of the expressions, ties, nulls and what is no number included."""
    rng = np.random.default_rng(1)
    rows = [(i, [None if i % 50 == 0 else float(a), float("nan") if i % 70 == 1 else float("inf") if i % 90 == 2 else float(b)])
            for i, (a, b) in enumerate(rng.integers(0, 12, (300, 2)) / 3)]
    centers = [rng.integers(0, 12, (k, 2)) / 3 for k in (2, 3, 9)] + [np.array([[np.nan, 1.0], [2.0, 2.0], [2.0, 2.0], [1.0, 3.0]])]
    v = spark.createDataFrame(rows, "id long, vec array<double>")
    each = F.array(*[nearest_center(F.col("vec"), c.tolist())["idx"].cast("int") for c in centers])
    got = v.select(KM.labels_of(F.col("vec"), centers).alias("got"), each.alias("want")).collect()
    assert len(got) == 300 and all(r["got"] == r["want"] for r in got)
