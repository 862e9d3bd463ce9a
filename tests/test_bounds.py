"""Tables above the broadcast bounds give the results of the small ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.operators import class_metrics, cluster_metrics, runs


def points(spark, n=400, k=23, d=3):
    rng = np.random.default_rng(11)
    lab = rng.integers(-1, k, n)
    x = rng.normal(size=(n, d)) + lab[:, None]
    x[lab == 4] = x[lab == 4][0]  # no spread
    x[lab == 5] = x[lab == 4][0]  # and the same centroid
    df = spark.createDataFrame([(i, x[i].tolist(), int(lab[i])) for i in range(n)], "id long, vec array<double>, cluster int")
    return df, x, lab


def test_davies_bouldin_and_calinski_harabasz_above_the_bound(spark, monkeypatch):
    df, x, lab = points(spark)
    labs = np.unique(lab)
    cen = np.array([x[lab == v].mean(0) for v in labs])
    s = np.array([np.sqrt(((x[lab == v] - c) ** 2).sum(1)).mean() for v, c in zip(labs, cen)])
    cd = np.sqrt(((cen[:, None] - cen[None]) ** 2).sum(2))
    cd[cd < 1e-12] = np.inf
    db = ((s[:, None] + s[None]) / cd).max(1).mean()
    w = sum(((x[lab == v] - c) ** 2).sum() for v, c in zip(labs, cen))
    b = sum((lab == v).sum() * ((c - x.mean(0)) ** 2).sum() for v, c in zip(labs, cen))
    ch = (b / (len(labs) - 1)) / (w / (len(x) - len(labs)))
    for bound in (1_000_000, 2):
        monkeypatch.setattr(cluster_metrics, "BROADCAST_CELLS", bound)
        assert cluster_metrics.davies_bouldin(df, block_rows=5).first()[0] == pytest.approx(db)
        assert cluster_metrics.calinski_harabasz(df).first()[0] == pytest.approx(ch)


def test_squared_silhouette_above_the_bound(spark, monkeypatch):
    df, _, _ = points(spark)
    df = df.where("cluster not in (4, 5)").union(spark.createDataFrame([(1000, [3.0, 2.0, 9.0], 77)], df.schema))
    small = cluster_metrics.silhouette(df, mode="squared").first()
    monkeypatch.setattr(cluster_metrics, "BROADCAST_CELLS", 2)
    large = cluster_metrics.silhouette(df, mode="squared", block_rows=5).first()
    assert large["mode"] == "squared" and large["silhouette"] == pytest.approx(small["silhouette"])


def test_more_clusters_than_the_old_bound(spark):
    # pairs of rows on a line, 101,000 clusters for Calinski-Harabasz, 3,000 for Davies-Bouldin
    df = spark.range(202_000).select("id", F.col("id").cast("bigint").alias("r")).select(
        "id", F.floor(F.col("r") / 2).alias("cluster"), F.array((F.floor(F.col("r") / 2) * 10 + F.col("r") % 2).cast("double")).alias("vec"))
    assert cluster_metrics.calinski_harabasz(df).first()[0] > 1
    # every s is 1/2 and the next centroid lies 10 away
    few = df.where("cluster < 3000")
    assert cluster_metrics.davies_bouldin(few, block_rows=1024).first()[0] == pytest.approx(0.1)


def test_confusion_matrix_of_many_labels(spark):
    pred = spark.range(10_050).select(F.col("id").alias("y_true"), F.lit(0).cast("long").alias("prediction"))
    m = class_metrics.confusion_matrix(pred.where("id < 40"))
    assert m.count() == 1600 and m.agg(F.sum("n")).first()[0] == 40
    assert class_metrics.confusion_matrix(pred).where("y_pred = 0").agg(F.sum("n"), F.count("n")).first() == (10_050, 10_050)


def test_run_record_of_many_clusters(spark):
    labels = spark.range(100_100).select(F.col("id"), (F.col("id") - 1).alias("cluster"))
    metrics = spark.createDataFrame([(0.5, 1.0, None, 2.0)], "silhouette double, calinski_harabasz double, davies_bouldin double, inertia double")
    r = runs.run_record(spark, 1, "KMeans", {}, "t", ["x"], labels, metrics)
    assert r.schema.simpleString().replace("struct<", "").startswith("run_id:string,algo:string")
    got = r.select("n_clusters", F.size("cluster_sizes"), F.col("cluster_sizes")["-1"], "davies_bouldin").first()
    assert tuple(got) == (100_099, 100_100, 1, None)
