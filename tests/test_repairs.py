"""Rules that the larger tables do not reach: large trees, medoid samples, hierarchies over text ids, imputation donors,
two-label comparisons, errors while a classifier runs, catalogue rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.operators import class_metrics, compare, hierarchy, impute, kmedoids, knn, profile, runs, tree
from tabmine.sources import io


def test_tree_without_depth_limit(spark):
    # alternating classes along one column: a chain of splits deeper than 62
    rows = [(k, float(k), "a" if k % 2 else "b") for k in range(150)]
    df = spark.createDataFrame(rows, "id long, x double, y string")
    t = tree.fit_tree(df, ["x"], "y")
    assert t.n_leaves() == 150
    assert df.where(t.predict_col() != F.col("y")).count() == 0


def test_large_tree_scores_like_its_literal_form(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, rng.random(), rng.random(), rng.choice("abc")) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, z double, y string")
    t = tree.fit_tree(df, ["x", "z"], "y", max_depth=5)
    small = [tuple(r) for r in t.transform(df).orderBy("id").select("prediction", "proba").collect()]
    monkeypatch.setattr(tree, "LITERAL_NODES", 0)
    assert [tuple(r) for r in t.transform(df).orderBy("id").select("prediction", "proba").collect()] == small


def test_medoid_sample_converges(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.3, size=(60, 2)) for c in (0, 4, 8)])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    start = [0, 1, 2]
    exact = kmedoids.kmedoids(df, "id", ["a", "b"], k=3, init=start)
    sample = kmedoids.kmedoids(df, "id", ["a", "b"], k=3, init=start, mode="sample", sample_size=15)
    assert sample.n_iter < 60 and sample.inertia <= 1.3 * exact.inertia
    with pytest.raises(ValueError):
        kmedoids.kmedoids(df, "id", ["a", "b"], k=3, mode="auto")


@pytest.mark.parametrize("linkage", ["single", "complete", "average", "ward"])
def test_hierarchy_over_text_ids(spark, linkage):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(14, 2))
    df = spark.createDataFrame([(f"r{i:02d}", float(a), float(b)) for i, (a, b) in enumerate(x)], "id string, a double, b double")
    labels, link = hierarchy.agnes(df, "id", ["a", "b"], n_clusters=3, linkage=linkage)
    groups = {i: [i] for i in range(14)}
    while len(groups) > 3:  # greedy merging by the definition
        def dist(p, q):
            d = np.sqrt(((x[p][:, None] - x[q][None]) ** 2).sum(-1))
            if linkage == "ward":
                return np.sqrt(2 * len(p) * len(q) / (len(p) + len(q))) * np.linalg.norm(x[p].mean(0) - x[q].mean(0))
            return {"single": d.min(), "complete": d.max(), "average": d.mean()}[linkage]

        a, b = min(((i, j) for i in groups for j in groups if i < j), key=lambda t: dist(groups[t[0]], groups[t[1]]))
        groups[a] += groups.pop(b)
    want = sorted(sorted(f"r{i:02d}" for i in g) for g in groups.values())
    got = {}
    for r in labels.collect():
        got.setdefault(r["cluster"], []).append(r["id"])
    assert sorted(sorted(g) for g in got.values()) == want
    assert link.count() == 13


def test_knn_imputation_donors(spark):
    rows = [(1, None, None, None), (2, 1.0, None, 3.0), (3, 1.1, 5.0, None), (4, 9.0, 50.0, 9.0), (5, 1.2, 7.0, 3.2)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r["id"]: (r["a"], r["b"], r["c"]) for r in knn.impute_knn(df, "id", ["a", "b", "c"], k=1).collect()}
    a = (1.0 + 1.1 + 9.0 + 1.2) / 4
    assert got[1] == pytest.approx((a, 62 / 3, 15.2 / 3))  # no value: column means
    # row 3 lacks c but is a donor of b; row 2 is nearest to it on a
    assert got[2] == pytest.approx((1.0, 5.0, 3.0)) and got[3] == pytest.approx((1.1, 5.0, 3.0))
    again = impute.impute(df, "knn", id_col="id", k=1)
    assert {r["id"]: (r["a"], r["b"], r["c"]) for r in again.collect()} == got


def test_two_labels_compare_on_the_greater_one(spark):
    rows = [("m2", "n", "n"), ("m2", "p", "n"), ("m2", "p", "p"), ("m2", "n", "n")]
    rows += [("m1", y, p) for _, y, p in rows]
    df = spark.createDataFrame(rows, "algo string, y_true string, prediction string")
    got = {r["algo"]: r for r in class_metrics.compare_metrics(df, order=["m2", "m1"]).collect()}
    assert got["m2"]["precision_pct"] == 100.0 and got["m2"]["recall_pct"] == 50.0
    assert got["m2"]["rank"] == 1 and got["m1"]["rank"] == 2


def test_failing_classifier_is_an_entry(spark, monkeypatch):
    rows = [(k, float(k % 7), "a" if k % 7 > 3 else "b") for k in range(60)]
    df = spark.createDataFrame(rows, "id long, x double, y string")
    run = compare.run_classification

    def breaks_late(algo, *args):
        r = run(algo, *args)
        if algo == "Naive Bayes":
            r.predictions = r.predictions.withColumn("prediction", F.raise_error(F.lit("broken")).cast("string"))
        return r

    monkeypatch.setattr(compare, "run_classification", breaks_late)
    table, errors = compare.compare_classifiers(df, df, "id", ["x"], "y", [("Naive Bayes", {}), ("C4.5", {}), ("k-NN", {"k": 3})])
    assert [e[0] for e in errors] == ["Naive Bayes"] and {r["algo"] for r in table.collect()} == {"C4.5", "k-NN"}


def test_classification_result(spark):
    rows = [(k, float(k % 7), "a" if k % 7 > 3 else "b") for k in range(60)]
    df = spark.createDataFrame(rows, "id long, x double, y string")
    r = compare.run_classification("C4.5", {}, df, df, "id", ["x"], "y")
    assert r.metrics.first()["accuracy"] == 1.0 and r.importances.first()["feature"] == "x"
    assert all(abs(sum(p["proba"].values()) - 1) < 1e-9 for p in r.predictions.collect())


def test_table_validation_and_catalogue(spark, tmp_path):
    assert profile.validate_table(spark.createDataFrame([("a",)], "x string"))[0] is False
    assert profile.validate_table(spark.createDataFrame([(1,)], "x int"))[0] is True
    path = f"{tmp_path}/t.parquet"
    spark.createDataFrame([(1.0, "a"), (None, "b")], "x double, y string").write.parquet(path)
    row = io.dataset_catalog(spark, [("t", path, "y", True)]).first()
    assert (row["n_rows"], row["n_features"], row["n_classes"], row["has_missing"], row["recommended_for"]) == (2, 1, 2, True, ["classification"])


def test_runs_carry_the_time(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "id long, cluster int")
    metrics = spark.createDataFrame([(0.5, 1.0, 1.0, 1.0)], "silhouette double, calinski_harabasz double, davies_bouldin double, inertia double")
    a, b = (runs.run_record(spark, n, "KMeans", {}, "t", ["x"], labels, metrics) for n in (2, 1))
    assert runs.latest(a.unionByName(b)).first()["latest_run"].startswith("Run1_")


@pytest.mark.parametrize("compat", [False, True])
def test_splinter_in_one_block_equals_the_block_join(spark, compat):
    from tabmine.operators import diana

    rng = np.random.default_rng(4)
    for scale in (1.0, 6.0):
        x = np.concatenate([rng.normal(0, 1, (25, 3)), rng.normal(scale, 1, (12, 3))])
        v = spark.createDataFrame([(f"k{i:02d}", r.tolist()) for i, r in enumerate(x)], "id string, vec array<double>")
        one = {r["id"]: r["side"] for r in diana.splinter_split(v, compat=compat).collect()}
        many = {r["id"]: r["side"] for r in diana.splinter_split(v, compat=compat, block_rows=10).collect()}
        assert one == many and 0 < sum(one.values())
