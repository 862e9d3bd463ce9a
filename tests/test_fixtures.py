"""Hand fixtures with values worked out independently (FIXTURES.md section C)."""

import math

import pytest
from pyspark.sql import functions as F

from tabmine.operators import class_metrics as E
from tabmine.operators import cluster_metrics as Qm
from tabmine.operators import dbscan as D
from tabmine.operators import diana as DI
from tabmine.operators import impute as M
from tabmine.operators import knn as K
from tabmine.operators import outliers as O
from tabmine.operators import scale as N
from tabmine.operators import split as L
from tabmine.operators import tree as T
from tabmine.sources import io as IO


def col(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_iqr(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 100.0, None])], "id int, x double")
    det = O.detect_outliers_iqr(df, ["x"]).first()
    assert (det["q1"], det["q3"], det["lower"], det["upper"]) == (2.0, 4.0, -1.0, 7.0)
    assert det["n_outliers"] == 1 and det["pct_outliers"] == pytest.approx(16.6667, abs=1e-3)
    assert O.remove_outliers_iqr(df, ["x"]).count() == 4


def test_quantiles_and_bins(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 4, 7, 11, 16])], "id int, x double")
    from tabmine.operators.profile import five_number_summary

    r = five_number_summary(df, ["x"]).first()
    assert (r["q1"], r["median"], r["q3"]) == (2.5, 5.5, 10.0)
    z = N.fit_zscore(df, ["x"]).params["x"]
    assert z[1] == pytest.approx(5.273097, abs=1e-6)
    assert col(N.bin_equal_width(df, "x", 3), "x_bin") == [0, 0, 0, 1, 1, 2]
    assert col(N.bin_equal_freq(df, "x", 3), "x_bin") == [0, 0, 1, 1, 2, 2]


def test_constant_column(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(3)], "id int, x double")
    assert col(N.scale_minmax(df, ["x"]), "x") == [0.0, 0.0, 0.0]
    assert col(N.scale_zscore(df, ["x"]), "x") == [0.0, 0.0, 0.0]
    assert col(N.bin_equal_width(df, "x", 5), "x_bin") == [2, 2, 2]
    assert col(N.bin_equal_width(df, "x", 4), "x_bin") == [1, 1, 1]


def test_decimal_rules():
    assert N.decimal_divisor(250.0) == 100.0 and N.decimal_divisor(0.5) == 1.0 and N.decimal_divisor(0.0) is None
    assert N.decimal_divisor(250.0, strict=True) == 1000.0 and N.decimal_divisor(0.5, strict=True) == 1.0


def test_fill(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, None), (4, None), (5, 8.0), (6, None)], "id int, v double")
    assert col(M.impute_ffill(df, ["v"], ["id"], n_buckets=3), "v") == [3, 3, 3, 3, 8, 8]
    assert col(M.impute_bfill(df, ["v"], ["id"], n_buckets=3), "v") == [3, 3, 8, 8, 8, 8]


def test_tokens(spark):
    vals = ["?", "NA", "N/A", "null", "None", "MISSING", "-", "", " ", "0", "x"]
    df = spark.createDataFrame(list(enumerate(vals)), "id int, s string")
    out = IO.blank_to_null(IO.normalize_missing(df))
    got = col(out, "s")
    assert got[:9] == [None] * 9 and got[9:] == ["0", "x"]
    assert col(IO.normalize_missing(df), "s")[8] == " "  # the blank only through the blank rule


@pytest.fixture()
def two_blobs(spark):
    rows = [(0, [0.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [10.0, 10.0], 1), (3, [10.0, 11.0], 1)]
    return spark.createDataFrame(rows, "id int, vec array<double>, cluster int")


def test_two_blobs_metrics(two_blobs):
    assert Qm.inertia(two_blobs).first()[0] == pytest.approx(1.0)
    assert Qm.calinski_harabasz(two_blobs).first()[0] == pytest.approx(400.0)
    assert Qm.davies_bouldin(two_blobs).first()[0] == pytest.approx(0.0707107, abs=1e-6)
    assert Qm.silhouette(two_blobs).first()[0] == pytest.approx(0.9292895, abs=1e-6)
    assert Qm.silhouette(two_blobs, mode="sample", sample_rows=4).first()[0] == pytest.approx(0.9292895, abs=1e-6)
    sq = Qm.silhouette(two_blobs, mode="squared").first()[0]
    assert sq == pytest.approx(0.9950, abs=1e-4)


def test_f1(spark):
    y = [0, 0, 1, 2, 2, 2]
    p = [0, 1, 1, 2, 1, 2]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(y, p))], "id int, y_true int, prediction int")
    o = E.overall_metrics(df).first()
    assert o["accuracy"] == pytest.approx(0.666667, abs=1e-6)
    assert o["precision"] == pytest.approx(0.888889, abs=1e-6)
    assert o["recall"] == pytest.approx(0.666667, abs=1e-6)
    assert o["f1"] == pytest.approx(0.761905, abs=1e-6)
    f = E.f1_scores(df).first()
    assert f["f1_weighted_of_classes"] == pytest.approx(0.705556, abs=1e-6)


def test_binary_positive_is_larger_label(spark):
    df = spark.createDataFrame([(0, "a", "b"), (1, "b", "b"), (2, "b", "a")], "id int, y_true string, prediction string")
    o = E.overall_metrics(df).first()
    assert o["precision"] == pytest.approx(0.5) and o["recall"] == pytest.approx(0.5) and o["n_labels"] == 2


def test_vote_ties(spark):
    nn = spark.createDataFrame([(0, "b", 1.0, 1), (0, "a", 2.0, 2)], "q_id int, b_lab string, dist double, rank int")
    assert K.vote(nn, "uniform", 2)[0].first()["prediction"] == "b"
    assert K.vote(nn, "distance", 2)[0].first()["prediction"] == "b"
    nn2 = spark.createDataFrame([(0, "b", 1.0, 1), (0, "a", 1.0, 2)], "q_id int, b_lab string, dist double, rank int")
    assert K.vote(nn2, "distance", 2)[0].first()["prediction"] == "a"


def test_dbscan_border(spark):
    xs = [0.0, 1.8, 0.9, 1.2, 2.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x double")
    tb = D.dbscan(df, "id", ["x"], eps=1.0, min_samples=4)
    assert col(tb, "cluster") == [0, 0, 0, 0, 0]
    rf = D.dbscan(df, "id", ["x"], eps=1.0, min_samples=4, border="reference")
    assert col(rf, "cluster") == [-1, 0, 0, 0, 0]
    assert col(tb, "is_core") == [False, True, True, True, False]


def test_singleton_class_split(spark):
    rows = [(i, "big") for i in range(20)] + [(100, "one")]
    df = spark.createDataFrame(rows, "id int, y string")
    sp = L.stratified_split(df, "id", "y", 0.2)
    one = sp.where(F.col("y") == "one").first()
    assert one["is_test"] is True
    assert sp.where((F.col("y") == "big") & F.col("is_test")).count() == 4


def test_zero_gain_xor(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0), (0.0, 1.0, 1), (1.0, 0.0, 1), (1.0, 1.0, 0)], "a double, b double, y int")
    t = T.fit_tree(df, ["a", "b"], "y")
    root = t.nodes[1]
    assert (root.feature, root.threshold) == (0, 0.0) and root.gain == pytest.approx(0.0)
    assert t.depth() == 2 and t.n_leaves() == 4
    pred = [r["prediction"] for r in t.transform(df).collect()]
    assert pred == [0, 1, 1, 0]


def test_diana_pair(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 1.0)], "id int, x double, y double")
    lab, _ = DI.diana(df, "id", ["x", "y"], 2, compat=True)
    assert col(lab, "cluster") == [1, 1]
    lab, _ = DI.diana(df, "id", ["x", "y"], 2)
    assert col(lab, "cluster") == [1, 0]  # the splinter (first max mean distance) moves to B


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "id int, x double")
    with pytest.raises(ValueError):
        D.dbscan(empty, "id", ["x"], eps=0.0)
    one = spark.createDataFrame([(0, [1.0, 2.0], 0)], "id int, vec array<double>, cluster int")
    assert Qm.silhouette(one).first()[0] is None
    nulls = spark.createDataFrame([(0, None), (1, None)], "id int, x double")
    assert O.detect_outliers_iqr(nulls, ["x"]).first()["n_outliers"] == 0
    assert math.isclose(1.0, 1.0)
