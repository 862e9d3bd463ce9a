"""The bounded-memory paths give the same answers as the simple ones."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabmine.functions import ordered
from tabmine.functions import quantiles as Qn
from tabmine.operators import components as C
from tabmine.operators import pairs as J
from tabmine.operators import split as L


def test_bracketed_quantiles_match_exact(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=5000).tolist()
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    exact = Qn.column_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9])["x"]
    brk = Qn.column_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9], distinct_bound=10, bracket_bound=200)["x"]
    assert np.allclose(exact, brk) and np.allclose(exact, np.quantile(vals, [0.1, 0.25, 0.5, 0.9]))


def test_radix_split_matches_window(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).alias("y"))
    ref = L.stratified_split(df, "id", "y", 0.2)
    monkeypatch.setattr(L, "FINAL_ROWS", 50)
    monkeypatch.setattr(L, "LEVEL_BITS", 4)
    got = L.stratified_split(df, "id", "y", 0.2)
    a = {r["id"] for r in ref.where("is_test").collect()}
    b = {r["id"] for r in got.where("is_test").collect()}
    assert a == b and len(a) == 600


def test_running_sums_match_window(spark):
    df = spark.range(500).select(F.col("id"), ((F.col("id") * 7919) % 101).cast("double").alias("k"), F.lit(1).alias("one"))
    got = ordered.running_sums(df, "k", ["one"], descending=True, n_buckets=7, tie_cols=["id"])
    w = Window.orderBy(F.desc("k"), "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum("one").over(w).alias("c"))
    assert {(r["id"], r["cum_one"]) for r in got.collect()} == {(r["id"], r["c"]) for r in ref.collect()}


def test_block_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(120, 5))
    df = spark.createDataFrame([(i, X[i].tolist(), None) for i in range(120)], "id bigint, vec array<double>, lab string")
    nn = J.knn_join(df, df, 3, exclude_self=True, block_rows=16)
    got = {(r["q_id"], r["rank"]): r["b_id"] for r in nn.collect()}
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    for i in range(120):
        order = np.lexsort((np.arange(120), d[i]))[:3]
        assert [got[(i, r + 1)] for r in range(3)] == order.tolist()


def test_components(spark):
    v = spark.createDataFrame([(i,) for i in range(8)], "id bigint")
    e = spark.createDataFrame([(0, 1), (1, 2), (5, 6), (7, 6)], "a bigint, b bigint")
    comp = {r["id"]: r["comp"] for r in C.connected_components(v, e).collect()}
    assert comp == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 6: 5, 7: 5}


def test_no_cartesian_in_block_join(spark):
    df = spark.createDataFrame([(i, [float(i)], None) for i in range(10)], "id bigint, vec array<double>, lab string")
    plan = J.knn_join(df, df, 2, block_rows=4)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("p", [0.0, 1.0])
def test_order_statistics_edges(spark, p):
    df = spark.createDataFrame([(float(v),) for v in range(10)], "x double")
    r = 0 if p == 0.0 else 9
    assert Qn.order_statistics(df, "x", [r], bracket_bound=3)[0] == float(r)
