"""All pairs of rows through packs: what the block joins give, without them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.operators import diana, packs, select


@pytest.fixture
def rows(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 1, (k, 6)) for c, k in ((0, 90), (3, 50), (6, 40))])
    return spark.createDataFrame([(f"k{i:04d}", r.tolist()) for i, r in enumerate(x)], "k string, vec array<double>"), x


@pytest.fixture
def small(monkeypatch):
    """Blocks of 64 rows, and no block join."""
    def refuse(*a, **k):
        raise AssertionError("block join")

    def go():
        monkeypatch.setattr(packs, "_large", lambda *a: 64)
        monkeypatch.setattr(diana, "DEFAULT_BLOCK_ROWS", 64)
        for module in (diana, select):
            monkeypatch.setattr(module, "block_join", refuse)

    return go


def _apart(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))


@pytest.mark.parametrize("one_task", [1000, 10])
def test_diana(rows, small, monkeypatch, one_task):
    df, _ = rows
    want, history = (t.collect() for t in diana.diana(df, "k", n_clusters=3, vec_col="vec"))
    small()
    monkeypatch.setattr(diana, "ONE_TASK_ROWS", one_task)
    monkeypatch.setattr(diana, "MOVED_ROWS", 20)
    got, hist = (t.collect() for t in diana.diana(df, "k", n_clusters=3, vec_col="vec"))
    assert {tuple(r) for r in got} == {tuple(r) for r in want} and len(got) == 180
    assert [tuple(r)[:2] for r in hist] == [tuple(r)[:2] for r in history]
    assert [r["split_diameter"] for r in hist] == pytest.approx([r["split_diameter"] for r in history], rel=1e-12)


@pytest.mark.parametrize("compat", [False, True])
def test_splinter(rows, small, compat):
    v = rows[0].select(F.col("k").alias("id"), "vec")
    want = {tuple(r) for r in diana.splinter_split(v, compat=compat).collect()}
    small()
    assert {tuple(r) for r in diana.splinter_split(v, compat=compat).collect()} == want


def test_silhouettes(rows, small):
    df, x = rows
    small()
    labs = np.stack([np.zeros(180, int), (x[:, 0] > 2) + 0, (x[:, 0] > 2) + 3 * (x[:, 1] > 5), np.where(np.arange(180) == 7, 5, -1)], 1)
    v = df.select(F.col("k").alias("id"), "vec")
    lab = v.sparkSession.createDataFrame([(f"k{i:04d}", r.tolist()) for i, r in enumerate(labs)], "id string, labs array<int>")
    got, d = select.multi_silhouette(v, lab, 4), _apart(x)
    assert got[0] is None
    for r in (1, 2, 3):
        names, own = np.unique(labs[:, r], return_inverse=True)
        sums = np.stack([d[:, own == c].sum(1) for c in range(len(names))], 1)
        n = np.bincount(own)
        a = sums[np.arange(180), own] / np.maximum(n[own] - 1, 1)
        mean = sums / n
        mean[np.arange(180), own] = np.inf
        b = mean.min(1)
        assert got[r] == pytest.approx(np.where(n[own] == 1, 0, (b - a) / np.maximum(a, b)).mean(), abs=1e-9)


@pytest.mark.parametrize("dims", [1, 2, 6])
def test_diameter(rows, small, dims):
    df, x = rows
    small()
    x = np.round(np.concatenate([x, x[:20]])[:, :dims], 1)  # copies, and points on lines
    v = df.sparkSession.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vec array<double>").repartition(3)
    assert diana.cluster_diameter(v) == pytest.approx(_apart(x).max(), rel=1e-12)
