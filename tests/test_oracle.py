"""Registered queries against their DuckDB twins on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["p4_five_number", "p5_missing", "p8_classes", "o1_iqr_detect", "o2_iqr_remove_seq", "m5_ffill", "m6_bfill_user",
        "m8_class_mean", "n1_minmax", "d1_width", "d2_freq", "l1_split", "b1_gauss_metrics", "e9_report", "e10_pr",
        "j4_knn", "k1_knn", "q3_sil_exact", "c6_dbscan", "c7_kdist", "t1_root", "v2_vote"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "precision" in df.columns


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_twin(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
