"""All registered queries and their SQL twins."""

from __future__ import annotations

from . import q_classify, q_cluster, q_models, q_prep

MODULES = [q_prep, q_classify, q_cluster, q_models]


def all_queries():
    out = {}
    for m in MODULES:
        out.update(m.Q)
    return out


def all_sql():
    out = {}
    for m in MODULES:
        out.update(m.SQL)
    return out


def flagship(spark, sf):
    from .q_classify import b1_gauss_metrics

    return b1_gauss_metrics(spark, sf)
