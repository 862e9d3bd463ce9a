"""Registered queries for sources, profiling, outliers, missing values,
scaling and binning, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import impute as M
from ..operators import outliers as O
from ..operators import profile as P
from ..operators import scale as N
from ..sources import io as S
from ..session import ensure_checkpoint_dir
from .common import (
    EV_NULL_SQL, LI_FEATURES, LI_ID_SQL, PRIORITY_TOKENS_SQL, Q_NULL_SQL,
    events_nulls, lineitem, orders_tokens, table,
)

Q: dict = {}
SQL: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


LI = f"(SELECT *, {LI_ID_SQL} AS id, {Q_NULL_SQL} AS q_null FROM lineitem)"
ORD = f"(SELECT *, {PRIORITY_TOKENS_SQL} AS priority FROM orders)"
EV = f"(SELECT *, {EV_NULL_SQL} AS v_null FROM events)"
TOKENS = "('?', 'NA', 'N/A', 'null', 'None', 'MISSING', '-', '')"


def _scratch(spark, name):
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{name}-{uuid.uuid4().hex}"


def _orders_csv(spark, sf, header=True):
    path = _scratch(spark, "orders-csv")
    orders_tokens(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "priority").write.option(
        "header", header
    ).csv(path)
    return path


# ---- 2.1 sources -------------------------------------------------------------

@reg("s1_csv_tokens", f"""
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN priority IN {TOKENS} OR trim(priority) = '' THEN NULL ELSE priority END AS priority
FROM {ORD}""")
def s1_csv_tokens(spark, sf):
    # Spark's CSV reader already reads an unquoted all-blank field as empty -> null
    return S.read_table_csv(spark, _orders_csv(spark, sf), header=True, blank_rule=True).select(
        "o_orderkey", "o_custkey", "o_totalprice", "priority")


@reg("s2_rename", f"""
SELECT o_orderkey AS feature_0, o_custkey AS feature_1, o_totalprice AS feature_2,
       CASE WHEN priority IN {TOKENS} OR trim(priority) = '' THEN NULL ELSE priority END AS feature_3
FROM {ORD}""")
def s2_rename(spark, sf):
    df = S.read_table_csv(spark, _orders_csv(spark, sf, header=False), header=False, blank_rule=True)
    return df.select("feature_0", "feature_1", "feature_2", "feature_3")


@reg("s3_tokens", f"""
SELECT o_orderkey, CASE WHEN priority IN {TOKENS} THEN NULL ELSE priority END AS priority FROM {ORD}""")
def s3_tokens(spark, sf):
    return S.normalize_missing(orders_tokens(spark, sf).select("o_orderkey", "priority"))


@reg("s4_infer", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders""")
def s4_infer(spark, sf):
    o = table(spark, sf, "orders").select(
        *[F.col(x).cast("string").alias(x) for x in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")]
    )
    return S.infer_numeric(o)


@reg("s5_blank", f"""
SELECT o_orderkey, CASE WHEN regexp_matches(priority, '^\\s*$') THEN NULL ELSE priority END AS priority FROM {ORD}""")
def s5_blank(spark, sf):
    return S.blank_to_null(orders_tokens(spark, sf).select("o_orderkey", "priority"))


# ---- 2.2 profiling -----------------------------------------------------------

@reg("p3_head", f"""
SELECT id, l_orderkey, l_quantity, l_extendedprice FROM {LI} ORDER BY id LIMIT 5""")
def p3_head(spark, sf):
    return P.head(lineitem(spark, sf).select("id", "l_orderkey", "l_quantity", "l_extendedprice"), "id", 5)


def _five_sql(cols, src):
    parts = [
        f"SELECT '{x}' AS \"column\", round(min({x})::DOUBLE, 4) AS min, round(quantile_cont({x}, 0.25), 4) AS q1, "
        f"round(quantile_cont({x}, 0.5), 4) AS median, round(quantile_cont({x}, 0.75), 4) AS q3, "
        f"round(max({x})::DOUBLE, 4) AS max FROM {src}"
        for x in cols
    ]
    return " UNION ALL ".join(parts)


@reg("p4_five_number", _five_sql(LI_FEATURES + ["q_null"], LI))
def p4_five_number(spark, sf):
    return P.five_number_summary(lineitem(spark, sf, with_nulls=True), LI_FEATURES + ["q_null"])


@reg("p5_missing", " UNION ALL ".join(
    f"SELECT '{x}' AS \"column\", count(*) FILTER (WHERE {x} IS NULL)::BIGINT AS n_missing, "
    f"round(count(*) FILTER (WHERE {x} IS NULL) * 100.0::DOUBLE / count(*), 4) AS pct_missing, "
    f"(SELECT count(*) FILTER (WHERE q_null IS NULL) FROM {LI})::BIGINT AS total_missing FROM {LI}"
    for x in ["l_orderkey", "l_quantity", "q_null", "l_returnflag"]))
def p5_missing(spark, sf):
    df = lineitem(spark, sf, with_nulls=True).select("l_orderkey", "l_quantity", "q_null", "l_returnflag")
    return P.missing_profile(df)


@reg("p6_range", f"""
SELECT id, l_quantity, l_discount FROM {LI}
WHERE l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02::DOUBLE AND 0.06::DOUBLE""")
def p6_range(spark, sf):
    df = lineitem(spark, sf).select("id", "l_quantity", "l_discount")
    return P.filter_ranges(df, {"l_quantity": (10.0, 20.0), "l_discount": (0.02, 0.06), "no_such": (0, 1)})


@reg("p7_select", f"SELECT id, {', '.join(LI_FEATURES)} FROM {LI}")
def p7_select(spark, sf):
    return P.select_features(lineitem(spark, sf), ["id"] + LI_FEATURES)


@reg("p8_classes", """
WITH c AS (SELECT l_returnflag AS class, count(*) AS n FROM lineitem GROUP BY 1)
SELECT class, n, (SELECT count(*) FROM c) AS n_classes,
       round((SELECT max(n) FROM c)::DOUBLE / (SELECT min(n) FROM c), 4) AS imbalance_ratio,
       (SELECT max(n) FROM c) > (SELECT min(n) FROM c) * 10 AS imbalanced
FROM c""")
def p8_classes(spark, sf):
    return P.class_distribution(table(spark, sf, "lineitem"), "l_returnflag")


def _cont_sql(col, is_float):
    return f"""SELECT '{col}' AS "column", count(DISTINCT {col})::BIGINT AS n_unique, count(*)::BIGINT AS n_rows,
       coalesce(max(CASE WHEN {col}::DOUBLE <> floor({col}::DOUBLE) THEN 1 ELSE 0 END), 0) = 1 AS has_fraction,
       {'TRUE' if is_float else 'FALSE'} AND (count(DISTINCT {col}) > 20 OR count(DISTINCT {col}) > count(*) * 0.5
         OR coalesce(max(CASE WHEN {col}::DOUBLE <> floor({col}::DOUBLE) THEN 1 ELSE 0 END), 0) = 1) AS continuous,
       count(DISTINCT {col}) > 50 AS many_classes FROM lineitem"""


@reg("p9_continuous", " UNION ALL ".join([_cont_sql("l_quantity", True), _cont_sql("l_discount", True),
                                          _cont_sql("l_linenumber", False)]))
def p9_continuous(spark, sf):
    li = table(spark, sf, "lineitem")
    out = P.is_continuous_target(li, "l_quantity")
    for col in ("l_discount", "l_linenumber"):
        out = out.unionByName(P.is_continuous_target(li, col))
    return out


@reg("p12_validate", f"""
WITH a AS (SELECT count(*) AS n,
  (count(*) FILTER (WHERE q_null IS NULL) + count(*) FILTER (WHERE l_discount IS NULL)) AS missing,
  (count(*) FILTER (WHERE q_null < 0) + count(*) FILTER (WHERE l_discount < 0)) AS negative FROM {LI}),
c AS (SELECT count(*) AS n_classes, min(cn) AS min_class FROM (SELECT count(*) AS cn FROM lineitem GROUP BY l_returnflag))
SELECT 'min_samples' AS "check", 'error' AS severity, n::BIGINT AS observed, 5::BIGINT AS "limit", n >= 5 AS ok FROM a
UNION ALL SELECT 'min_features', 'error', 2, 1, TRUE FROM a
UNION ALL SELECT 'no_missing', 'error', missing::BIGINT, 0, missing = 0 FROM a
UNION ALL SELECT 'non_negative', 'warning', negative::BIGINT, 0, negative = 0 FROM a
UNION ALL SELECT 'min_classes', 'error', n_classes::BIGINT, 2, n_classes >= 2 FROM c
UNION ALL SELECT 'min_class_count', 'warning', min_class::BIGINT, 2, min_class >= 2 FROM c""")
def p12_validate(spark, sf):
    return P.validate_algorithm(lineitem(spark, sf, with_nulls=True), ["q_null", "l_discount"], "Naive Bayes", "l_returnflag")


@reg("p14_binary", """
SELECT 'quality' AS "column", bool_and(quality IN (0, 1) OR quality IS NULL) AS is_binary, bool_or(quality < 0) AS has_negative FROM labels
UNION ALL SELECT 'toxic', bool_and(toxic IN (0, 1) OR toxic IS NULL), bool_or(toxic < 0) FROM labels
UNION ALL SELECT 'doc_id', bool_and(doc_id IN (0, 1) OR doc_id IS NULL), bool_or(doc_id < 0) FROM labels""")
def p14_binary(spark, sf):
    return P.binary_check(table(spark, sf, "labels"), ["quality", "toxic", "doc_id"])


@reg("p15_sample", f"""
SELECT id, l_quantity FROM {LI} ORDER BY md5(concat(id, '42')), id LIMIT 500""")
def p15_sample(spark, sf):
    return P.sample_for_plot(lineitem(spark, sf).select("id", "l_quantity"), "id", 500, 42)


# ---- 2.3 outliers ------------------------------------------------------------

def _iqr_cte(col, src, name):
    return (f"{name} AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {src}), "
            f"{name}b AS (SELECT q1, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM {name})")


def _detect_sql(cols, src):
    parts = []
    for x in cols:
        parts.append(f"""(WITH {_iqr_cte(x, src, 'b')}
SELECT '{x}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(lo, 4) AS lower, round(hi, 4) AS upper,
  (SELECT count(*) FROM {src} WHERE {x} < lo OR {x} > hi)::BIGINT AS n_outliers,
  round((SELECT count(*) FROM {src} WHERE {x} < lo OR {x} > hi) * 100.0::DOUBLE / (SELECT count(*) FROM {src}), 4) AS pct_outliers
FROM bb)""")
    return " UNION ALL ".join(parts)


@reg("o1_iqr_detect", _detect_sql(LI_FEATURES + ["q_null"], LI))
def o1_iqr_detect(spark, sf):
    return O.detect_outliers_iqr(lineitem(spark, sf, with_nulls=True), LI_FEATURES + ["q_null"])


@reg("o1_iqr_events", _detect_sql(["value"], "events"))
def o1_iqr_events(spark, sf):
    return O.detect_outliers_iqr(table(spark, sf, "events"), ["value"])


@reg("o2_iqr_remove_seq", f"""
WITH {_iqr_cte('l_extendedprice', LI, 'a')},
f1 AS (SELECT * FROM {LI} WHERE l_extendedprice BETWEEN (SELECT lo FROM ab) AND (SELECT hi FROM ab)),
{_iqr_cte('q_null', 'f1', 'c')},
f2 AS (SELECT * FROM f1 WHERE q_null BETWEEN (SELECT lo FROM cb) AND (SELECT hi FROM cb))
SELECT id, l_extendedprice, q_null FROM f2""")
def o2_iqr_remove_seq(spark, sf):
    df = lineitem(spark, sf, with_nulls=True).select("id", "l_extendedprice", "q_null")
    return O.remove_outliers_iqr(df, ["l_extendedprice", "q_null"], "sequential")


@reg("o2_iqr_remove_simul", f"""
WITH {_iqr_cte('l_extendedprice', LI, 'a')}, {_iqr_cte('q_null', LI, 'c')}
SELECT id, l_extendedprice, q_null FROM {LI}
WHERE l_extendedprice BETWEEN (SELECT lo FROM ab) AND (SELECT hi FROM ab)
  AND q_null BETWEEN (SELECT lo FROM cb) AND (SELECT hi FROM cb)""")
def o2_iqr_remove_simul(spark, sf):
    df = lineitem(spark, sf, with_nulls=True).select("id", "l_extendedprice", "q_null")
    return O.remove_outliers_iqr(df, ["l_extendedprice", "q_null"], "simultaneous")


@reg("o3_box", " UNION ALL ".join(f"""(WITH {_iqr_cte(x, src, 'b')}
SELECT '{x}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(lo, 4) AS lower_fence, round(hi, 4) AS upper_fence,
  round((SELECT min({x}) FROM {src} WHERE {x} BETWEEN lo AND hi)::DOUBLE, 4) AS whisker_low,
  round((SELECT max({x}) FROM {src} WHERE {x} BETWEEN lo AND hi)::DOUBLE, 4) AS whisker_high,
  round((SELECT avg({x}) FROM {src}), 4) AS mean, round((SELECT stddev_samp({x}) FROM {src}), 4) AS sd FROM bb)"""
    for x, src in (("value", "events"), ("l_extendedprice", "lineitem"))))
def o3_box(spark, sf):
    a = O.boxplot_stats(table(spark, sf, "events"), ["value"])
    b = O.boxplot_stats(table(spark, sf, "lineitem"), ["l_extendedprice"])
    return a.unionByName(b)


@reg("o4_zscore", """
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd, count(*) AS n FROM events)
SELECT 'value' AS "column", round(m, 4) AS mean, round(sd, 4) AS sd,
  (SELECT count(*) FROM events WHERE abs((value - m) / sd) > 3)::BIGINT AS n_outliers,
  round((SELECT count(*) FROM events WHERE abs((value - m) / sd) > 3) * 100.0::DOUBLE / n, 4) AS pct_outliers FROM s""")
def o4_zscore(spark, sf):
    return O.detect_outliers_zscore(table(spark, sf, "events"), ["value"], 3.0)


# ---- 2.4 missing values -------------------------------------------------------

@reg("m1_drop_rows", f"SELECT id, q_null, l_discount FROM {LI} WHERE q_null IS NOT NULL AND l_discount IS NOT NULL")
def m1_drop_rows(spark, sf):
    return M.drop_missing_rows(lineitem(spark, sf, with_nulls=True).select("id", "q_null", "l_discount"))


@reg("m2_drop_cols", f"""
SELECT o_orderkey, o_totalprice FROM {ORD}""")
def m2_drop_cols(spark, sf):
    return M.drop_missing_columns(orders_tokens(spark, sf).select("o_orderkey", "priority", "o_totalprice"))


@reg("m3_mean", f"""
SELECT id, round(coalesce(q_null::DOUBLE, (SELECT avg(q_null) FROM {LI})), 6) AS q_null,
       round(coalesce(l_tax::DOUBLE, (SELECT avg(l_tax) FROM {LI})), 6) AS l_tax FROM {LI}""")
def m3_mean(spark, sf):
    df = M.impute_mean(lineitem(spark, sf, with_nulls=True).select("id", "q_null", "l_tax"), ["q_null", "l_tax"])
    return df.select("id", F.round("q_null", 6).alias("q_null"), F.round("l_tax", 6).alias("l_tax"))


@reg("m4_median", f"""
SELECT id, round(coalesce(q_null::DOUBLE, (SELECT quantile_cont(q_null, 0.5) FROM {LI})), 6) AS q_null FROM {LI}""")
def m4_median(spark, sf):
    df = M.impute_median(lineitem(spark, sf, with_nulls=True).select("id", "q_null"), ["q_null"])
    return df.select("id", F.round("q_null", 6).alias("q_null"))


def _fill_sql(direction, part):
    over = f"PARTITION BY {part} " if part else ""
    if direction == "f":
        a = f"last_value(v_null IGNORE NULLS) OVER ({over}ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        b = f"first_value(v_null IGNORE NULLS) OVER ({over}ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    else:
        a = f"first_value(v_null IGNORE NULLS) OVER ({over}ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        b = f"last_value(v_null IGNORE NULLS) OVER ({over}ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"SELECT event_id, user_id, coalesce({a}, {b}) AS v_null FROM {EV}"


@reg("m5_ffill", _fill_sql("f", None))
def m5_ffill(spark, sf):
    return M.impute_ffill(events_nulls(spark, sf).select("event_id", "user_id", "ts", "v_null"), ["v_null"],
                          ["ts", "event_id"]).select("event_id", "user_id", "v_null")


@reg("m5_ffill_user", _fill_sql("f", "user_id"))
def m5_ffill_user(spark, sf):
    return M.impute_ffill(events_nulls(spark, sf).select("event_id", "user_id", "ts", "v_null"), ["v_null"],
                          ["ts", "event_id"], ["user_id"]).select("event_id", "user_id", "v_null")


@reg("m6_bfill", _fill_sql("b", None))
def m6_bfill(spark, sf):
    return M.impute_bfill(events_nulls(spark, sf).select("event_id", "user_id", "ts", "v_null"), ["v_null"],
                          ["ts", "event_id"]).select("event_id", "user_id", "v_null")


@reg("m6_bfill_user", _fill_sql("b", "user_id"))
def m6_bfill_user(spark, sf):
    return M.impute_bfill(events_nulls(spark, sf).select("event_id", "user_id", "ts", "v_null"), ["v_null"],
                          ["ts", "event_id"], ["user_id"]).select("event_id", "user_id", "v_null")


@reg("m7_mode", f"""
WITH t AS (SELECT o_orderkey, CASE WHEN priority IN {TOKENS} THEN NULL ELSE priority END AS priority FROM {ORD}),
m AS (SELECT priority FROM t WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1)
SELECT o_orderkey, coalesce(priority, (SELECT priority FROM m)) AS priority FROM t""")
def m7_mode(spark, sf):
    return M.impute_mode(orders_tokens(spark, sf).select("o_orderkey", "priority"), ["priority"])


@reg("m8_class_mean", f"""
SELECT id, l_returnflag,
  round(coalesce(q_null::DOUBLE, avg(q_null) OVER (PARTITION BY l_returnflag)), 6) AS q_null FROM {LI}""")
def m8_class_mean(spark, sf):
    df = M.impute_class_mean(lineitem(spark, sf, with_nulls=True).select("id", "l_returnflag", "q_null"),
                             "l_returnflag", ["q_null"])
    return df.select("id", "l_returnflag", F.round("q_null", 6).alias("q_null"))


@reg("m10_mixed", f"""
WITH a AS (SELECT id, coalesce(q_null::DOUBLE, (SELECT quantile_cont(q_null, 0.5) FROM {LI})) AS q_null,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_tax END AS t_null FROM {LI})
SELECT id, round(q_null, 6) AS q_null, round(coalesce(t_null, (SELECT avg(t_null) FROM a)), 6) AS t_null FROM a""")
def m10_mixed(spark, sf):
    df = lineitem(spark, sf, with_nulls=True).select(
        "id", "q_null", F.expr("CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_tax END").alias("t_null"))
    out = M.impute(df, "mean", {"q_null": "median"})
    return out.select("id", F.round("q_null", 6).alias("q_null"), F.round("t_null", 6).alias("t_null"))


# ---- 2.5 scaling and binning ----------------------------------------------------

@reg("n1_minmax", f"""
WITH s AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b, min(q_null) AS qa, max(q_null) AS qb FROM {LI})
SELECT id, round((l_extendedprice - a) / (b - a), 6) AS l_extendedprice,
       round((q_null - qa) / (qb - qa), 6) AS q_null FROM {LI}, s""")
def n1_minmax(spark, sf):
    df = N.scale_minmax(lineitem(spark, sf, with_nulls=True).select("id", "l_extendedprice", "q_null"),
                        ["l_extendedprice", "q_null"])
    return df.select("id", F.round("l_extendedprice", 6).alias("l_extendedprice"), F.round("q_null", 6).alias("q_null"))


@reg("n2_zscore", """
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - m) / sd, 6) AS c_acctbal FROM customer, s""")
def n2_zscore(spark, sf):
    df = N.scale_zscore(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return df.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


@reg("n3_decimal", """
WITH s AS (SELECT max(abs(c_acctbal)) AS m FROM customer)
SELECT c_custkey, round(c_acctbal / pow(10, length(CAST(CAST(trunc(m) AS BIGINT) AS VARCHAR)) - 1), 6) AS c_acctbal
FROM customer, s""")
def n3_decimal(spark, sf):
    df = N.scale_decimal(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return df.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


@reg("n5_robust", """
WITH s AS (SELECT quantile_cont(p_retailprice, 0.5) AS med, quantile_cont(p_retailprice, 0.75) - quantile_cont(p_retailprice, 0.25) AS iqr FROM part)
SELECT p_partkey, round((p_retailprice - med) / iqr, 6) AS p_retailprice FROM part, s""")
def n5_robust(spark, sf):
    df = N.scale_robust(table(spark, sf, "part").select("p_partkey", "p_retailprice"), ["p_retailprice"])
    return df.select("p_partkey", F.round("p_retailprice", 6).alias("p_retailprice"))


def _width_sql(col, key, src, n):
    inner = " + ".join(f"CASE WHEN {col} > a + {i} * ((b - a) / {n}.0::DOUBLE) THEN 1 ELSE 0 END" for i in range(1, n))
    return (f"WITH s AS (SELECT min({col})::DOUBLE AS a, max({col})::DOUBLE AS b FROM {src}) "
            f"SELECT {key}, CAST({inner} AS INTEGER) AS {col}_bin FROM {src}, s")


@reg("d1_width", _width_sql("c_acctbal", "c_custkey", "customer", 5))
def d1_width(spark, sf):
    return N.bin_equal_width(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 5).select(
        "c_custkey", "c_acctbal_bin")


@reg("d2_freq", """
WITH q AS (SELECT list_sort(list_distinct(quantile_cont(p_size, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS e FROM part)
SELECT p_partkey, CAST(len(list_filter(e[2:len(e)-1], lambda x: p_size > x)) AS INTEGER) AS p_size_bin FROM part, q""")
def d2_freq(spark, sf):
    return N.bin_equal_freq(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", 4).select(
        "p_partkey", "p_size_bin")


@reg("d2_freq_price", """
WITH q AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM lineitem)
SELECT """ + LI_ID_SQL + """ AS id, CAST(len(list_filter(e[2:len(e)-1], lambda x: l_extendedprice > x)) AS INTEGER) AS l_extendedprice_bin
FROM lineitem, q""")
def d2_freq_price(spark, sf):
    return N.bin_equal_freq(lineitem(spark, sf).select("id", "l_extendedprice"), "l_extendedprice", 5).select(
        "id", "l_extendedprice_bin")
