"""Registered queries for splits, naive Bayes and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import class_metrics as E
from ..operators import naive_bayes as B
from ..operators import split as L
from .common import LI_FEATURES, LI_ID_SQL, lineitem

Q: dict = {}
SQL: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---- shared inputs -----------------------------------------------------------

SPLIT_SQL = f"""split AS (
  SELECT *, rn <= greatest(1, floor(n * 0.2::DOUBLE)) AS is_test FROM (
    SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5(concat(id, '42')), id) AS rn,
           count(*) OVER (PARTITION BY l_returnflag) AS n
    FROM (SELECT *, {LI_ID_SQL} AS id FROM lineitem)))"""


def li_split(spark, sf):
    df = lineitem(spark, sf).select("id", "l_returnflag", "l_linestatus", *LI_FEATURES)
    return L.stratified_split(df, "id", "l_returnflag", 0.2, 42)


RULE_PRED_SQL = ("CASE WHEN l_discount < 0.03::DOUBLE THEN 'A' WHEN l_discount < 0.07::DOUBLE THEN 'N' ELSE 'R' END")
RULE_PRED2_SQL = ("CASE WHEN l_tax < 0.02::DOUBLE THEN 'N' WHEN l_quantity > 40 THEN 'R' ELSE 'A' END")
BIN_PRED_SQL = "CASE WHEN l_tax < 0.04::DOUBLE THEN 'F' ELSE 'O' END"
RULE_SRC = f"(SELECT {LI_ID_SQL} AS id, l_returnflag AS y_true, {RULE_PRED_SQL} AS prediction FROM lineitem)"
BIN_SRC = f"(SELECT {LI_ID_SQL} AS id, l_linestatus AS y_true, {BIN_PRED_SQL} AS prediction FROM lineitem)"


def rule_preds(spark, sf):
    return lineitem(spark, sf).select("id", F.col("l_returnflag").alias("y_true"), F.expr(RULE_PRED_SQL).alias("prediction"))


def bin_preds(spark, sf):
    return lineitem(spark, sf).select("id", F.col("l_linestatus").alias("y_true"), F.expr(BIN_PRED_SQL).alias("prediction"))


# ---- L1 / L2 -------------------------------------------------------------------

@reg("l1_split", f"WITH {SPLIT_SQL} SELECT id, l_returnflag, is_test FROM split")
def l1_split(spark, sf):
    return li_split(spark, sf).select("id", "l_returnflag", "is_test")


@reg("l2_split", f"""
SELECT id, rn <= ceil(n * 0.25::DOUBLE) AS is_test FROM (
  SELECT id, row_number() OVER (ORDER BY md5(concat(id, '7')), id) AS rn, count(*) OVER () AS n
  FROM (SELECT {LI_ID_SQL} AS id FROM lineitem))""")
def l2_split(spark, sf):
    return L.random_split(lineitem(spark, sf).select("id"), "id", 0.25, 7)


# ---- naive Bayes ----------------------------------------------------------------

def _nb_sql(kind: str, extra: str = "") -> str:
    f = LI_FEATURES
    if kind == "gaussian":
        aggs = ", ".join([f"avg({x}) AS m{i}, var_pop({x}) AS v{i}" for i, x in enumerate(f)])
        eps = "1e-9::DOUBLE * greatest(" + ", ".join(f"max(v{i})" for i in range(len(f))) + ")"
        model = f"m AS (SELECT l_returnflag AS cls, count(*) AS n, {aggs} FROM split WHERE NOT is_test GROUP BY 1), " \
                f"e AS (SELECT {eps} AS eps, sum(n) AS tot FROM m)"
        terms = " + ".join(
            f"(-0.5::DOUBLE * ln(2 * pi() * (v{i} + eps)) - ({x} - m{i}) * ({x} - m{i}) / (2 * (v{i} + eps)))"
            for i, x in enumerate(f))
    elif kind == "multinomial":
        aggs = ", ".join([f"sum(greatest({x}, 0)) + 1 AS s{i}" for i, x in enumerate(f)])
        tot = " + ".join(f"s{i}" for i in range(len(f)))
        model = f"m0 AS (SELECT l_returnflag AS cls, count(*) AS n, {aggs} FROM split WHERE NOT is_test GROUP BY 1), " \
                f"m AS (SELECT *, {tot} AS st FROM m0), e AS (SELECT sum(n) AS tot FROM m)"
        terms = " + ".join(f"greatest({x}, 0) * ln(s{i} / st)" for i, x in enumerate(f))
    else:
        aggs = ", ".join([f"(sum(CASE WHEN {x} > 0 THEN 1 ELSE 0 END) + 1.0::DOUBLE) / (count(*) + 2.0::DOUBLE) AS p{i}"
                          for i, x in enumerate(f)])
        model = f"m AS (SELECT l_returnflag AS cls, count(*) AS n, {aggs} FROM split WHERE NOT is_test GROUP BY 1), " \
                f"e AS (SELECT sum(n) AS tot FROM m)"
        terms = " + ".join(
            f"(CASE WHEN {x} > 0 THEN ln(p{i}) ELSE ln(1 - p{i}) END)" for i, x in enumerate(f))
    return f"""WITH {SPLIT_SQL}, {model},
s AS (SELECT t.id, t.l_returnflag AS y_true, m.cls, ln(m.n::DOUBLE / e.tot) + {terms} AS score
      FROM (SELECT * FROM split WHERE is_test) t, m, e),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, cls) AS rk,
             max(score) OVER (PARTITION BY id) AS mx FROM s),
z AS (SELECT id, sum(exp(score - mx)) AS se FROM r GROUP BY id),
pred AS (SELECT r.id, y_true, cls AS prediction, round(1.0::DOUBLE / se, 6) AS max_proba FROM r JOIN z USING (id) WHERE rk = 1)
{extra if extra else 'SELECT id, y_true, prediction, max_proba FROM pred'}"""


def _nb_pred(spark, sf, kind):
    sp = li_split(spark, sf)
    train = sp.where(~F.col("is_test"))
    test = sp.where(F.col("is_test")).withColumnRenamed("l_returnflag", "y_true")
    model = B.fit_naive_bayes(train, LI_FEATURES, "l_returnflag", kind)
    out = model.transform(test)
    return out.select("id", "y_true", "prediction", F.round(F.array_max("proba"), 6).alias("max_proba"))


@reg("b1_gauss", _nb_sql("gaussian"))
def b1_gauss(spark, sf):
    return _nb_pred(spark, sf, "gaussian")


@reg("b2_multi", _nb_sql("multinomial"))
def b2_multi(spark, sf):
    return _nb_pred(spark, sf, "multinomial")


@reg("b3_bern", _nb_sql("bernoulli"))
def b3_bern(spark, sf):
    return _nb_pred(spark, sf, "bernoulli")


PER_CLASS_SQL = """
k AS (SELECT label, sum(CASE WHEN y_true = label AND prediction = label THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y_true = label THEN 1 ELSE 0 END) AS support,
             sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS predicted, count(*) AS total
      FROM {src}, (SELECT y_true AS label FROM {src} UNION SELECT prediction FROM {src}) l GROUP BY label),
pc AS (SELECT label, tp::BIGINT AS tp, (total - support - predicted + tp)::BIGINT AS tn, (predicted - tp)::BIGINT AS fp,
              (support - tp)::BIGINT AS fn, support::BIGINT AS support,
              CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0.0::DOUBLE END AS p,
              CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0.0::DOUBLE END AS r FROM k),
pcm AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0::DOUBLE END AS f FROM pc)"""


def _per_class_select():
    return ("SELECT label, tp, tn, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, "
            "round(f, 6) AS f1, support FROM pcm")


@reg("b1_gauss_metrics", _nb_sql("gaussian", "," + PER_CLASS_SQL.format(src="pred") + " " + _per_class_select()))
def b1_gauss_metrics(spark, sf):
    """Flagship: Gaussian NB on lineitem, per-class metrics of the test rows."""
    return E.per_class_metrics(b1_gauss(spark, sf))


@reg("b4_proba", _nb_sql("gaussian", ", q AS (SELECT r.id, r.cls, round(exp(r.score - r.mx) / z.se, 6) AS proba "
                                     "FROM r JOIN z USING (id)) SELECT id, cls AS class, proba FROM q"))
def b4_proba(spark, sf):
    sp = li_split(spark, sf)
    model = B.fit_gaussian(sp.where(~F.col("is_test")), LI_FEATURES, "l_returnflag")
    out = model.transform(sp.where(F.col("is_test")))
    cls = F.array(*[F.lit(v) for v in model.classes])
    return out.select("id", F.explode(F.arrays_zip(cls.alias("class"), F.col("proba").alias("proba"))).alias("z")).select(
        "id", F.col("z.class").alias("class"), F.round("z.proba", 6).alias("proba"))


@reg("b6_params", f"""WITH {SPLIT_SQL}
SELECT l_returnflag AS class, count(*)::BIGINT AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS prior,
""" + ", ".join(f"round(avg({x}), 6) AS mean_{x}" for x in LI_FEATURES) + """
FROM split WHERE NOT is_test GROUP BY 1""")
def b6_params(spark, sf):
    sp = li_split(spark, sf)
    model = B.fit_gaussian(sp.where(~F.col("is_test")), LI_FEATURES, "l_returnflag")
    p = model.params(spark)
    return p.select("class", "n", F.round("prior", 6).alias("prior"),
                    *[F.round(F.col("theta")[i], 6).alias(f"mean_{x}") for i, x in enumerate(LI_FEATURES)])


@reg("b7_explain", _nb_sql("gaussian", "SELECT id, prediction, max_proba FROM pred"))
def b7_explain(spark, sf):
    sp = li_split(spark, sf)
    model = B.fit_gaussian(sp.where(~F.col("is_test")), LI_FEATURES, "l_returnflag")
    out = B.explain(model, sp.where(F.col("is_test")))
    return out.select("id", "prediction", F.round("max_proba", 6).alias("max_proba"))


# ---- metrics on rule predictions ---------------------------------------------------

@reg("e1_confusion", f"""
WITH l AS (SELECT y_true AS label FROM {RULE_SRC} UNION SELECT prediction FROM {RULE_SRC}),
c AS (SELECT y_true, prediction AS y_pred, count(*) AS n FROM {RULE_SRC} GROUP BY 1, 2)
SELECT a.label AS y_true, b.label AS y_pred, coalesce(c.n, 0)::BIGINT AS n
FROM l a, l b LEFT JOIN c ON c.y_true = a.label AND c.y_pred = b.label""")
def e1_confusion(spark, sf):
    return E.confusion_matrix(rule_preds(spark, sf))


@reg("e2_counts", "WITH " + PER_CLASS_SQL.format(src=RULE_SRC).strip() + " SELECT label, tp, tn, fp, fn, support FROM pcm")
def e2_counts(spark, sf):
    return E.per_class_counts(rule_preds(spark, sf)).select("label", "tp", "tn", "fp", "fn", "support")


@reg("e3_accuracy", f"SELECT round(avg(CASE WHEN y_true = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy FROM {RULE_SRC}")
def e3_accuracy(spark, sf):
    return E.overall_metrics(rule_preds(spark, sf)).select("accuracy")


_AVG_SQL = "WITH " + PER_CLASS_SQL.format(src=RULE_SRC).strip() + """,
av AS (SELECT sum(tp)::DOUBLE / sum(tp + fp) AS p_micro, sum(tp)::DOUBLE / sum(tp + fn) AS r_micro,
              avg(p) AS p_macro, avg(r) AS r_macro, avg(f) AS f_macro_c,
              sum(p * support) / sum(support) AS p_w, sum(r * support) / sum(support) AS r_w,
              sum(f * support) / sum(support) AS f_w_c FROM pcm)"""


def _hm(a, b):
    return f"(CASE WHEN {a} + {b} > 0 THEN 2 * {a} * {b} / ({a} + {b}) ELSE 0.0::DOUBLE END)"


@reg("e4_precision", _AVG_SQL + " SELECT round(p_micro, 6) AS precision_micro, round(p_macro, 6) AS precision_macro, "
     "round(p_w, 6) AS precision_weighted FROM av")
def e4_precision(spark, sf):
    return E.overall_metrics(rule_preds(spark, sf)).select("precision_micro", "precision_macro", "precision_weighted")


@reg("e5_recall", _AVG_SQL + " SELECT round(r_micro, 6) AS recall_micro, round(r_macro, 6) AS recall_macro, "
     "round(r_w, 6) AS recall_weighted FROM av")
def e5_recall(spark, sf):
    return E.overall_metrics(rule_preds(spark, sf)).select("recall_micro", "recall_macro", "recall_weighted")


@reg("e6_f1", _AVG_SQL + f" SELECT round({_hm('p_w', 'r_w')}, 6) AS f1_weighted, round({_hm('p_macro', 'r_macro')}, 6) "
     "AS f1_macro, round(f_w_c, 6) AS f1_weighted_of_classes, round(f_macro_c, 6) AS f1_macro_of_classes FROM av")
def e6_f1(spark, sf):
    return E.f1_scores(rule_preds(spark, sf))


@reg("e7_overall", _AVG_SQL + f""" SELECT round(avg_acc, 6) AS accuracy, round(p_w, 6) AS precision, round(r_w, 6) AS recall,
  round({_hm('p_w', 'r_w')}, 6) AS f1, round(p_micro, 6) AS precision_micro, round(r_micro, 6) AS recall_micro,
  round({_hm('p_micro', 'r_micro')}, 6) AS f1_micro, round(p_macro, 6) AS precision_macro, round(r_macro, 6) AS recall_macro,
  round({_hm('p_macro', 'r_macro')}, 6) AS f1_macro, round(p_w, 6) AS precision_weighted, round(r_w, 6) AS recall_weighted,
  round({_hm('p_w', 'r_w')}, 6) AS f1_weighted, (SELECT count(*) FROM pcm)::BIGINT AS n_labels
FROM av, (SELECT avg(CASE WHEN y_true = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE AS avg_acc FROM {RULE_SRC})""")
def e7_overall(spark, sf):
    return E.overall_metrics(rule_preds(spark, sf))


@reg("e7_binary", "WITH " + PER_CLASS_SQL.format(src=BIN_SRC).strip() + f""",
b AS (SELECT p, r FROM pcm WHERE label = (SELECT max(label) FROM pcm))
SELECT round((SELECT avg(CASE WHEN y_true = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE FROM {BIN_SRC}), 6) AS accuracy,
  round(p, 6) AS precision, round(r, 6) AS recall, round({_hm('p', 'r')}, 6) AS f1,
  NULL::DOUBLE AS precision_micro, NULL::DOUBLE AS recall_micro, NULL::DOUBLE AS f1_micro,
  NULL::DOUBLE AS precision_macro, NULL::DOUBLE AS recall_macro, NULL::DOUBLE AS f1_macro,
  NULL::DOUBLE AS precision_weighted, NULL::DOUBLE AS recall_weighted, NULL::DOUBLE AS f1_weighted, 2::BIGINT AS n_labels FROM b""")
def e7_binary(spark, sf):
    return E.overall_metrics(bin_preds(spark, sf))


@reg("e8_per_class", "WITH " + PER_CLASS_SQL.format(src=RULE_SRC).strip() + " " + _per_class_select())
def e8_per_class(spark, sf):
    return E.per_class_metrics(rule_preds(spark, sf))


@reg("e9_report", "WITH " + PER_CLASS_SQL.format(src=RULE_SRC).strip() + """
SELECT label AS "row", round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM pcm
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp)::DOUBLE / sum(support), 6), sum(support)::BIGINT FROM pcm
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM pcm
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM pcm""")
def e9_report(spark, sf):
    return E.classification_report(rule_preds(spark, sf))


@reg("e10_pr", """
WITH g AS (SELECT l_extendedprice::DOUBLE AS threshold, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS pos,
                  count(*) AS cnt FROM lineitem GROUP BY 1),
c AS (SELECT threshold, pos, sum(pos) OVER (ORDER BY threshold DESC) AS cp, sum(cnt) OVER (ORDER BY threshold DESC) AS cc FROM g),
t AS (SELECT sum(pos) AS tp FROM g)
SELECT round(threshold, 6) AS threshold, round(cp::DOUBLE / cc, 6) AS precision, round(cp::DOUBLE / tp, 6) AS recall,
       round(pos::DOUBLE / tp * (cp::DOUBLE / cc), 12) AS ap_term FROM c, t""")
def e10_pr(spark, sf):
    from .common import table

    return E.pr_curve(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", "R")


@reg("e10_ap", """
WITH g AS (SELECT l_extendedprice::DOUBLE AS threshold, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS pos,
                  count(*) AS cnt FROM lineitem GROUP BY 1),
c AS (SELECT threshold, pos, sum(pos) OVER (ORDER BY threshold DESC) AS cp, sum(cnt) OVER (ORDER BY threshold DESC) AS cc FROM g),
t AS (SELECT sum(pos) AS tp FROM g)
SELECT round(sum(round(pos::DOUBLE / tp * (cp::DOUBLE / cc), 12)), 6) AS average_precision FROM c, t""")
def e10_ap(spark, sf):
    from .common import table

    return E.average_precision(E.pr_curve(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", "R"))


_CMP_SRC = (f"(SELECT 'discount_rule' AS algo, y_true, prediction FROM {RULE_SRC} UNION ALL "
            f"SELECT 'tax_rule', l_returnflag, {RULE_PRED2_SQL} FROM lineitem)")


@reg("e11_compare", f"""
WITH cc AS (SELECT algo, y_true, prediction, count(*) AS n FROM {_CMP_SRC} GROUP BY ALL),
t AS (SELECT algo, y_true AS label, sum(n) AS support, sum(CASE WHEN y_true = prediction THEN n ELSE 0 END) AS tp FROM cc GROUP BY ALL),
p AS (SELECT algo, prediction AS label, sum(n) AS predicted FROM cc GROUP BY ALL),
k AS (SELECT coalesce(t.algo, p.algo) AS algo, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support,
             coalesce(predicted, 0) AS predicted FROM t FULL OUTER JOIN p ON t.algo = p.algo AND t.label = p.label),
m AS (SELECT algo, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0.0::DOUBLE END AS p,
             CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0.0::DOUBLE END AS r, tp, support FROM k),
a AS (SELECT algo, sum(tp)::DOUBLE / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision,
             sum(r * support) / sum(support) AS recall FROM m GROUP BY algo)
SELECT algo, round(accuracy * 100, 4) AS accuracy_pct, round(precision * 100, 4) AS precision_pct,
       round(recall * 100, 4) AS recall_pct, round({_hm('precision', 'recall')} * 100, 4) AS f1_pct,
       row_number() OVER (ORDER BY accuracy DESC, algo) AS rank FROM a""")
def e11_compare(spark, sf):
    li = lineitem(spark, sf)
    a = li.select(F.lit("discount_rule").alias("algo"), F.col("l_returnflag").alias("y_true"),
                  F.expr(RULE_PRED_SQL).alias("prediction"))
    b = li.select(F.lit("tax_rule").alias("algo"), F.col("l_returnflag").alias("y_true"),
                  F.expr(RULE_PRED2_SQL).alias("prediction"))
    return E.compare_metrics(a.unionByName(b), "algo")
