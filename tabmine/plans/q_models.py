"""Registered queries for the tree, SVM, hierarchies, DIANA, run registry,
classifier comparison, preprocessing chain and the remaining source /
profiling operators."""

from __future__ import annotations


import numpy as np
from pyspark.sql import functions as F

from ..operators import compare as X
from ..operators import diana as DI
from ..operators import hierarchy as H
from ..operators import impute as M
from ..operators import knn as K
from ..operators import profile as P
from ..operators import runs as R
from ..operators import scale as N
from ..operators import select as S
from ..operators import svm as V
from ..operators import tree as T
from ..operators.cluster_metrics import cluster_metrics
from ..operators.kmeans import kmeans, random_init, vec_frame
from ..operators.preprocess import Preprocessor
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import io as IO
from .common import CUSTOMER_2D_SQL, LI_FEATURES, LI_ID_SQL, Q_NULL_SQL, customer_2d, embeddings, lineitem, table
from .q_classify import SPLIT_SQL, li_split
from .q_cluster import emb_split

Q: dict = {}
SQL: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


CU2 = f"({CUSTOMER_2D_SQL})"


def _scratch(spark, name):
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{name}-{uuid.uuid4().hex}"


# ---- decision tree ---------------------------------------------------------------

def _ent(cols, tot):
    return " + ".join(f"(CASE WHEN {c} > 0 THEN -({c}::DOUBLE / {tot}) * log2({c}::DOUBLE / {tot}) ELSE 0.0 END)" for c in cols)


_CLS = ["A", "N", "R"]
_T1_SQL = f"""WITH {SPLIT_SQL}, tr AS (SELECT * FROM split WHERE NOT is_test),
u AS ({' UNION ALL '.join(f"SELECT {i} AS f, {x}::DOUBLE AS v, l_returnflag AS y FROM tr" for i, x in enumerate(LI_FEATURES))}),
h AS (SELECT f, v, {', '.join(f"count(*) FILTER (WHERE y = '{c}') AS c{j}" for j, c in enumerate(_CLS))} FROM u GROUP BY f, v),
c AS (SELECT f, v, {', '.join(f"sum(c{j}) OVER (PARTITION BY f ORDER BY v) AS l{j}" for j in range(3))} FROM h),
n AS (SELECT {', '.join(f"count(*) FILTER (WHERE l_returnflag = '{c}') AS n{j}" for j, c in enumerate(_CLS))} FROM tr),
s AS (SELECT f, v, {', '.join(f"l{j}, n{j} - l{j} AS r{j}, n{j}" for j in range(3))},
        l0 + l1 + l2 AS nl, (n0 - l0) + (n1 - l1) + (n2 - l2) AS nr, n0 + n1 + n2 AS nt FROM c, n),
g AS (SELECT f, v, ({_ent(['n0', 'n1', 'n2'], 'nt')}) - (nl::DOUBLE / nt) * ({_ent(['l0', 'l1', 'l2'], 'nl')})
        - (nr::DOUBLE / nt) * ({_ent(['r0', 'r1', 'r2'], 'nr')}) AS gain,
        -(nl::DOUBLE / nt) * log2(nl::DOUBLE / nt) - (nr::DOUBLE / nt) * log2(nr::DOUBLE / nt) AS si FROM s WHERE nl >= 1 AND nr >= 1),
r AS (SELECT f, v, CASE WHEN si = 0 THEN 0.0 ELSE gain / si END AS ratio FROM g)
SELECT f::INTEGER AS feature, round(v, 6) AS threshold, round(ratio, 6) AS gain_ratio FROM r ORDER BY ratio DESC, f, v LIMIT 1"""


def _li_tree(spark, sf, depth=5):
    sp = li_split(spark, sf)
    return T.fit_tree(sp.where(~F.col("is_test")), LI_FEATURES, "l_returnflag", max_depth=depth), sp


@reg("t1_root", _T1_SQL)
def t1_root(spark, sf):
    tree, _ = _li_tree(spark, sf, depth=1)
    root = tree.nodes[1]
    return spark.createDataFrame([(int(root.feature), round(root.threshold, 6), round(root.gain, 6))],
                                 "feature int, threshold double, gain_ratio double")


@reg("t1_tree")
def t1_tree(spark, sf):
    tree, _ = _li_tree(spark, sf, 5)
    return tree.node_table(spark)


@reg("t2_predict")
def t2_predict(spark, sf):
    tree, sp = _li_tree(spark, sf, 5)
    test = sp.where(F.col("is_test"))
    return tree.transform(test).select("id", F.col("l_returnflag").alias("y_true"), "prediction")


@reg("t3_importance")
def t3_importance(spark, sf):
    tree, _ = _li_tree(spark, sf, 5)
    return tree.importances(spark)


@reg("t4_rules")
def t4_rules(spark, sf):
    tree, _ = _li_tree(spark, sf, 3)
    return tree.rules(spark)


@reg("t5_shape")
def t5_shape(spark, sf):
    tree, _ = _li_tree(spark, sf, 5)
    return spark.createDataFrame([(tree.depth(), tree.n_leaves())], "depth int, n_leaves int")


def _doc_quality(spark, sf):
    lab = table(spark, sf, "labels")
    doc = table(spark, sf, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id")


@reg("t6_sweep")
def t6_sweep(spark, sf):
    """Tree on labels x documents (quality from length and toxicity), grown
    once to depth 20, accuracy of every truncation on the validation rows."""
    from ..operators.split import stratified_split

    d = stratified_split(_doc_quality(spark, sf), "doc_id", "quality", 0.3, 42)
    tree = T.fit_tree(d.where(~F.col("is_test")), ["n_chars", "toxic"], "quality", max_depth=20)
    return T.depth_sweep(tree, d.where(F.col("is_test")), "quality", range(1, 21))


# ---- SVM ----------------------------------------------------------------------------

def _emb_svm(spark, sf, kernel, C=1.0, gamma="scale", tol=1e-3):
    sp = emb_split(spark, sf)
    model = V.fit_svm(sp.where(~F.col("is_test")), "vec", "label", kernel=kernel, C=C, gamma=gamma, id_col="vec_id", tol=tol)
    return model, sp


@reg("v1_linear")
def v1_linear(spark, sf):
    m, sp = _emb_svm(spark, sf, "linear")
    return m.transform(sp.where(F.col("is_test")), "vec").select("vec_id", "label", "prediction")


@reg("v1_rbf")
def v1_rbf(spark, sf):
    m, sp = _emb_svm(spark, sf, "rbf")
    return m.transform(sp.where(F.col("is_test")), "vec").select("vec_id", "label", "prediction")


@reg("v4_maps")
def v4_maps(spark, sf):
    """Nystrom feature maps of each kernel: feature count, part of the kernel missed, and training accuracy."""
    rows = []
    for kind in ("rbf", "poly", "sigmoid"):
        m, sp = _emb_svm(spark, sf, kind, tol=1e-2)
        acc = m.transform(sp.where(~F.col("is_test")), "vec").agg(
            F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).first()["a"]
        rows.append((kind, int(m.proj.shape[1]), round(float(m.residual), 6), round(float(acc), 6)))
    return spark.createDataFrame(rows, "kernel string, n_features int, residual double, train_accuracy double")


@reg("v5_alphas")
def v5_alphas(spark, sf):
    """Support rows of the linear SVM fitted on lineitem (l_linestatus): their number and dual variables per class, the
    objective and the gap to its lower bound."""
    rows = _li_vec(spark, sf)
    m = V.fit_svm(rows, "vec", "l_linestatus", kernel="linear", C=1.0)
    per = V.dual_rows(m, rows, "vec", "l_linestatus").groupBy(F.col("l_linestatus").alias("class")).agg(
        F.count(F.lit(1)).alias("n_support"), F.round(F.sum("alpha"), 6).alias("alpha_sum"), F.max("alpha").alias("alpha_max"))
    return per.withColumn("objective", F.lit(round(float(m.objectives[0]), 6))).withColumn("gap", F.lit(float(m.gaps[0])))


@reg("v6_grid")
def v6_grid(spark, sf):
    """V6: C {0.1, 1, 10} x gamma {scale, 0.01, 0.1} x kernel {linear, rbf};
    linear fitted once per C (gamma does not apply). Best = first max
    validation accuracy."""
    sp = emb_split(spark, sf)
    train, val = sp.where(~F.col("is_test")), sp.where(F.col("is_test"))
    rows = []
    for C in (0.1, 1.0, 10.0):
        lin = V.fit_svm(train, "vec", "label", "linear", C=C, tol=1e-2)
        acc_l = lin.transform(val, "vec").agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        for gamma in ("scale", 0.01, 0.1):
            rows.append(("linear", C, str(gamma), round(float(acc_l), 6)))
            m = V.fit_svm(train, "vec", "label", "rbf", C=C, gamma=gamma, id_col="vec_id", tol=1e-2)
            acc = m.transform(val, "vec").agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
            rows.append(("rbf", C, str(gamma), round(float(acc), 6)))
    out = spark.createDataFrame(rows, "kernel string, C double, gamma string, val_accuracy double")
    best = max(range(len(rows)), key=lambda i: (rows[i][3], -i))
    return out.withColumn("best", (F.col("kernel") == rows[best][0]) & (F.col("C") == rows[best][1])
                          & (F.col("gamma") == rows[best][2]))


# fixed linear OvO model on the raw lineitem features (SQL-checkable scoring)
_FIXED_W = {(0, 1): ([0.04, 0.00002, -8.0, 6.0], -2.0), (0, 2): ([-0.03, 0.00001, 5.0, -4.0], 0.5),
            (1, 2): ([0.02, -0.00003, 3.0, 9.0], 0.4)}


def _fixed_model(classes=("A", "N", "R")):
    pairs = sorted(_FIXED_W)
    W = np.array([list(_FIXED_W[p][0]) + [_FIXED_W[p][1]] for p in pairs])
    return V.SVMModel(list(classes), np.zeros(4), np.ones(4), "linear", 1.0, 3, 0.0, None, None, pairs, W, 1.0)


def _dec_sql(p):
    w, b = _FIXED_W[p]
    return " + ".join(f"{wi!r}::DOUBLE * {x}" for wi, x in zip(w, LI_FEATURES)) + f" + {b!r}::DOUBLE"


_VOTES_SQL = f"""WITH d AS (SELECT {LI_ID_SQL} AS id, l_returnflag, {_dec_sql((0, 1))} AS d01, {_dec_sql((0, 2))} AS d02,
  {_dec_sql((1, 2))} AS d12 FROM lineitem),
v AS (SELECT id, l_returnflag, d01, d02, d12,
  (CASE WHEN d01 < 0 THEN 1 ELSE 0 END) + (CASE WHEN d02 < 0 THEN 1 ELSE 0 END) AS va,
  (CASE WHEN d01 >= 0 THEN 1 ELSE 0 END) + (CASE WHEN d12 < 0 THEN 1 ELSE 0 END) AS vn,
  (CASE WHEN d02 >= 0 THEN 1 ELSE 0 END) + (CASE WHEN d12 >= 0 THEN 1 ELSE 0 END) AS vr FROM d)"""
_PRED_SQL = "CASE WHEN va >= vn AND va >= vr THEN 'A' WHEN vn >= vr THEN 'N' ELSE 'R' END"


def _li_vec(spark, sf):
    return lineitem(spark, sf).select("id", "l_returnflag", "l_linestatus", F.array(*[F.col(c) for c in LI_FEATURES]).alias("vec"))


@reg("v2_vote", _VOTES_SQL + f" SELECT id, {_PRED_SQL} AS prediction FROM v")
def v2_vote(spark, sf):
    return _fixed_model().transform(_li_vec(spark, sf), "vec").select("id", "prediction")


@reg("v7_explain", _VOTES_SQL + f""" SELECT id, {_PRED_SQL} AS prediction,
  round(greatest(abs(d01), abs(d02), abs(d12)), 9) AS confidence, l_returnflag = ({_PRED_SQL}) AS correct FROM v""")
def v7_explain(spark, sf):
    out = _fixed_model().transform(_li_vec(spark, sf), "vec")
    return out.select("id", "prediction", F.round("confidence", 9).alias("confidence"),
                      (F.col("l_returnflag") == F.col("prediction")).alias("correct"))


_BIN_W = ([0.03, -0.00001, 2.0, -20.0], 0.3)


def _bin_model():
    W = np.array([list(_BIN_W[0]) + [_BIN_W[1]]])
    return V.SVMModel(["F", "O"], np.zeros(4), np.ones(4), "linear", 1.0, 3, 0.0, None, None, [(0, 1)], W, 1.0)


_BIN_DEC = " + ".join(f"{wi!r}::DOUBLE * {x}" for wi, x in zip(_BIN_W[0], LI_FEATURES)) + f" + {_BIN_W[1]!r}::DOUBLE"


@reg("v3_decision", f"""SELECT {LI_ID_SQL} AS id, round({_BIN_DEC}, 9) AS decision,
  CASE WHEN {_BIN_DEC} >= 0 THEN 'O' ELSE 'F' END AS prediction, round(1 / (1 + exp(-({_BIN_DEC}))), 9) AS proba FROM lineitem""")
def v3_decision(spark, sf):
    out = _bin_model().transform(_li_vec(spark, sf), "vec")
    return out.select("id", F.round("decision", 9).alias("decision"), "prediction",
                      F.round(F.col("proba")[1], 9).alias("proba"))


@reg("v5_support", f"""SELECT l_linestatus AS class, count(*)::BIGINT AS n_support FROM lineitem
WHERE (CASE WHEN l_linestatus = 'F' THEN -1.0 ELSE 1.0 END) * ({_BIN_DEC}) <= 1 + 1e-8 GROUP BY 1""")
def v5_support(spark, sf):
    return V.support_rows(_bin_model(), _li_vec(spark, sf), "vec", "l_linestatus")


@reg("v8_grid", f"""WITH r AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_extendedprice) AS c, max(l_extendedprice) AS d FROM lineitem),
g AS (SELECT i AS ix, j AS iy, (a - 1) + i * ((b - a + 2) / 99.0::DOUBLE) AS gx, (c - 1) + j * ((d - c + 2) / 99.0::DOUBLE) AS gy
      FROM r, range(100) t1(i), range(100) t2(j)),
dd AS (SELECT ix, iy, {_dec_sql((0, 1)).replace('l_quantity', 'gx').replace('l_extendedprice', 'gy').replace('l_discount', '0').replace('l_tax', '0')} AS d01,
  {_dec_sql((0, 2)).replace('l_quantity', 'gx').replace('l_extendedprice', 'gy').replace('l_discount', '0').replace('l_tax', '0')} AS d02,
  {_dec_sql((1, 2)).replace('l_quantity', 'gx').replace('l_extendedprice', 'gy').replace('l_discount', '0').replace('l_tax', '0')} AS d12 FROM g),
v AS (SELECT ix, iy, (CASE WHEN d01 < 0 THEN 1 ELSE 0 END) + (CASE WHEN d02 < 0 THEN 1 ELSE 0 END) AS va,
  (CASE WHEN d01 >= 0 THEN 1 ELSE 0 END) + (CASE WHEN d12 < 0 THEN 1 ELSE 0 END) AS vn,
  (CASE WHEN d02 >= 0 THEN 1 ELSE 0 END) + (CASE WHEN d12 >= 0 THEN 1 ELSE 0 END) AS vr FROM dd)
SELECT ix::BIGINT AS ix, iy::BIGINT AS iy, {_PRED_SQL} AS prediction FROM v""")
def v8_grid(spark, sf):
    m = _fixed_model()
    li = table(spark, sf, "lineitem")
    out = V.score_grid(lambda g: m.transform(g, "vec"), li, LI_FEATURES, 0, 1, 100)
    return out.select(F.col("ix").cast("bigint").alias("ix"), F.col("iy").cast("bigint").alias("iy"), "prediction")


# ---- hierarchies ------------------------------------------------------------------------

def _agnes(spark, sf, linkage, k=4):
    return H.agnes(embeddings(spark, sf), "vec_id", vec_col="vec", n_clusters=k, linkage=linkage)


@reg("c8_agnes_ward")
def c8_agnes_ward(spark, sf):
    return _agnes(spark, sf, "ward")[0]


@reg("c8_agnes_complete")
def c8_agnes_complete(spark, sf):
    return _agnes(spark, sf, "complete")[0]


@reg("c8_agnes_average")
def c8_agnes_average(spark, sf):
    return _agnes(spark, sf, "average")[0]


@reg("c8_agnes_single")
def c8_agnes_single(spark, sf):
    return _agnes(spark, sf, "single")[0]


@reg("c10_linkage")
def c10_linkage(spark, sf):
    return _agnes(spark, sf, "ward")[1].select("step", "left", "right", F.round("dist", 6).alias("dist"), "size")


@reg("c11_cut_k")
def c11_cut_k(spark, sf):
    return _agnes(spark, sf, "complete", 6)[0]


_CUT_T = 1.1
_SL_SQL = f"""WITH RECURSIVE p AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
e AS (SELECT a.vec_id AS s, b.vec_id AS t FROM p a JOIN p b ON list_distance(a.v, b.v) <= {_CUT_T}::DOUBLE),
reach(src, dst) AS (SELECT vec_id, vec_id FROM p UNION SELECT r.src, e.t FROM reach r JOIN e ON e.s = r.dst)
SELECT src AS vec_id, min(dst) AS anchor FROM reach GROUP BY src"""


@reg("c12_cut_dist", _SL_SQL)
def c12_cut_dist(spark, sf):
    """Single linkage cut at distance t = components of the t-graph; each
    row reports the smallest id of its cluster."""
    units, row_map = H.units_of(embeddings(spark, sf), "vec_id", vec_col="vec")
    units = cut_lineage(units)
    link = H.linkage_table(spark, H.rac(units, "single"), units)
    lab = row_map.join(H.cut_labels(spark, link, units, t=_CUT_T), "uid")
    return lab.groupBy("cluster").agg(F.min("id").alias("anchor")).join(lab, "cluster").select(
        F.col("id").alias("vec_id"), "anchor")


@reg("q9_agnes_curve")
def q9_agnes_curve(spark, sf):
    """Q9: one linkage table, cut at every k, silhouettes in one multi-label job."""
    e = embeddings(spark, sf)
    v = vec_frame(e, "vec_id", None, "vec")
    units, row_map = H.units_of(e, "vec_id", vec_col="vec")
    units = cut_lineage(units)
    link = H.linkage_table(spark, H.rac(units, "ward"), units)
    ks = list(range(2, 11))
    labs = None
    for i, k in enumerate(ks):
        lk = H.cut_labels(spark, link, units, k=k).select("uid", F.col("cluster").alias(f"k{i}"))
        labs = lk if labs is None else labs.join(lk, "uid")
    labels = row_map.join(labs, "uid").select("id", F.array(*[F.col(f"k{i}") for i in range(len(ks))]).alias("labs"))
    sil = S.multi_silhouette(v, labels, len(ks))
    return spark.createDataFrame([(k, round(float(sil[i] or 0.0), 6)) for i, k in enumerate(ks)], "k int, silhouette double")


@reg("q13_cut")
def q13_cut(spark, sf):
    _, link = _agnes(spark, sf, "ward")
    return S.dendrogram_cut_height(link, 4).select(F.round("cut_height", 6).alias("cut_height"))


@reg("c13_diana3")
def c13_diana3(spark, sf):
    labels, _ = DI.diana(embeddings(spark, sf), "vec_id", n_clusters=3, vec_col="vec")
    return labels


@reg("c13_history")
def c13_history(spark, sf):
    _, hist = DI.diana(embeddings(spark, sf), "vec_id", n_clusters=4, vec_col="vec")
    return hist.select("split_cluster", "new_cluster", F.round("split_diameter", 6).alias("split_diameter"))


@reg("c14_diameter", f"""WITH p AS (SELECT c.*, cu.c_mktsegment FROM {CU2} c JOIN customer cu USING (c_custkey))
SELECT a.c_mktsegment AS segment, round(max(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 6) AS diameter
FROM p a JOIN p b ON a.c_mktsegment = b.c_mktsegment GROUP BY 1""")
def c14_diameter(spark, sf):
    cu = customer_2d(spark, sf).join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    segs = [r[0] for r in cu.select("c_mktsegment").distinct().collect()]
    rows = []
    for sgm in segs:
        v = vec_frame(cu.where(F.col("c_mktsegment") == sgm), "c_custkey", ["x", "y"])
        rows.append((sgm, round(DI.cluster_diameter(v), 6)))
    return spark.createDataFrame(rows, "segment string, diameter double")


@reg("c15_splinter")
def c15_splinter(spark, sf):
    v = vec_frame(embeddings(spark, sf), "vec_id", None, "vec")
    return DI.splinter_split(v).select(F.col("id").alias("vec_id"), "side")


@reg("q10_diana_curve")
def q10_diana_curve(spark, sf):
    return DI.diana_curve(embeddings(spark, sf), "vec_id", ks=range(2, 11), vec_col="vec")


@reg("q12_report")
def q12_report(spark, sf):
    """Q12: K-Means inertia and silhouette per k beside the DBSCAN 90 % eps."""
    cu = customer_2d(spark, sf)
    el, sc = S.elbow_and_silhouette(cu, "c_custkey", ["x", "y"])
    eps = S.best_dbscan_params(cu, "c_custkey", ["x", "y"]).first()["eps"]
    return el.join(sc, "k").withColumn("dbscan_eps", F.lit(eps))


# ---- run registry ----------------------------------------------------------------------

def _runs(spark, sf):
    """Three real clustering runs on the customer table, appended to a new
    registry table and read back."""
    cu = customer_2d(spark, sf)
    v = vec_frame(cu, "c_custkey", ["x", "y"])
    rows = []
    for n, k in ((1, 3), (2, 4)):
        res = kmeans(cu, "c_custkey", ["x", "y"], k=k, init=random_init(v, k, 42), max_iter=20)
        # stored: every metric goes over the labels again
        lab = cut_lineage(cu.join(res.labels, "c_custkey").select("c_custkey", F.array("x", "y").alias("vec"), "cluster"))
        met = cluster_metrics(lab, "c_custkey", "vec", "cluster")
        rows.append(R.run_record(spark, n, "KMeans", {"n_clusters": k, "init": "random"}, "customer", ["x", "y"],
                                 lab, met))
    from ..operators.dbscan import dbscan

    lab = cut_lineage(dbscan(cu, "c_custkey", ["x", "y"], eps=0.05, min_samples=3).join(cu, "c_custkey").select(
        "c_custkey", F.array("x", "y").alias("vec"), "cluster"))
    met = cluster_metrics(lab, "c_custkey", "vec", "cluster")
    rows.append(R.run_record(spark, 3, "DBSCAN", {"eps": 0.05, "min_samples": 3}, "customer", ["x", "y"], lab, met))
    path = _scratch(spark, "runs")
    for r in rows:
        R.append_runs(r, path)
    return R.read_runs(spark, path)


@reg("r1_record")
def r1_record(spark, sf):
    return _runs(spark, sf).select("run_id", "algo", "n_clusters", "cluster_sizes")


@reg("r2_metrics")
def r2_metrics(spark, sf):
    return R.runs_metrics_table(_runs(spark, sf))


@reg("r3_params")
def r3_params(spark, sf):
    return R.runs_params_table(_runs(spark, sf))


@reg("r4_compare")
def r4_compare(spark, sf):
    return R.compare_runs(_runs(spark, sf), "Run1_KMeans_k3", "Run3_DBSCAN_eps0.1_min3")


@reg("r5_compatible")
def r5_compatible(spark, sf):
    return R.compatible_runs(_runs(spark, sf), customer_2d(spark, sf).columns)


@reg("r6_latest")
def r6_latest(spark, sf):
    return R.latest(_runs(spark, sf))


def _compared(spark, sp, id_col, features, target, algos=None):
    table_, errors = X.compare_classifiers(sp.where(~F.col("is_test")), sp.where(F.col("is_test")), id_col, features, target, algos)
    failed = spark.createDataFrame(errors, "algo string, error string")
    return table_.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


@reg("x2_compare")
def x2_compare(spark, sf):
    """The four default classifiers, tree without a depth limit and RBF SVM, on labels x documents."""
    from ..operators.split import stratified_split

    sp = stratified_split(_doc_quality(spark, sf), "doc_id", "quality", 0.3, 42)
    return _compared(spark, sp, "doc_id", ["n_chars", "toxic"], "quality")


@reg("x2_compare_li")
def x2_compare_li(spark, sf):
    """Three classifiers on lineitem; the tree to depth 20 (without a limit its splits by gain ratio take a row or
    two off each level: 600 of 42,000 rows after 393 levels)."""
    return _compared(spark, li_split(spark, sf), "id", LI_FEATURES, "l_returnflag",
                     [("Naive Bayes", {"type": "gaussian"}), ("C4.5", {"max_depth": 20}), ("k-NN", {"k": 5})])


# ---- preprocessing chain and remaining source / profiling ops -------------------------------

_LI = f"(SELECT *, {LI_ID_SQL} AS id, {Q_NULL_SQL} AS q_null FROM lineitem)"


@reg("d3_chain", f"""WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM {_LI}),
f AS (SELECT id, l_extendedprice, q_null FROM {_LI}, b WHERE l_extendedprice BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)),
m AS (SELECT id, l_extendedprice::DOUBLE AS l_extendedprice, coalesce(q_null::DOUBLE, (SELECT avg(q_null) FROM f)) AS q_null FROM f),
s AS (SELECT avg(l_extendedprice) AS me, stddev_pop(l_extendedprice) AS se, avg(q_null) AS mq, stddev_pop(q_null) AS sq FROM m)
SELECT id, round((l_extendedprice - me) / se, 6) AS l_extendedprice, round((q_null - mq) / sq, 6) AS q_null FROM m, s""")
def d3_chain(spark, sf):
    df = lineitem(spark, sf, with_nulls=True).select("id", "l_extendedprice", "q_null")
    pp = Preprocessor(df).remove_outliers(["l_extendedprice"]).impute("mean").normalise("zscore", ["l_extendedprice", "q_null"])
    return pp.df.select("id", F.round("l_extendedprice", 6).alias("l_extendedprice"), F.round("q_null", 6).alias("q_null"))


@reg("n4_normalise", """WITH s AS (SELECT min(p_size) AS a, max(p_size) AS b, min(p_retailprice) AS c, max(p_retailprice) AS d FROM part)
SELECT p_partkey, round((p_size - a)::DOUBLE / (b - a), 6) AS p_size, round((p_retailprice - c) / (d - c), 6) AS p_retailprice FROM part, s""")
def n4_normalise(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    out = N.normalise(df, "minmax", ["p_size", "p_retailprice"])
    return out.select("p_partkey", F.round("p_size", 6).alias("p_size"), F.round("p_retailprice", 6).alias("p_retailprice"))


_M9_SRC = "(SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal, c_nationkey::DOUBLE AS nat FROM customer)"


@reg("m9_knn", f"""WITH d AS (SELECT q.c_custkey AS q, b.c_custkey AS b, b.bal,
  row_number() OVER (PARTITION BY q.c_custkey ORDER BY abs(q.nat - b.nat), b.c_custkey) AS r
  FROM {_M9_SRC} q, {_M9_SRC} b WHERE q.bal IS NULL AND b.bal IS NOT NULL)
SELECT s.c_custkey, round(coalesce(s.bal, (SELECT avg(bal) FROM d WHERE d.q = s.c_custkey AND r <= 5)), 6) AS bal FROM {_M9_SRC} s""")
def m9_knn(spark, sf):
    cu = table(spark, sf, "customer").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END").alias("bal"),
        F.col("c_nationkey").cast("double").alias("nat"))
    out = K.impute_knn(cu, "c_custkey", ["bal", "nat"], k=5)
    return out.select("c_custkey", F.round("bal", 6).alias("bal"))


@reg("p2_schema", """SELECT (ordinal_position - 1)::INTEGER AS position, column_name AS name,
  CASE WHEN data_type = 'INTEGER' THEN 'int' WHEN data_type = 'VARCHAR' THEN 'string' WHEN data_type = 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN data_type = 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(data_type) END AS type,
  (SELECT count(*) FROM lineitem) AS n_rows, (count(*) OVER ())::INTEGER AS n_columns
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def p2_schema(spark, sf):
    return P.schema_profile(table(spark, sf, "lineitem"))


@reg("s6_catalog", """SELECT 'lineitem' AS name, 'l_returnflag' AS target, count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE lineitem))::BIGINT - 1 AS n_features,
  count(DISTINCT l_returnflag) AS n_classes, false AS has_missing, 'clustering,classification' AS recommended_for FROM lineitem
UNION ALL SELECT 'embeddings', 'label', count(*), (SELECT count(*) FROM (DESCRIBE embeddings))::BIGINT - 1, count(DISTINCT label), false, 'clustering,classification' FROM embeddings
UNION ALL SELECT 'labels', 'quality', count(*), (SELECT count(*) FROM (DESCRIBE labels))::BIGINT - 1, count(DISTINCT quality), false, 'clustering,classification' FROM labels""")
def s6_catalog(spark, sf):
    cat = IO.dataset_catalog(spark, [(t, f"{sf}/{t}.parquet", tgt, True) for t, tgt in
                                     (("lineitem", "l_returnflag"), ("embeddings", "label"), ("labels", "quality"))])
    return cat.select("name", "target", "n_rows", "n_features", "n_classes", "has_missing", F.array_join("recommended_for", ",").alias("recommended_for"))


@reg("s7_upload", "SELECT c_custkey::DOUBLE AS c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer")
def s7_upload(spark, sf):
    """The customer table as an uploaded CSV with blank cells, read with the token and blank rules."""
    cu = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 9 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    path = _scratch(spark, "upload") + ".csv"
    cu.write.csv(path, header=True)
    return IO.read_upload(spark, path).select(F.col("c_custkey").cast("double").alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment")


@reg("s8_version", """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - m) / sd, 6) AS c_acctbal FROM customer, s""")
def s8_version(spark, sf):
    root = _scratch(spark, "versions")
    df = N.scale_zscore(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    IO.save_version(df, root, IO.version_name(["zscore"]), ["normalise_zscore"])
    out = IO.load_version(spark, root)
    return out.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


@reg("s9_runs")
def s9_runs(spark, sf):
    return _runs(spark, sf).select("run_id", "algo", "dataset", "features")


