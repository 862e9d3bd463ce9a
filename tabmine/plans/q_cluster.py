"""Registered queries for distance joins, k-NN, K-Means, K-Medoids, DBSCAN
and cluster quality metrics, with DuckDB twins where SQL can express them
(recursive CTEs for components, unrolled steps for iterative fits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import class_metrics as E
from ..operators import cluster_metrics as Qm
from ..operators import dbscan as D
from ..operators import kmeans as KM
from ..operators import kmedoids as KD
from ..operators import knn as K
from ..operators import pairs as J
from ..operators import split as L
from .common import CUSTOMER_2D_SQL, customer_2d, embeddings

Q: dict = {}
SQL: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


EMB = "(SELECT vec_id, embedding::DOUBLE[] AS vec, label FROM embeddings)"
CU2 = f"({CUSTOMER_2D_SQL})"
EMB_SPLIT = ("split AS (SELECT *, rn <= greatest(1, floor(n * 0.2::DOUBLE)) AS is_test FROM ("
             "SELECT vec_id, embedding::DOUBLE[] AS vec, label, "
             "row_number() OVER (PARTITION BY label ORDER BY md5(concat(vec_id, '42')), vec_id) AS rn, "
             "count(*) OVER (PARTITION BY label) AS n FROM embeddings))")


def _manhattan_sql(a, b):
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: abs({a}[i] - {b}[i])))"


def _dot_sql(a, b):
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]))"


def emb_split(spark, sf):
    e = embeddings(spark, sf)
    return L.stratified_split(e, "vec_id", "label", 0.2, 42)


def _vf(df, id_col="vec_id", vec="vec", lab=None):
    return df.select(F.col(id_col).alias("id"), F.col(vec).alias("vec"),
                     (F.col(lab).cast("string") if lab else F.lit(None).cast("string")).alias("lab"))


# ---- J1 / J6: metrics and kernels on consecutive rows -------------------------

@reg("j1_metrics", f"""
SELECT a.vec_id, round(list_distance(a.vec, b.vec), 6) AS euclidean, round({_manhattan_sql('a.vec', 'b.vec')}, 6) AS manhattan,
  round(1 - {_dot_sql('a.vec', 'b.vec')} / (sqrt({_dot_sql('a.vec', 'a.vec')}) * sqrt({_dot_sql('b.vec', 'b.vec')})), 6) AS cosine,
  round(pow(list_sum(list_transform(range(1, len(a.vec) + 1), lambda i: pow(abs(a.vec[i] - b.vec[i]), 3))), 1.0 / 3), 6) AS minkowski3
FROM {EMB} a JOIN {EMB} b ON b.vec_id = a.vec_id + 1""")
def j1_metrics(spark, sf):
    e = embeddings(spark, sf)
    b = e.select(F.col("vec_id").alias("b_id"), F.col("vec").alias("bvec"))
    j = e.join(b, F.col("b_id") == F.col("vec_id") + 1)
    a_, b_ = F.col("vec"), F.col("bvec")
    return j.select("vec_id",
                    F.round(V.distance(a_, b_, "euclidean"), 6).alias("euclidean"),
                    F.round(V.distance(a_, b_, "manhattan"), 6).alias("manhattan"),
                    F.round(V.distance(a_, b_, "cosine"), 6).alias("cosine"),
                    F.round(V.distance(a_, b_, "minkowski", 3.0), 6).alias("minkowski3"))


@reg("j6_kernels", f"""
SELECT a.vec_id, round({_dot_sql('a.vec', 'b.vec')}, 6) AS linear, round(pow({_dot_sql('a.vec', 'b.vec')} + 1, 3), 4) AS poly,
  round(exp(-0.1::DOUBLE * pow(list_distance(a.vec, b.vec), 2)), 6) AS rbf,
  round(tanh(0.1::DOUBLE * {_dot_sql('a.vec', 'b.vec')}), 6) AS sigmoid
FROM {EMB} a JOIN {EMB} b ON b.vec_id = a.vec_id + 1""")
def j6_kernels(spark, sf):
    e = embeddings(spark, sf)
    b = e.select(F.col("vec_id").alias("b_id"), F.col("vec").alias("bvec"))
    j = e.join(b, F.col("b_id") == F.col("vec_id") + 1)
    a_, b_ = F.col("vec"), F.col("bvec")
    return j.select("vec_id",
                    F.round(V.kernel(a_, b_, "linear"), 6).alias("linear"),
                    F.round(V.kernel(a_, b_, "poly", degree=3), 4).alias("poly"),
                    F.round(V.kernel(a_, b_, "rbf", gamma=0.1), 6).alias("rbf"),
                    F.round(V.kernel(a_, b_, "sigmoid", gamma=0.1), 6).alias("sigmoid"))


# ---- J3 / J4 / J5 ----------------------------------------------------------------

@reg("j3_eps", f"""
SELECT a.c_custkey, count(*)::BIGINT AS n FROM {CU2} a JOIN {CU2} b
  ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.03::DOUBLE GROUP BY a.c_custkey""")
def j3_eps(spark, sf):
    cu = customer_2d(spark, sf)
    v = cu.select(F.col("c_custkey").alias("id"), F.array("x", "y").alias("vec"), F.lit(None).cast("string").alias("lab"))
    return J.eps_neighbour_counts(v, 0.03).select(F.col("id").alias("c_custkey"), "n")


@reg("j4_knn", f"""
SELECT q_id, b_id, rank, round(dist, 6) AS dist FROM (
  SELECT a.vec_id AS q_id, b.vec_id AS b_id, list_distance(a.vec, b.vec) AS dist,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.vec, b.vec), b.vec_id) AS rank
  FROM {EMB} a, {EMB} b WHERE a.vec_id <> b.vec_id) WHERE rank <= 5""")
def j4_knn(spark, sf):
    v = _vf(embeddings(spark, sf))
    nn = J.knn_join(v, v, 5, exclude_self=True)
    return nn.select("q_id", "b_id", F.col("rank").cast("bigint").alias("rank"), F.round("dist", 6).alias("dist"))


_CENTERS3 = f"(SELECT vec, row_number() OVER (ORDER BY md5(concat(vec_id, '42')), vec_id) - 1 AS idx FROM {EMB} ORDER BY md5(concat(vec_id, '42')), vec_id LIMIT 3)"


@reg("j5_nearest", f"""
SELECT vec_id, idx::INTEGER AS idx, round(dist, 6) AS dist FROM (
  SELECT e.vec_id, c.idx, list_distance(e.vec, c.vec) AS dist,
         row_number() OVER (PARTITION BY e.vec_id ORDER BY list_distance(e.vec, c.vec), c.idx) AS r
  FROM {EMB} e, {_CENTERS3} c) WHERE r = 1""")
def j5_nearest(spark, sf):
    e = embeddings(spark, sf)
    v = KM.vec_frame(e, "vec_id", vec_col="vec")
    centers = KM.random_init(v, 3, 42)
    nc = V.nearest_center(F.col("vec"), centers)
    return e.select("vec_id", nc["idx"].cast("int").alias("idx"), F.round(nc["dist"], 6).alias("dist"))


# ---- k-NN classification ---------------------------------------------------------

_NN_SQL = f"""WITH {EMB_SPLIT},
nn AS (SELECT t.vec_id AS q, r.vec_id AS b, r.label::VARCHAR AS lab, list_distance(t.vec, r.vec) AS dist,
              row_number() OVER (PARTITION BY t.vec_id ORDER BY list_distance(t.vec, r.vec), r.vec_id) AS rank
       FROM split t, split r WHERE t.is_test AND NOT r.is_test)"""


def _vote_sql(k, weighted):
    w = "1.0::DOUBLE" if not weighted else "1.0::DOUBLE / (dist + 1e-10::DOUBLE)"
    order = "score DESC, first_rank" if not weighted else "score DESC, lab"
    return f"""v AS (SELECT q, lab, sum({w}) AS score, min(rank) AS first_rank FROM nn WHERE rank <= {k} GROUP BY q, lab),
best AS (SELECT q, lab FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY {order}) AS r FROM v) WHERE r = 1)"""


@reg("k1_knn", _NN_SQL + ", " + _vote_sql(5, False) + """
SELECT best.q AS vec_id, s.label::VARCHAR AS y_true, best.lab AS prediction FROM best JOIN split s ON s.vec_id = best.q""")
def k1_knn(spark, sf):
    sp = emb_split(spark, sf)
    train, test = sp.where(~F.col("is_test")), sp.where(F.col("is_test"))
    pred, _ = K.knn_predict(train, test, "vec_id", "vec", "label", 5)
    return pred.join(test.select("vec_id", F.col("label").cast("string").alias("y_true")), "vec_id")


@reg("k1_knn_weighted", _NN_SQL + ", " + _vote_sql(5, True) + """
SELECT best.q AS vec_id, best.lab AS prediction FROM best""")
def k1_knn_weighted(spark, sf):
    sp = emb_split(spark, sf)
    pred, _ = K.knn_predict(sp.where(~F.col("is_test")), sp.where(F.col("is_test")), "vec_id", "vec", "label", 5,
                            weights="distance")
    return pred


@reg("k2_proba", _NN_SQL + """
SELECT q AS vec_id, lab AS class, round(count(*) / 5.0::DOUBLE, 6) AS proba FROM nn WHERE rank <= 5 GROUP BY q, lab""")
def k2_proba(spark, sf):
    sp = emb_split(spark, sf)
    _, proba = K.knn_predict(sp.where(~F.col("is_test")), sp.where(F.col("is_test")), "vec_id", "vec", "label", 5)
    return proba.select("vec_id", "class", F.round("proba", 6).alias("proba"))


@reg("k3_neighbours", _NN_SQL + """
SELECT q AS vec_id, b AS neighbour, rank::BIGINT AS rank, round(dist, 6) AS dist, lab AS neighbour_label FROM nn WHERE rank <= 5""")
def k3_neighbours(spark, sf):
    sp = emb_split(spark, sf)
    nn = K.neighbours(sp.where(~F.col("is_test")), sp.where(F.col("is_test")), "vec_id", "vec", "label", 5)
    return nn.select(F.col("q_id").alias("vec_id"), F.col("b_id").alias("neighbour"), F.col("rank").cast("bigint").alias("rank"),
                     F.round("dist", 6).alias("dist"), F.col("b_lab").alias("neighbour_label"))


@reg("k4_sweep", _NN_SQL + """,
ks AS (SELECT unnest(range(1, 11)) AS k),
v AS (SELECT k, q, lab, count(*) AS score, min(rank) AS first_rank FROM nn, ks WHERE rank <= k GROUP BY k, q, lab),
best AS (SELECT k, q, lab FROM (SELECT *, row_number() OVER (PARTITION BY k, q ORDER BY score DESC, first_rank) AS r FROM v) WHERE r = 1)
SELECT k::INTEGER AS k, round(avg(CASE WHEN best.lab = s.label::VARCHAR THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
FROM best JOIN split s ON s.vec_id = best.q GROUP BY k""")
def k4_sweep(spark, sf):
    sp = emb_split(spark, sf)
    sw = K.knn_k_sweep(sp.where(~F.col("is_test")), sp.where(F.col("is_test")), "vec_id", "vec", "label")
    return sw.groupBy(F.col("k").cast("int").alias("k")).agg(
        F.round(F.avg((F.col("prediction") == F.col("y_true")).cast("double")), 6).alias("accuracy"))


@reg("k4_sweep_metrics")
def k4_sweep_metrics(spark, sf):
    """Per-k accuracy / weighted P, R, F1 through the shared comparison metric."""
    sp = emb_split(spark, sf)
    sw = K.knn_k_sweep(sp.where(~F.col("is_test")), sp.where(F.col("is_test")), "vec_id", "vec", "label")
    return E.compare_metrics(sw.withColumn("k", F.col("k").cast("string")), "k")


# ---- cluster quality on embeddings (label as the clustering) -------------------------

@reg("q1_k", "SELECT count(DISTINCT CASE WHEN label <> -1 THEN label END)::BIGINT AS n_clusters FROM embeddings")
def q1_k(spark, sf):
    return Qm.n_clusters(embeddings(spark, sf), "label")


_INERTIA_SQL = f"""WITH x AS (SELECT vec_id, label, unnest(vec) AS v, unnest(range(len(vec))) AS dim FROM {EMB})"""


@reg("q2_inertia", _INERTIA_SQL + """
SELECT round(sum(w), 4) AS inertia FROM (SELECT var_pop(v) * count(*) AS w FROM x WHERE label >= 0 GROUP BY label, dim)""")
def q2_inertia(spark, sf):
    return Qm.inertia(embeddings(spark, sf), "vec", "label").select(F.round("inertia", 4).alias("inertia"))


_SIL_SQL = f"""WITH p AS (SELECT a.vec_id AS id, a.label AS own, b.label AS cl, sum(list_distance(a.vec, b.vec)) AS s,
                 count(*) AS n FROM {EMB} a, {EMB} b WHERE a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
r AS (SELECT id, max(CASE WHEN cl = own THEN s / n END) AS a, min(CASE WHEN cl <> own THEN s / n END) AS b FROM p GROUP BY id),
sv AS (SELECT id, CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS sil FROM r)"""


@reg("q3_sil_exact", _SIL_SQL + " SELECT round(avg(sil), 6) AS silhouette, 'exact' AS mode FROM sv")
def q3_sil_exact(spark, sf):
    s = Qm.silhouette(embeddings(spark, sf), "vec_id", "vec", "label", "exact")
    return s.select(F.round("silhouette", 6).alias("silhouette"), "mode")


@reg("q3_sil_sample", _SIL_SQL + f""" SELECT round(avg(sil), 6) AS silhouette, 'sample' AS mode FROM sv
WHERE id IN (SELECT vec_id FROM embeddings ORDER BY md5(concat(vec_id, '42')), vec_id LIMIT 200)""")
def q3_sil_sample(spark, sf):
    s = Qm.silhouette(embeddings(spark, sf), "vec_id", "vec", "label", "sample", sample_rows=200)
    return s.select(F.round("silhouette", 6).alias("silhouette"), "mode")


@reg("q3_sil_squared", _SIL_SQL.replace("sum(list_distance(a.vec, b.vec))", "sum(pow(list_distance(a.vec, b.vec), 2))")
     + " SELECT round(avg(sil), 4) AS silhouette, 'squared' AS mode FROM sv")
def q3_sil_squared(spark, sf):
    s = Qm.silhouette(embeddings(spark, sf), "vec_id", "vec", "label", "squared")
    return s.select(F.round("silhouette", 4).alias("silhouette"), "mode")


@reg("q4_ch", _INERTIA_SQL + """,
c AS (SELECT label, dim, avg(v) AS m, count(*) AS n FROM x GROUP BY label, dim),
g AS (SELECT dim, avg(v) AS m FROM x GROUP BY dim),
w AS (SELECT sum(w) AS trw FROM (SELECT var_pop(v) * count(*) AS w FROM x GROUP BY label, dim)),
b AS (SELECT sum(c.n * (c.m - g.m) * (c.m - g.m)) AS trb FROM c JOIN g USING (dim)),
k AS (SELECT count(DISTINCT label) AS k, count(*) AS n FROM embeddings)
SELECT round(CASE WHEN trw = 0 THEN 1.0 ELSE (trb / (k - 1)) / (trw / (n - k)) END, 4) AS calinski_harabasz FROM w, b, k""")
def q4_ch(spark, sf):
    return Qm.calinski_harabasz(embeddings(spark, sf), "vec", "label").select(
        F.round("calinski_harabasz", 4).alias("calinski_harabasz"))


@reg("q5_db", _INERTIA_SQL + """,
c AS (SELECT label, list(m ORDER BY dim) AS cen FROM (SELECT label, dim, avg(v) AS m FROM x GROUP BY label, dim) GROUP BY label),
s AS (SELECT e.label, avg(list_distance(e.vec, c.cen)) AS s FROM (SELECT vec_id, embedding::DOUBLE[] AS vec, label FROM embeddings) e
      JOIN c USING (label) GROUP BY e.label),
r AS (SELECT a.label, max((sa.s + sb.s) / list_distance(a.cen, b.cen)) AS r FROM c a JOIN c b ON a.label <> b.label
      JOIN s sa ON sa.label = a.label JOIN s sb ON sb.label = b.label GROUP BY a.label)
SELECT round(avg(r), 4) AS davies_bouldin FROM r""")
def q5_db(spark, sf):
    return Qm.davies_bouldin(embeddings(spark, sf), "vec", "label").select(F.round("davies_bouldin", 4).alias("davies_bouldin"))


@reg("q6_all", f"""SELECT n_clusters, inertia, silhouette, calinski_harabasz, davies_bouldin
FROM ({SQL["q1_k"]}) a, ({SQL["q2_inertia"]}) b, ({SQL["q3_sil_exact"]}) c, ({SQL["q4_ch"]}) d, ({SQL["q5_db"]}) e""")
def q6_all(spark, sf):
    """All four metrics in one row, rounded as in their own queries."""
    m = Qm.cluster_metrics(embeddings(spark, sf), "vec_id", "vec", "label")
    return m.select("n_clusters", F.round("inertia", 4).alias("inertia"), F.round("silhouette", 6).alias("silhouette"),
                    F.round("calinski_harabasz", 4).alias("calinski_harabasz"), F.round("davies_bouldin", 4).alias("davies_bouldin"))


# ---- K-Means / K-Medoids from given centres (FIX: unrolled SQL) --------------------------

def _lloyd_sql(steps: int, k: int) -> str:
    parts = [f"c0 AS (SELECT row_number() OVER (ORDER BY md5(concat(c_custkey, '42')), c_custkey) - 1 AS idx, x AS cx, y AS cy "
             f"FROM {CU2} ORDER BY md5(concat(c_custkey, '42')), c_custkey LIMIT {k})"]
    for i in range(1, steps + 1):
        parts.append(
            f"a{i} AS (SELECT c_custkey, x, y, idx FROM (SELECT p.*, c.idx, row_number() OVER (PARTITION BY p.c_custkey "
            f"ORDER BY sqrt((p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy)), c.idx) AS r "
            f"FROM {CU2} p, c{i - 1} c) WHERE r = 1)")
        parts.append(f"c{i} AS (SELECT idx, avg(x) AS cx, avg(y) AS cy FROM a{i} GROUP BY idx)")
    return "WITH " + ",\n".join(parts)


@reg("c1_lloyd5", _lloyd_sql(5, 4) + "\nSELECT c_custkey, idx::INTEGER AS cluster FROM a5")
def c1_lloyd5(spark, sf):
    cu = customer_2d(spark, sf)
    v = KM.vec_frame(cu, "c_custkey", ["x", "y"])
    init = KM.random_init(v, 4, 42)
    res = KM.kmeans(cu, "c_custkey", ["x", "y"], k=4, init=init, max_iter=5, tol=0.0)
    return res.labels


@reg("c1_centers5", _lloyd_sql(5, 4) + "\nSELECT idx::INTEGER AS cluster, round(cx, 6) AS x, round(cy, 6) AS y FROM c5")
def c1_centers5(spark, sf):
    cu = customer_2d(spark, sf)
    v = KM.vec_frame(cu, "c_custkey", ["x", "y"])
    fits = KM.lloyd(v, {0: KM.random_init(v, 4, 42)}, max_iter=5, tol=0.0)
    rep = fits[0][1]
    rows = [(i, round(float(r[0]), 6), round(float(r[1]), 6)) for i, r in enumerate(rep)]
    return spark.createDataFrame(rows, "cluster int, x double, y double")


@reg("c1_kmeans")
def c1_kmeans(spark, sf):
    """Best of 10 k-means++ restarts on the 64-d embeddings (one job per
    iteration for all restarts)."""
    res = KM.kmeans(embeddings(spark, sf), "vec_id", vec_col="vec", k=10, n_init=10, seed=42)
    return res.labels.withColumn("inertia", F.lit(round(res.inertia, 4)))


@reg("c2_pp_init")
def c2_pp_init(spark, sf):
    v = KM.vec_frame(customer_2d(spark, sf), "c_custkey", ["x", "y"])
    c = KM.kmeanspp_init(v, {0: (5, 42)})[0]
    return spark.createDataFrame([(i, float(r[0]), float(r[1])) for i, r in enumerate(c)], "idx int, x double, y double")


@reg("c3_random", f"""
SELECT row_number() OVER (ORDER BY md5(concat(c_custkey, '42')), c_custkey)::INTEGER - 1 AS idx, round(x, 6) AS x, round(y, 6) AS y
FROM {CU2} ORDER BY md5(concat(c_custkey, '42')), c_custkey LIMIT 5""")
def c3_random(spark, sf):
    v = KM.vec_frame(customer_2d(spark, sf), "c_custkey", ["x", "y"])
    c = KM.random_init(v, 5, 42)
    return spark.createDataFrame([(i, round(float(r[0]), 6), round(float(r[1]), 6)) for i, r in enumerate(c)],
                                 "idx int, x double, y double")


def _medoid_sql(steps: int, k: int) -> str:
    parts = [f"m0 AS (SELECT row_number() OVER (ORDER BY md5(concat(c_custkey, '42')), c_custkey) - 1 AS idx, c_custkey AS mid, "
             f"x AS mx, y AS my FROM {CU2} ORDER BY md5(concat(c_custkey, '42')), c_custkey LIMIT {k})"]
    for i in range(1, steps + 1):
        parts.append(
            f"a{i} AS (SELECT c_custkey, x, y, idx FROM (SELECT p.*, m.idx, row_number() OVER (PARTITION BY p.c_custkey "
            f"ORDER BY sqrt((p.x - m.mx) * (p.x - m.mx) + (p.y - m.my) * (p.y - m.my)), m.idx) AS r "
            f"FROM {CU2} p, m{i - 1} m) WHERE r = 1)")
        parts.append(
            f"s{i} AS (SELECT a.idx, a.c_custkey AS mid, a.x AS mx, a.y AS my, "
            f"sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS cost "
            f"FROM a{i} a JOIN a{i} b ON a.idx = b.idx GROUP BY a.idx, a.c_custkey, a.x, a.y)")
        parts.append(
            f"m{i} AS (SELECT idx, mid, mx, my FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY cost, mid) AS r "
            f"FROM s{i}) WHERE r = 1 UNION ALL SELECT * FROM m{i - 1} WHERE idx NOT IN (SELECT idx FROM a{i}))")
    return "WITH " + ",\n".join(parts)


@reg("c4_medoid3", _medoid_sql(3, 3) + "\nSELECT idx::INTEGER AS cluster, mid AS medoid FROM m3")
def c4_medoid3(spark, sf):
    cu = customer_2d(spark, sf)
    v = KM.vec_frame(cu, "c_custkey", ["x", "y"])
    init_ids = [r["id"] for r in v.withColumn("__o", F.md5(F.concat(F.col("id").cast("string"), F.lit("42")))).orderBy(
        "__o", "id").limit(3).collect()]
    res = KD.kmedoids(cu, "c_custkey", ["x", "y"], k=3, init=init_ids, max_iter=3)
    return spark.createDataFrame([(i, int(m)) for i, m in enumerate(res.medoid_ids)], "cluster int, medoid bigint")


@reg("c4_kmedoids")
def c4_kmedoids(spark, sf):
    res = KD.kmedoids(customer_2d(spark, sf), "c_custkey", ["x", "y"], k=4, seed=42)
    return res.labels.withColumn("inertia", F.lit(round(res.inertia, 4)))


@reg("c5_pp_medoids")
def c5_pp_medoids(spark, sf):
    v = KM.vec_frame(customer_2d(spark, sf), "c_custkey", ["x", "y"])
    c = KM.kmeanspp_init(v, {0: (4, 42)}, metric="manhattan")[0]
    return spark.createDataFrame([(i, float(r[0]), float(r[1])) for i, r in enumerate(c)], "idx int, x double, y double")


# ---- DBSCAN (REC: recursive CTE for the components) ------------------------------------

def _dbscan_sql(eps: float, ms: int, reference: bool, select: str) -> str:
    cond = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {eps}::DOUBLE".format(eps=eps)
    border_extra = ""
    if reference:
        border_extra = (f" AND (n.c_custkey > st.sid OR sqrt((n.x - st.sx) * (n.x - st.sx) + (n.y - st.sy) * (n.y - st.sy)) "
                        f"<= {eps}::DOUBLE)")
    return f"""WITH RECURSIVE p AS {CU2},
nb AS (SELECT a.c_custkey AS id, count(*) AS cnt FROM p a JOIN p b ON {cond} GROUP BY a.c_custkey),
core AS (SELECT p.* FROM p JOIN nb ON nb.id = p.c_custkey WHERE nb.cnt >= {ms}),
e AS (SELECT a.c_custkey AS s, b.c_custkey AS t FROM core a JOIN core b ON {cond}),
reach(src, dst) AS (SELECT c_custkey, c_custkey FROM core UNION SELECT r.src, e.t FROM reach r JOIN e ON e.s = r.dst),
comp AS (SELECT src AS id, min(dst) AS comp FROM reach GROUP BY src),
cl AS (SELECT comp, (dense_rank() OVER (ORDER BY comp) - 1)::INTEGER AS cluster FROM (SELECT DISTINCT comp FROM comp)),
st AS (SELECT cl.cluster, c.c_custkey AS sid, c.x AS sx, c.y AS sy FROM cl JOIN core c ON c.c_custkey = cl.comp),
corelab AS (SELECT comp.id, cl.cluster FROM comp JOIN cl USING (comp)),
nonc AS (SELECT * FROM p WHERE c_custkey NOT IN (SELECT c_custkey FROM core)),
bl AS (SELECT n.c_custkey AS id, min(cl2.cluster) AS cluster FROM nonc n JOIN core c ON
         sqrt((n.x - c.x) * (n.x - c.x) + (n.y - c.y) * (n.y - c.y)) <= {eps}::DOUBLE
       JOIN corelab cl2 ON cl2.id = c.c_custkey JOIN st ON st.cluster = cl2.cluster
       WHERE TRUE{border_extra} GROUP BY n.c_custkey),
labs AS (SELECT id AS c_custkey, cluster, TRUE AS is_core FROM corelab
         UNION ALL SELECT n.c_custkey, coalesce(bl.cluster, -1)::INTEGER, FALSE FROM nonc n LEFT JOIN bl ON bl.id = n.c_custkey)
{select}"""


@reg("c6_dbscan", _dbscan_sql(0.03, 5, False, "SELECT c_custkey, cluster, is_core FROM labs"))
def c6_dbscan(spark, sf):
    return D.dbscan(customer_2d(spark, sf), "c_custkey", ["x", "y"], eps=0.03, min_samples=5)


@reg("c6b_dbscan_compat", _dbscan_sql(0.03, 5, True, "SELECT c_custkey, cluster, is_core FROM labs"))
def c6b_dbscan_compat(spark, sf):
    return D.dbscan(customer_2d(spark, sf), "c_custkey", ["x", "y"], eps=0.03, min_samples=5, border="reference")


@reg("c17_sizes", _dbscan_sql(0.03, 5, False, "SELECT cluster, count(*)::BIGINT AS n FROM labs GROUP BY cluster"))
def c17_sizes(spark, sf):
    lab = D.dbscan(customer_2d(spark, sf), "c_custkey", ["x", "y"], eps=0.03, min_samples=5)
    return lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@reg("c6_dbscan_embed")
def c6_dbscan_embed(spark, sf):
    """High-dimensional path (block join) on the 64-d embeddings."""
    e = embeddings(spark, sf)
    cols = [F.col("vec")[i].alias(f"f{i}") for i in range(64)]
    wide = e.select("vec_id", *cols)
    return D.dbscan(wide, "vec_id", [f"f{i}" for i in range(64)], eps=2.2, min_samples=5)


@reg("c7_kdist", f"""
SELECT c_custkey, round(k_dist, 6) AS k_dist FROM (
  SELECT a.c_custkey, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS k_dist,
         row_number() OVER (PARTITION BY a.c_custkey ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.c_custkey) AS r
  FROM {CU2} a, {CU2} b WHERE a.c_custkey <> b.c_custkey) WHERE r = 4""")
def c7_kdist(spark, sf):
    kd = D.k_distances(customer_2d(spark, sf), "c_custkey", ["x", "y"], 4)
    return kd.select("c_custkey", F.round("k_dist", 6).alias("k_dist"))


@reg("q11_best_eps", f"""
WITH kd AS (SELECT a.c_custkey, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d,
         row_number() OVER (PARTITION BY a.c_custkey ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.c_custkey) AS r
  FROM {CU2} a, {CU2} b WHERE a.c_custkey <> b.c_custkey),
s AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM kd WHERE r = 3)
SELECT round(d, 6) AS eps, (SELECT least(5, greatest(2, count(*) // 2)) FROM {CU2})::INTEGER AS min_samples
FROM s WHERE i = (SELECT CAST(floor(0.9 * count(*)) AS BIGINT) FROM {CU2})""")
def q11_best_eps(spark, sf):
    from ..operators.select import best_dbscan_params

    return best_dbscan_params(customer_2d(spark, sf), "c_custkey", ["x", "y"])


@reg("q14_curve", f"""
SELECT (row_number() OVER (ORDER BY k_dist DESC, c_custkey) - 1)::BIGINT AS idx, round(k_dist, 6) AS k_dist FROM (
  SELECT a.c_custkey, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS k_dist,
         row_number() OVER (PARTITION BY a.c_custkey ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.c_custkey) AS r
  FROM {CU2} a, {CU2} b WHERE a.c_custkey <> b.c_custkey) WHERE r = 4""")
def q14_curve(spark, sf):
    from ..operators.select import kdistance_curve

    return kdistance_curve(customer_2d(spark, sf), "c_custkey", ["x", "y"], 4)


@reg("q7_elbow")
def q7_elbow(spark, sf):
    from ..operators.select import elbow_table

    return elbow_table(customer_2d(spark, sf), "c_custkey", ["x", "y"])


@reg("q8_sil_curve")
def q8_sil_curve(spark, sf):
    from ..operators.select import silhouette_curve

    return silhouette_curve(customer_2d(spark, sf), "c_custkey", ["x", "y"])



@reg("j2_pairs_topn", f"""
SELECT a, b, round(dist, 6) AS dist FROM (
  SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.vec, b.vec) AS dist FROM {EMB} a, {EMB} b WHERE a.vec_id < b.vec_id)
ORDER BY dist, a, b LIMIT 20""")
def j2_pairs_topn(spark, sf):
    v = _vf(embeddings(spark, sf))
    return J.closest_pairs(v, 20).select("a", "b", F.round("dist", 6).alias("dist"))


@reg("c16_dispatch")
def c16_dispatch(spark, sf):
    from ..operators.dispatch import run_clustering

    cu = customer_2d(spark, sf)
    init = KM.random_init(KM.vec_frame(cu, "c_custkey", ["x", "y"]), 3, 42)
    out = run_clustering("KMeans", {"n_clusters": 3, "init": init, "max_iter": 10}, cu, "c_custkey", ["x", "y"])
    return out["metrics"].select("n_clusters", F.round("inertia", 4).alias("inertia"), F.round("silhouette", 4).alias("silhouette"))


@reg("q11_best_k")
def q11_best_k(spark, sf):
    from ..operators.select import best_k, silhouette_curve

    return best_k(silhouette_curve(customer_2d(spark, sf), "c_custkey", ["x", "y"]))
