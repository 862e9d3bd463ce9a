"""Registered queries of the subpackage, one per operator, with DuckDB twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import decontaminate, dual_tree, filter_audit, grace, langid, mixing, near_dup, ngram_lm, phrases, substrings, token_files, topk, toxicity
from .common import SPACE_WORD, table


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.token_output(table(spark, sf, "documents"))


def op2_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf, "documents"), words=2)


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op4_phrase_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.remove_repeats(table(spark, sf, "documents"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_pivot_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"))


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    return langid.language(table(spark, sf, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf, "documents"))


def op10_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    r = ngram_lm.lm_scores(table(spark, sf, "documents"))
    return r.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op12_grace_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return grace.exact_duplicates(table(spark, sf, "documents"))


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return dual_tree.vector_codes(table(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_near_duplicates,
        op3_mixing,
        op4_phrase_dedup,
        op5_toxicity,
        op6_decontamination,
        op7_pivot_top_k,
        op8_language,
        op9_suffix_dedup,
        op10_lm_scoring,
        op11_filter_audit,
        op12_grace_dedup,
        op13_vector_codes,
    )
}

_OFFSETS = ", ".join(f"({k})" for k in range(mixing.OFFSETS))

OP3_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACE_WORD}')), 0)::BIGINT AS size, row_number() OVER () AS rid FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST) AS k FROM s),
l AS (
  SELECT *, (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER b, 0) AS rest, (SELECT sum(w) FROM s) - coalesce(sum(w) OVER b, 0) AS w_rest
  FROM o WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- the first source in order of cap / weight that stays under its cap sets the level of all after it
lv AS (SELECT rest, w_rest FROM l WHERE cap * w_rest > w * rest ORDER BY k LIMIT 1),
t AS (
  SELECT o.source, o.source_size::BIGINT AS source_size,
    CASE WHEN lv.rest IS NULL OR o.cap * lv.w_rest <= o.w * lv.rest THEN o.cap::DOUBLE ELSE (o.w * lv.rest)::DOUBLE / lv.w_rest::DOUBLE END AS target
  FROM o LEFT JOIN lv ON true),
r AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN round(t.target / t.source_size, 12) ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST, rid) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (
  SELECT r.*, o.o, least(3, floor(k * rate + (o.o + 0.5::DOUBLE) / {mixing.OFFSETS}::DOUBLE) - floor((k - 1) * rate + (o.o + 0.5::DOUBLE) / {mixing.OFFSETS}::DOUBLE))::BIGINT AS copies
  FROM r CROSS JOIN (VALUES {_OFFSETS}) o(o)),
g AS (SELECT source, o, target - sum(size * copies)::BIGINT::DOUBLE AS lack FROM u GROUP BY source, o, target),
b AS (SELECT source, o, lack FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(lack), o) AS n FROM g) WHERE n = 1),
c AS (
  SELECT u.*, b.lack, size > 0 AND CASE WHEN b.lack > 0 THEN copies < 3 ELSE copies > 0 END AS can
  FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source AND u.o = b.o),
f AS (SELECT *, sum(CASE WHEN can THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY k) AS used FROM c)
SELECT doc_id, size, source_size, target, size * (copies + CASE WHEN can AND used <= abs(lack) THEN sign(lack)::BIGINT ELSE 0 END) AS taken FROM f
"""

_WORDS6 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6_SQL = f"""
WITH it AS (SELECT item_id::VARCHAR AS item_id, {_WORDS6} AS ws FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, array_to_string(ws[p : p + 9], ' ') AS g, least(len(ws), 10) AS n
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM it WHERE len(ws) > 0)),
dw AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS6} AS ws FROM documents),
lens AS (SELECT DISTINCT n FROM win),
g AS (
  SELECT rid, p, n, array_to_string(ws[p : p + n - 1], ' ') AS g
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM dw CROSS JOIN lens WHERE len(ws) >= n)),
m AS (SELECT g.rid, g.p, g.n, win.item_id FROM g JOIN win ON g.g = win.g AND g.n = win.n),
h AS (SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS w FROM (SELECT DISTINCT rid, p, n FROM m)) GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256 FROM (SELECT DISTINCT rid, item_id FROM m) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h USING (rid) LEFT JOIN i USING (rid)
"""

OP7_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP10_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS ws FROM documents),
p AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS p FROM d),
g AS (
  SELECT rid, p, n, array_to_string(ws[p : p + n - 1], ' ') AS g FROM p CROSS JOIN (VALUES (1), (2), (3)) o(n) WHERE p + n - 1 <= len(ws)),
c AS (SELECT n, g, count(*) AS c FROM g GROUP BY n, g),
own AS (SELECT rid, n, g, count(*) AS o FROM g GROUP BY rid, n, g),
k AS (SELECT g.rid, g.p, g.n, (c.c - own.o)::DOUBLE AS k FROM g JOIN c ON g.n = c.n AND g.g = c.g JOIN own ON g.rid = own.rid AND g.n = own.n AND g.g = own.g),
r AS (SELECT rid, greatest((SELECT sum(len(ws)) FROM d) - len(ws), 1)::DOUBLE AS rest FROM d),
v1 AS (SELECT k.rid, k.p, CASE WHEN k.k > 0 THEN k.k ELSE {ngram_lm.ALPHA}::DOUBLE END / r.rest AS v FROM k JOIN r USING (rid) WHERE k.n = 1),
v2 AS (
  SELECT v1.rid, v1.p, CASE WHEN b.k IS NULL THEN v1.v WHEN b.k > 0 THEN b.k / a.k ELSE {ngram_lm.ALPHA}::DOUBLE * v1.v END AS v
  FROM v1 LEFT JOIN k b ON b.n = 2 AND b.rid = v1.rid AND b.p = v1.p - 1 LEFT JOIN k a ON a.n = 1 AND a.rid = v1.rid AND a.p = v1.p - 1),
v3 AS (
  SELECT v2.rid, v2.p, CASE WHEN b.k IS NULL THEN v2.v WHEN b.k > 0 THEN b.k / a.k ELSE {ngram_lm.ALPHA}::DOUBLE * v2.v END AS v
  FROM v2 LEFT JOIN k b ON b.n = 3 AND b.rid = v2.rid AND b.p = v2.p - 2 LEFT JOIN k a ON a.n = 2 AND a.rid = v2.rid AND a.p = v2.p - 2),
s AS (SELECT rid, sum(ln(v)) AS s FROM v3 GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(coalesce(s, 0), 6) AS log_score, CASE WHEN len(ws) > 0 THEN round(s / len(ws), 6) END AS mean_log_score
FROM d LEFT JOIN s USING (rid)
"""

OP2_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE_WORD}') AS ws FROM documents),
sh AS (
  SELECT DISTINCT rid, array_to_string(ws[p : p + 1], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS p FROM d WHERE len(ws) > 0)),
sz AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
df AS (SELECT g, count(*) AS c FROM sh GROUP BY g),
-- sets that are linked share one of their rarest shingles
pre AS (
  SELECT rid, g, n FROM (
    SELECT sh.rid, sh.g, sz.n, row_number() OVER (PARTITION BY sh.rid ORDER BY df.c, sh.g) AS k FROM sh JOIN sz ON sh.rid = sz.rid JOIN df ON sh.g = df.g)
  WHERE k <= n - (4 * n + 4) // 5 + 1),
cand AS (SELECT DISTINCT a.rid AS a, b.rid AS b FROM pre a JOIN pre b ON a.g = b.g AND a.rid < b.rid AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
common AS (SELECT c.a, c.b, count(*) AS i FROM cand c JOIN sh x ON x.rid = c.a JOIN sh y ON y.rid = c.b AND y.g = x.g GROUP BY c.a, c.b),
l AS (SELECT a, b FROM common JOIN sz p ON p.rid = a JOIN sz q ON q.rid = b WHERE 100 * i >= 80 * (p.n + q.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l UNION ALL SELECT x.rid, y.rid FROM d x JOIN d y ON x.doc_id = y.doc_id AND x.rid <> y.rid),
reach(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
comp AS (SELECT r.a AS rid, min(d.doc_id) AS component_id FROM reach r JOIN d ON d.rid = r.b GROUP BY r.a)
SELECT d.doc_id, coalesce(sz.n, 0)::BIGINT AS n_shingles, comp.component_id, coalesce(d.doc_id = comp.component_id, true) AS kept
FROM d LEFT JOIN sz ON sz.rid = d.rid LEFT JOIN comp ON comp.rid = d.rid
"""

OP4_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS ws FROM documents),
w AS (
  SELECT rid, doc_id, p, md5(array_to_string(ws[p : p + 49], ' ')) AS g
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)),
f AS (SELECT g, min(doc_id) AS m FROM w GROUP BY g),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + 50)) AS i FROM (SELECT w.rid, w.p FROM w JOIN f ON w.g = f.g AND f.m < w.doc_id)),
x AS (SELECT rid, ws[i] AS w, i FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
k AS (
  SELECT x.rid, string_agg(x.w, ' ' ORDER BY x.i) AS kept, count(*) AS n FROM x LEFT JOIN gone ON gone.rid = x.rid AND gone.i = x.i
  WHERE gone.i IS NULL GROUP BY x.rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.rid = d.rid
"""

OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{SPACE_WORD}') AS ws, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * e::INT AS bits
  FROM w LEFT JOIN l USING (doc_id)),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(f, b)),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [0, a.b, a.b + b.b, a.b + b.b + c.b, a.b + b.b + c.b + d.b] AS before, [a.b, b.b, c.b, d.b, e.b] AS own
  FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
s AS (SELECT filter_order, step, before[step] AS before, own[step] AS own FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, bits),
r AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN bits & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN bits & before = 0 AND bits & own > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN bits & before > 0 AND bits & own > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN bits & before = 0 AND bits & own > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN bits & before = 0 AND bits & own > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c CROSS JOIN s GROUP BY part, filter_order, step, own),
v AS (SELECT part, own, sum(removed)::BIGINT AS shapley FROM r GROUP BY part, own)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley FROM r JOIN v USING (part, own)
"""

OP12_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, rid) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


def _op13_sql() -> str:
    """The rounds written out, one pair of tables a round."""
    k, parts = dual_tree.ENTRIES, dual_tree.PARTS
    ctes = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, list_transform(embedding, lambda x: floor({dual_tree.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""p AS MATERIALIZED (
  SELECT rid, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v
  FROM (SELECT rid, v, unnest(range({parts})) AS p FROM v WHERE len(v) = (SELECT len(v) FROM v WHERE rid = 1)))""",
        f"c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v AS c FROM p WHERE rid <= {k})",
    ]
    for r in range(dual_tree.ROUNDS + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, p, any_value(v) AS v, min((s, e)) AS best FROM (
    SELECT p.rid, p.p, p.v, c.e, coalesce(list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.c[i]) * (p.v[i] - c.c[i]))), 0)::BIGINT AS s
    FROM p JOIN c{r} c ON c.p = p.p) GROUP BY rid, p)""")
        if r < dual_tree.ROUNDS:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT p, e, list(floor(s::DOUBLE / n)::BIGINT ORDER BY i) AS c FROM (
      SELECT p, best[2] AS e, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM (SELECT p, best, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY p, e, i)
    GROUP BY p, e) m ON m.p = c.p AND m.e = c.e)""")
    last = f"a{dual_tree.ROUNDS}"
    ctes.append(f"x AS (SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM {last} GROUP BY rid)")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{dual_tree.ROUNDS})")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM x JOIN v USING (rid) CROSS JOIN h
"""


OP13_SQL = _op13_sql()

SQL = {
    "op2_near_duplicates": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op4_phrase_dedup": OP4_SQL,
    "op6_decontamination": OP6_SQL,
    "op7_pivot_top_k": OP7_SQL,
    "op10_lm_scoring": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_grace_dedup": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
