"""Filter audit, Grace deduplication and dual-tree codes against plain versions."""

import hashlib
import itertools
import random
import re
from collections import defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from tabmine.llm import dual_tree, filter_audit, grace

from . import messy

AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_audit(rows, labels):
    good, toxic = ({d for d, *m in labels if m[i] == 1 and d is not None} for i in (0, 1))
    least, fails = {}, []
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    for d, t, _, source, *_ in rows:
        t, w = t or "", messy.words(t)
        bad = {f for f, c in {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and least[t] < d}.items() if c}
        fails.append((source or "", bad, d in good, d in toxic))
    out, shapley = [], defaultdict(int)
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [x for x in own if f in x[1] and not x[1] & before]
                shapley[part, f] += len(gone)
                out.append([part, "".join(order), k + 1, sum(not x[1] & (before | {f}) for x in own), len(gone),
                            sum(f in x[1] and bool(x[1] & before) for x in own), sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def label_rows():
    return [(r[0], k % 2, k % 3 == 0) for k, r in enumerate(messy.rows()) if k % 4] + [(1, 1, 1), (1, 0, 0), (None, 1, 1), (999999, 1, 1)]


def test_audit_matches_plain_version(spark, docs):
    labels = [(d, int(q), int(t)) for d, q, t in label_rows()]
    extra = spark.createDataFrame([(*x, "x", 1) for x in labels], "doc_id long, quality int, toxic int, bits string, n int")
    odd = [(5000 + k, t, "en", "s1", 1, *["x"] * 9) for k, t in enumerate(["a|b " * 60, "SHOUT " * 55, "#", "SHOUT " * 55])]
    rows = messy.rows() + odd
    both = docs.unionByName(spark.createDataFrame(odd, messy.SCHEMA)).withColumn("h", docs["n_chars"]).withColumn("part", docs["lang"])
    assert messy.got(filter_audit.audit(both, extra), *AUDIT) == sorted(plain_audit(rows, labels), key=repr)


def test_audit_without_rows(spark, docs, nothing):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(nothing, no_labels).columns == AUDIT and filter_audit.audit(nothing, no_labels).count() == 0
    assert messy.got(filter_audit.audit(docs, no_labels), *AUDIT) == sorted(plain_audit(messy.rows(), []), key=repr)


def plain_groups(rows):
    same = defaultdict(list)
    for d, t in rows:
        same[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(d)
    out = []
    for t, ids in same.items():
        ids.sort(key=lambda d: (d is None, d))
        out += [(d, ids[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, d in enumerate(ids)]
    return sorted(out, key=repr)


GROUPS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_grace_matches_plain_version(docs, pairs):
    renamed = docs.withColumn("rid", docs["lang"]).withColumn("lead", docs["lang"]).withColumn("n", docs["lang"])
    assert messy.got(grace.exact_duplicates(renamed), *GROUPS) == plain_groups(pairs)


@pytest.mark.parametrize("parts", [1, 7])
def test_grace_deals_large_buckets_again(spark, monkeypatch, parts):
    monkeypatch.setattr(grace, "BUCKET_BYTES", 400)
    rng, long = random.Random(1), "word " * 5000
    rows = [(k, rng.choice([long, long + "x", " a  b", " a b", f"text {k % 40}"])) for k in range(400)]
    levels = []
    stored = grace.stored
    monkeypatch.setattr(grace, "stored", lambda df, name: levels.append(name) or stored(df, name))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert messy.got(grace.exact_duplicates(df), *GROUPS) == plain_groups(rows)
    assert ("records_1" in levels) == (parts > 1)  # one part merges its copies in its chunk


def test_grace_one_text_and_no_rows(spark, nothing):
    df = spark.createDataFrame([(k % 50, "same") for k in range(3000)], "doc_id long, text string").repartition(5)
    got = grace.exact_duplicates(df).collect()
    assert len(got) == 3000 and sum(r["kept"] for r in got) == 1 and {(r["keep_id"], r["group_size"]) for r in got} == {(0, 3000)}
    assert grace.exact_duplicates(nothing).count() == 0


def test_open_addressing_compares_contents():
    import pyarrow as pa

    texts = [b"a", b"b", b"a", b"", b"b", b"a", b""]
    owner = grace.leaders(np.zeros(7, np.int64), pa.array(texts, pa.large_binary()))  # every hash collides
    assert owner.tolist() == [texts.index(t) for t in texts]


def plain_codes(rows, parts=8, entries=16, rounds=6):
    ok = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ok:
        return []
    n = len(ok[0][1])
    ok = [(i, [floor(Fraction(x) * 4096) for x in v], label) for i, v, label, *_ in ok if len(v) == n]
    cuts = [n * i // parts for i in range(parts + 1)]
    cut = [[v[a:b] for a, b in zip(cuts, cuts[1:])] for _, v, _ in ok]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[nearest(p, c[p])[1]].append(c[p])
            new.append([[sum(x) // len(x) for x in zip(*own[e])] if own[e] else c for e, c in enumerate(books[p])])
        books = new
    done = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    error, total = [sum(s for s, _ in d) for d in done], defaultdict(int)
    for (_, _, label), e in zip(ok, error):
        total[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in d), s, total[label], digest) for (i, _, label), d, s in zip(ok, done, error)), key=repr)


CODES = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
VECTORS = "vec_id long, embedding array<double>, label int, x string, error string"


def vector_rows(n, length, spread=1.0, seed=0):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(6, length))
    return [(k * 2, [float(x) for x in at[k % 6] + spread * rng.normal(size=length)], [None, 1, 2][k % 3], "x", "y") for k in range(n)]


@pytest.mark.parametrize("n, length, spread", [(300, 16, 1.0), (200, 8, 0.01), (5, 16, 1.0), (60, 11, 0.5)])
def test_codes_match_plain_version(spark, n, length, spread):
    rows = vector_rows(n, length, spread)
    bad = [(1, None, 1, "x", "y"), (3, [float("nan")] * length, 1, "x", "y"), (5, [None] * length, 1, "x", "y"), (7, [float("inf")] * length, 1, "x", "y"), (10**6, [1.0] * (length + 1), 1, "x", "y")]
    again = [rows[0], (rows[1][0], *rows[2][1:]), (None, *rows[3][1:])]
    df = spark.createDataFrame(rows + bad + again, VECTORS).repartition(3)
    assert messy.got(dual_tree.vector_codes(df), *CODES) == plain_codes(rows + bad + again)


def test_codes_of_large_components(spark):
    rows = vector_rows(80, 8, 0.3)
    rows += [(k + 1000, [x * 10.0**9 for x in v], *rest) for k, v, *rest in rows[:40]]
    assert messy.got(dual_tree.vector_codes(spark.createDataFrame(rows, VECTORS)), *CODES) == [
        tuple(None if isinstance(x, int) and x >= 2**63 else x for x in r) for r in plain_codes(rows)]
    assert dual_tree.whole(np.array([[-1.5e300, 2.0**60, -0.0001]])).tolist() == [[int(-1.5e300) * 4096, 2**72, -1]]


def test_codes_without_rows(spark):
    assert dual_tree.vector_codes(spark.createDataFrame([], VECTORS)).columns == CODES
    assert dual_tree.vector_codes(spark.createDataFrame([(1, None, 1, "x", "y")], VECTORS)).count() == 0
    assert messy.got(dual_tree.vector_codes(spark.createDataFrame([(1, [], 1, "x", "y")], VECTORS)), *CODES) == plain_codes([(1, [], 1)])


@pytest.mark.parametrize("seed", range(6))
def test_dual_tree_assigns_as_brute_force(seed):
    rng = np.random.default_rng(seed)
    n, d, k = int(rng.integers(1, 700)), int(rng.integers(1, 5)), int(rng.integers(1, 17))
    at = rng.integers(-40, 40, (5, d))
    rows = at[rng.integers(0, 5, n)] * 10 + rng.integers(-3, 4, (n, d))
    entries = rows[rng.integers(0, n, k)]  # with equal entries: ties go to the lower index
    part = dual_tree.keep(rows)
    dist = ((rows[:, None] - entries[None]) ** 2).sum(2)
    won = dist.argmin(1)
    counts, sums, whole_nodes, compared = dual_tree.assign(part, entries)
    assert counts.tolist() == np.bincount(won, minlength=k).tolist()
    assert all(sums[e].tolist() == rows[won == e].sum(0).tolist() for e in range(k))
    codes, errors = dual_tree.assign(part, entries, label=True)
    assert codes.tolist() == won.tolist() and errors.tolist() == dist.min(1).tolist()
    assert n < 100 or whole_nodes > 0 and compared < n  # nodes far from a border are assigned by their sums
