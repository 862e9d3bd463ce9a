"""Near duplicates, repeated passages and strings, decontamination, LM scores: against plain versions on awkward rows."""

import math
import random

import numpy as np
import pytest

from tabmine.llm import bwt, decontaminate, near_dup, ngram_lm, phrases, substrings

from . import messy

NEAR = ("doc_id", "n_shingles", "component_id", "kept")
PHRASE = ("doc_id", "n_words", "n_removed", "kept_sha256")
BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(docs, pairs, n):
    want = messy.near_duplicates(pairs, n)
    assert len({w[2] for w in want}) < len(want)
    assert messy.got(near_dup.near_duplicates(docs, words=n), *NEAR) == want


def test_collision_count_reads_every_lane(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 128, (200, near_dup.COORDS), dtype=np.uint64)
    b = np.where(rng.random(a.shape) < 0.5, a, rng.integers(0, 128, a.shape, dtype=np.uint64))
    rows = [tuple(map(int, np.concatenate([x, y]))) for x, y in zip(near_dup._packed(a), near_dup._packed(b))]
    df = spark.createDataFrame(rows, ", ".join([f"{p} long" for p in near_dup._PACKS] + [f"m_{p} long" for p in near_dup._PACKS]))
    counted = [r[0] for r in df.select(near_dup._collisions("", "m_")).collect()]
    assert sorted(counted) == sorted((a == b).sum(1).tolist())


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(8)
    agree = []
    for _ in range(60):
        common, x, y = rng.integers(0, 1 << 63, 80, dtype=np.uint64), rng.integers(0, 1 << 63, 10, dtype=np.uint64), rng.integers(0, 1 << 63, 10, dtype=np.uint64)
        s = near_dup.signatures(np.concatenate([common, x, common, y]), np.array([0, 90, 180]))
        agree.append((s[0] == s[1]).sum())
    assert abs(np.mean(agree) - 0.8 * near_dup.COORDS) < 2 and min(agree) >= near_dup.MATCHES


def test_phrases(docs, pairs):
    want = messy.phrase_dedup(pairs)
    assert sum(w[2] for w in want) > 100
    assert messy.got(phrases.remove_repeats(docs), *PHRASE) == want


def test_byte_strings(docs, pairs):
    want = messy.byte_dedup(pairs)
    assert sum(w[2] for w in want) > 1000
    assert messy.got(substrings.remove_repeats(docs), *BYTES) == want


@pytest.mark.parametrize("shard", [40, 1 << 15])
def test_merged_transforms(monkeypatch, shard):
    monkeypatch.setattr(bwt, "SHARD_SYMBOLS", shard)
    rng = random.Random(shard)
    for alphabet in (b"a", b"ab", b"abcdefgh", bytes(range(256))):
        for window in (12, 50, 200):
            base = bytes(rng.choice(alphabet) for _ in range(900))
            strings = []
            for _ in range(rng.randint(1, 10)):
                at = rng.randint(0, 600)
                s = bytearray(base[at : at + rng.randint(0, 500)])
                if s:
                    s[rng.randrange(len(s))] = rng.choice(alphabet)
                strings.append(bytes(s))
            seen = messy.Counter(s[i : i + window] for s in strings for i in range(len(s) - window + 1))
            want = [[i for i in range(len(s) - window + 1) if seen[s[i : i + window]] > 1] for s in strings]
            assert [x.tolist() for x in bwt.repeated_windows(strings, window)] == want


def items(pairs):
    long_text = next(t for _, t in pairs if t and len(t) > 3000)
    w = long_text.split(" ")
    return [(1, " ".join(w[10:40])), (2, " ".join(w[30:39])), (3, None), (4, "..."), (5, " ".join(w[10:40]).upper()), (6, "one"), (None, " ".join(w[100:120])), (1, " ".join(w[200:212]))]


@pytest.mark.parametrize("bound", [50_000, 20])
def test_decontamination(spark, docs, pairs, monkeypatch, bound):
    """With the small bound the items need several automata, one pass each."""
    monkeypatch.setattr(decontaminate.automata, "__defaults__", (bound,))
    bench = spark.createDataFrame(items(pairs), "item_id long, text string")
    want = messy.decontaminate(pairs, items(pairs))
    assert any(w[5] for w in want) and messy.got(decontaminate.hits(docs, bench), *HITS) == want


def test_removed_passages_are_gone(spark, docs, pairs):
    bench = spark.createDataFrame([x for x in items(pairs) if x[0] != 6], "item_id long, text string")
    kept = decontaminate.remove_hits(docs, bench)
    assert kept.schema == docs.schema
    assert kept.count() == docs.count()  # nowhere is most of a document hit
    assert not kept.join(decontaminate.hits(kept, bench).where("contaminated"), "doc_id").count()
    before = {(r[0], r[1]) for r in docs.select("doc_id", "text").collect()}
    changed = [r for r in kept.select("doc_id", "text", "n_chars").collect() if (r[0], r[1]) not in before]
    assert changed and all(r[2] == len(r[1]) for r in changed)


def test_mostly_hit_documents_go(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "z " * 40 + "a b c d e f g h i j")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "A b c d e f g h i j")], "item_id long, text string")
    assert [r[0] for r in decontaminate.remove_hits(d, b).collect()] == [2]


def test_lm_scores(docs, pairs):
    texts = [messy.words(t) for _, t in pairs]
    grams = [messy.Counter(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)) for w in texts]
    total, n_all = sum(grams, messy.Counter()), sum(map(len, texts))
    want = []
    for (d, _), w, own in zip(pairs, texts, grams):
        c = lambda *g, own=own: total[g] - own[g]
        s = 0.0
        for i, x in enumerate(w):
            v = (c(x) or 0.4) / max(n_all - len(w), 1)
            for n in (2, 3):
                if i >= n - 1:
                    g = tuple(w[i - n + 1 : i + 1])
                    v = c(*g) / c(*g[:-1]) if c(*g) else 0.4 * v
            s += math.log(v)
        want.append((d, len(w), round(s, 5)))
    got = ngram_lm.lm_scores(docs).collect()
    assert sorted(((r[0], r[1], round(r[2], 5)) for r in got), key=repr) == sorted(want, key=repr)
    assert all((r[3] is None) == (r[1] == 0) for r in got)


def test_empty_tables(spark, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (near_dup.near_duplicates(nothing), phrases.remove_repeats(nothing), substrings.remove_repeats(nothing), ngram_lm.lm_scores(nothing), decontaminate.hits(nothing, bench), decontaminate.remove_hits(nothing, bench)):
        assert df.count() == 0


def test_no_benchmark_items(spark, docs, pairs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert messy.got(decontaminate.hits(docs, bench), *HITS) == messy.decontaminate(pairs, [])
