"""Token files, mixing, toxicity, language, exact top-k."""

import zlib
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tabmine.llm import langid, mixing, token_files, topk, toxicity
from tabmine.llm.common import scratch_dir

from . import messy


def direct_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_files.vocabulary_path())
    return [np.array([*e.ids, 2], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_equals_the_library():
    odd = ["", " ", "a  b", " lead", "trail ", "x\n y", "x \ny", "don't we'll 's", "a\xa0b c　 d", "tab\t x", "<|endoftext|> hi<|endoftext|>", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\ny  <|endoftext", "|>", "end. . ,", "a1, b2. 3. é, ß!",
           "x\ny", "a b.\nC d, e\n\nf g\n h", "end.\n", "\nstart here", "q\n, r.\n. s\n1 2\n3", "w.\n\n.x y\nz", "a​ b ​ c", "漢字, 仮名。 a", "x, 've", "..,, a", "word's' it'' ''s", "a'' ''b '. x'll'", "(a) [b]} c$$$ d%,.", "a'\ns it's\n've", "\x1c a \x1f"]
    texts = odd + [t or "" for _, t in [(r[0], r[1]) for r in messy.rows()]]
    enc = token_files.Encoder(token_files.vocabulary_path())
    for _ in range(2):  # the second time from what is remembered
        assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts, 2)] == [x.tolist() for x in direct_ids(texts)]


def test_token_files(spark, docs, pairs):
    uri = scratch_dir(spark, "test-tokens")
    manifest = token_files.write_token_files(docs, uri, token_files.vocabulary_path(), shards=4)
    assert manifest.count() > 1
    out = token_files.read_token_files(manifest, uri).orderBy("start").collect()
    assert len(out) == len(pairs)
    ids = [r["doc_id"] for r in out]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in out] == np.cumsum([0] + [r["n_tokens"] for r in out])[:-1].tolist()
    want = sorted(((d, len(x), zlib.crc32(x.tobytes())) for (d, _), x in zip(pairs, direct_ids([t for _, t in pairs]))), key=repr)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out), key=repr) == want
    # one document alone, a plain zstd reader, and a damaged frame
    shard = manifest.orderBy("shard").first()["shard"]
    reader = token_files.ShardReader(uri, shard)
    d = int(reader.index["doc_id"][-1])
    text = next(t for i, t in pairs if i == d)
    assert token_files.read_documents(uri, shard, {d})[d].tolist() == direct_ids([text])[0].tolist()
    path = f"{uri.removeprefix('file:').replace('//', '/')}/{shard}"
    raw = open(path, "rb").read()
    whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
    assert whole == b"".join(reader.frame(k) for k in range(len(reader.sizes)))
    reader.sums, reader._kept = reader.sums + 1, None
    with pytest.raises(ValueError, match="checksum"):
        reader.frame(0)


def test_token_files_empty(nothing):
    assert token_files.token_output(nothing).count() == 0


def test_mixing(spark, docs):
    rows = mixing.mix(docs).collect()
    want = sorted(((r[0], len(messy.words(r[1]))) for r in messy.rows()), key=repr)
    assert sorted(((r["doc_id"], r["size"]) for r in rows), key=repr) == want
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    sources = {r["source_size"]: r["target"] for r in rows}
    assert all(t <= 3 * s + 1e-9 for s, t in sources.items())
    assert abs(sum(sources.values()) - total) < 1e-6
    for s, t in sources.items():
        mine = [r for r in rows if r["source_size"] == s]
        assert abs(sum(r["taken"] for r in mine) - t) <= max(r["size"] for r in mine)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)


def test_targets_share_the_excess_by_weight(spark):
    s = spark.createDataFrame([("a", 1), ("b", 100), ("c", 1000), ("d", 0), (None, 10)], "source string, source_size long")
    t = {r["source"]: r["target"] for r in mixing.targets(s).collect()}
    # weights a 1, b 2, c 3, d 1, null 2; a, d and null stop at 3, 0 and 30; then b at 300; c gets the rest
    assert t == {"a": 3.0, "d": 0.0, None: 30.0, "b": 300.0, "c": 778.0}
    r = {x["source"]: x["rate"] for x in mixing.balance(mixing.targets(s)).collect()}
    assert r == {"a": 3.0, "d": 0.0, None: 3.0, "b": 3.0, "c": 0.778}


def test_mixed_documents(docs, nothing):
    out = mixing.mixed(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    sizes = sum(len(messy.words(r["text"])) for r in out.collect())
    assert sizes == mixing.mix(docs).agg(F.sum("taken")).first()[0]
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_toxicity_learns_spans(spark):
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdeghilnorst"), rng.integers(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for k in range(600):
        w = list(rng.choice(vocab, 40))
        bad = k % 5 == 0
        if bad:
            w[rng.integers(0, 40)] = "vilest" + "".join(rng.choice(list("abc"), 3))
        docs.append((k, " ".join(w) + ".", "x"))
        labels.append((k, int(bad), "y"))
    docs += [(None, "vilestabc", "x"), (601, None, "x"), (602, "", "x"), (0, docs[0][1], "x")]
    labels += [(None, 1, "y"), (1, None, "y"), (700, 1, "y"), (5, 1, "y")]
    d = spark.createDataFrame(docs, "doc_id long, text string, y string")
    out = toxicity.toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int, text string")).collect()
    assert len(out) == len(docs)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    text = dict((i, t) for i, t, _ in docs)
    for r in held:
        if r["doc_id"] % 5 == 0 and r["predicted"]:
            assert any(text[r["doc_id"]].encode()[s["start"] : s["end"]].startswith(b"vilest") for s in r["spans"])


def test_toxicity_without_labels(spark, docs, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(messy.rows()) and len({r["score"] for r in out}) == 1
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    score, trans = rng.normal(size=7), rng.normal(size=(2, 2))
    chains = np.array([0, 3, 4])
    p, logz, counts = toxicity.forward_backward(score, chains, trans, True)
    want_p, want_z, want_c = np.zeros(7), 0.0, np.zeros((2, 2))
    for a, z in ((0, 3), (3, 4), (4, 7)):
        paths = list(itertools.product((0, 1), repeat=z - a))
        w = np.array([np.exp(sum(score[a + i] * y for i, y in enumerate(path)) + sum(trans[x, y] for x, y in zip(path, path[1:]))) for path in paths])
        want_z += np.log(w.sum())
        for path, v in zip(paths, w / w.sum()):
            want_p[a:z] += v * np.array(path)
            for x, y in zip(path, path[1:]):
                want_c[x, y] += v
    assert np.allclose(p, want_p) and np.isclose(logz, want_z) and np.allclose(counts, want_c)


def test_language(spark, nothing):
    rng = np.random.default_rng(2)
    letters = {"en": "etaoinshrd", "xx": "qwzxkjvbyp", "çç": "çéàüöñãîôû"}
    docs = [(k, " ".join("".join(rng.choice(list(letters[g]), rng.integers(2, 7))) for _ in range(30)), g) for k, g in enumerate(list(letters) * 40)]
    odd = [(500, None, "en"), (501, "", "en"), (502, "123 ... !", None), (None, docs[0][1], "en"), (503, "漢字", None), (503, "漢字", None)]
    df = spark.createDataFrame([(*r, "z") for r in docs + odd], "doc_id long, text string, lang string, key string")
    out = langid.language(df).collect()
    assert len(out) == len(docs) + len(odd)
    by = {r["doc_id"]: r for r in out}
    assert all(by[k]["lang_pred"] == g for k, _, g in docs)
    assert [by[k]["lang_pred"] for k in (500, 501, 502)] == ["und"] * 3 and by[503]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in out)
    assert langid.language(nothing).count() == 0


def test_language_vectors_are_bundles():
    blank, a, b = langid.letter_vectors(np.array([0, ord("a"), ord("b")])).astype(int)
    want = np.roll(blank, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * blank
    assert np.array_equal(langid.text_vectors(["AB", "x", "-"])[0], want)
    assert not langid.text_vectors(["", "1 2"]).any()


def test_every_letter_has_its_own_vector(monkeypatch):
    letters = np.unique(langid.letter_codes())
    assert len(letters) > 130_000
    packed = np.concatenate([np.packbits(langid.letter_vectors(x) > 0, axis=1) for x in np.array_split(letters, 40)])
    assert len(np.unique(packed[:, :16], axis=0)) == len(letters)
    for one, other in zip("аеийçśă漢か", "яєїјńźä字き"):
        x, y = langid.text_vectors([one, other]).astype(int)
        assert (x == y).mean() < 0.6
    assert np.array_equal(*langid.text_vectors(["ЖÉ", "жé"]))
    texts = ["漢字かな交じり文 " * 9, "", "words and more", "жук"]
    whole = langid.text_vectors(texts)
    monkeypatch.setattr(langid, "_GRAMS", 3)
    assert np.array_equal(langid.text_vectors(texts), whole)


def test_languages_that_share_most_letters(spark):
    rng = np.random.default_rng(9)
    base = "бвгдзклмнопрст"
    letters = {"one": base + "аеи", "two": base + "яєї", "three": base + "ёэы"}
    words = {g: ["".join(rng.choice(list(x), 5)) for _ in range(80)] for g, x in letters.items()}
    docs = [(k, " ".join(rng.choice(words[g], 40)), g) for k, g in enumerate(list(letters) * 40)]
    out = langid.language(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    truth = {k: g for k, _, g in docs}
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "PIVOT_SAMPLE", 50)
    monkeypatch.setattr(topk, "CHUNK", 16)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 5)).round(2)
    x[50:90] = x[0]  # many ties
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(400, None, 1), (500, [1.0, None, 0.0, 0.0, 0.0], 1), (600, [float("nan"), 0.0, 0.0, 0.0, 0.0], 1), (700, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1), (None, [1.0] * 5, 1), rows[3], rows[100], (1000, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim int")
    v = np.floor(1024 * x).astype(np.int64)
    want = []
    for q in range(0, 400, 100):
        s = v @ v[q]
        order = [i for i in np.lexsort([np.arange(400), -s]) if i != q][:10]
        want += [(q, r, int(i), int(s[i])) for r, i in enumerate(order, 1)]
    assert messy.got(topk.top_k(df), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [3e5, 1e10, 1e300])
def test_top_k_of_large_components(spark, monkeypatch, size):
    """Scores are exact at any size; beyond a long the score is null, the order still that of the exact scores."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(120, 6)) * size).tolist()
    x[7], x[11] = x[5], [v + 1 for v in x[5]]
    rows = [(k * 50, v, 1, 2, 3) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, pd int, start int")
    whole = [[int(Fraction(c) * 1024 // 1) for c in v] for v in x]
    want = []
    for q in range(0, 120, 2):
        s = [sum(a * b for a, b in zip(whole[q], v)) for v in whole]
        order = sorted((i for i in range(120) if i != q), key=lambda i: (-s[i], i))[:10]
        want += [(q * 50, r, i * 50, s[i] if -(2**63) <= s[i] < 2**63 else None) for r, i in enumerate(order, 1)]
    assert messy.got(topk.top_k(df), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)


def test_bounds_leave_rows_out():
    """On clustered vectors the pivots stop the evaluation early, with the same result."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 8)) * 4000
    x = np.floor(centres[rng.integers(0, 20, 5000)] + rng.normal(size=(5000, 8)) * 50)
    p = topk.pick_pivots(x[:500], 32)
    ids = np.arange(5000)
    d = topk._pivot_distances(x, p)
    (best,), looked = topk._evaluate(x[:1], ids[:1], d[:1], x, ids, d, 10, np.full(1, -np.inf))
    s = x @ x[0]
    order = [i for i in np.lexsort([ids, -s]) if i != 0][:10]
    assert best[1].tolist() == order and best[0].tolist() == s[order].tolist() and looked < 2500
