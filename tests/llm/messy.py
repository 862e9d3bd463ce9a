"""A small documents table with every awkward case, and plain versions of the operators to compare with."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # further columns whose names the operators use inside
        *[T.StructField(c, T.StringType()) for c in ("chunk", "key", "size", "id", "rank", "copies", "y", "c", "start")],
    ]
)
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(seed=3, distinct_ids=False):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghilmnoprstué") for _ in range(rng.randint(1, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    passage = prose(70)
    base = prose(120)
    texts = [None, "", " \t\n ", "One", "one", "Two words", "two  words\n", "<|endoftext|> x", "漢字 かな text", "a" * 700, "ab " * 400, "— … “quoted”  text\r\n"]
    texts += [base, base, base.upper(), base + " tail", "head " + base, base.replace(" ", "\n", 5)]
    texts += [f"{prose(30)} {passage} {prose(20)}" for _ in range(4)]
    texts += [passage[: len(passage) // 2], prose(3000), "word. " * 60, f"{passage}\n{passage}"]
    for _ in range(14):
        w = base.split(" ")
        w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [prose(rng.randint(1, 90)) for _ in range(40)]
    out = []
    for k, t in enumerate(texts):
        source = [None, "s1", "s1", "s1", "é", "Z"][k % 6]
        out.append((k * 3 + 1, t, [None, "en", "fr"][k % 3], source, len(t or ""), *["x"] * 9))
    if not distinct_ids:
        out += [out[20], out[20], (out[21][0], *out[20][1:]), (None, base, "en", "s1", 1, *["x"] * 9), (None, None, None, None, None, *[None] * 9)]
    rng.shuffle(out)
    return out


def words(text):
    return SPACE_WORD.findall(text or "")


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_duplicates(docs, n, percent=80):
    """doc_id, n_shingles, component_id, kept of each (doc_id, text), by comparing all sets."""
    up = {d: d for d, _ in docs if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(d, shingles(t, n)) for d, t in docs if d is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                up[hi] = lo
    return sorted(((d, len(shingles(t, n)), None if d is None else find(d), True if d is None else find(d) == d) for d, t in docs), key=repr)


def phrase_dedup(docs, window=50):
    first = {}
    for d, t in docs:
        if d is not None:
            w = words(t)
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(first.get(g, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if d is not None and first[tuple(w[k : k + window])] < d:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def byte_dedup(docs, window=200):
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[k : k + window] for _, b in raw for k in range(len(b) - window + 1))
    out = []
    for d, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                gone[k : k + window] = [True] * window
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def decontaminate(docs, items, window=10):
    grams = defaultdict(set)
    for item, t in items:
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1)):
            if w and item is not None:
                grams[tuple(w[k : k + window])].add(str(item))
    out = []
    for d, t in docs:
        w, hit, found = ALNUM_WORD.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
