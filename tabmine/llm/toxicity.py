"""Toxicity with a linear-chain conditional random field over tokens.

A token is a lower-cased run of letters and digits; a chain is a sentence (cut at . ! ? and line ends). Each token is
clean or toxic. Its features are its word, its prefixes of 3 to 8 bytes and its suffixes of 3 and 4, hashed into a fixed
table of weights; the chain has four transition weights. Tokens get their training labels from the documents' labels: in a
toxic document, the tokens with a feature that belongs to toxic documents (by document frequencies over the fit rows), at
least its most suspicious token; in a clean one, none. L-BFGS fits the field; every evaluation is one Spark job of
forward-backward passes whose partial gradients are added up by feature. A document's score joins its tokens' toxic
marginals (the highest one, calibrated on the fit rows); tokens with a marginal of 1/2 or more are its toxic spans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, byte_sums, range_hash, slices, spans, stored, tidy

BITS = 18
N = 1 << BITS
PREFIXES, SUFFIXES = (3, 4, 5, 6, 7, 8), (3, 4)
#: Labelled rows that the field is fitted on (by hash of doc_id); the bound of what the fit reads.
FIT_ROWS = 6000
THRESHOLD = 0.3
L2 = 0.05
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n\r")] = True


def tokens(raw: np.ndarray, off: np.ndarray):
    """(byte starts, byte ends, first token of every text, first token of every chain, feature table rows (one column per feature))."""
    low = LOWER[raw]
    ws, we, first = spans(low, off, ALNUM)
    n = len(ws)
    sums = byte_sums(low)
    feats = np.empty((n, 1 + len(PREFIXES) + len(SUFFIXES)), np.int32)

    def put(k: int, s: np.ndarray, e: np.ndarray) -> None:
        h = range_hash(sums, s, e) * np.uint64(2 * k + 1) + np.uint64(k)
        feats[:, k] = (h >> np.uint64(64 - BITS)).astype(np.int32)

    put(0, ws, we)
    for k, m in enumerate(PREFIXES, 1):
        put(k, ws, np.minimum(we, ws + m))
    for k, m in enumerate(SUFFIXES, 1 + len(PREFIXES)):
        put(k, np.maximum(ws, we - m), we)
    stops = np.concatenate([[0], np.cumsum(_ENDS[low])])
    cut = np.ones(n, bool)
    if n:
        cut[1:] = stops[ws[1:]] > stops[we[:-1]]
        cut[first[first < n]] = True
    return ws, we, first, np.flatnonzero(cut), feats


def forward_backward(score: np.ndarray, chains: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Toxic marginals of all tokens, log partition sum of all chains, and expected transition counts (if `pairs`).

    `score`: toxic minus clean emission; `chains`: first token of each chain; `trans`: 2 x 2 weights. All chains advance
    one token at a time together; the longest first, so that those at work are a prefix."""
    n = len(score)
    p = np.zeros(n)
    counts, logz = np.zeros((2, 2)), 0.0
    if not n:
        return p, logz, counts
    length = np.diff(np.append(chains, n))
    order = np.argsort(-length, kind="stable")
    start, length = chains[order], length[order]
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")  # chains with at least t + 1 tokens
    x = np.clip(score, -40, 40)
    e1, e0 = np.exp(np.minimum(x, 0)), np.exp(np.minimum(-x, 0))  # emissions up to a factor exp(-max(x, 0)) for clean
    logz = float(np.maximum(x, 0).sum())
    t = np.exp(trans)
    f0, f1, z = np.empty(n), np.empty(n), np.empty(n)
    for step, k in enumerate(active):
        at = start[:k] + step
        if step:
            a0, a1 = f0[at - 1], f1[at - 1]
            b0, b1 = (a0 * t[0, 0] + a1 * t[1, 0]) * e0[at], (a0 * t[0, 1] + a1 * t[1, 1]) * e1[at]
        else:
            b0, b1 = e0[at], e1[at]
        s = b0 + b1
        f0[at], f1[at], z[at] = b0 / s, b1 / s, s
    logz += float(np.log(z).sum())
    g0, g1 = np.ones(n), np.ones(n)
    for step in range(len(active) - 2, -1, -1):
        at = start[: active[step + 1]] + step  # tokens that have a next one
        nx = at + 1
        u0, u1 = e0[nx] * g0[nx] / z[nx], e1[nx] * g1[nx] / z[nx]
        if pairs:
            for i, f in ((0, f0), (1, f1)):
                for j, u in ((0, u0), (1, u1)):
                    counts[i, j] += float((f[at] * t[i, j] * u).sum())
        g0[at], g1[at] = t[0, 0] * u0 + t[0, 1] * u1, t[1, 0] * u0 + t[1, 1] * u1
    return f1 * g1 / (f0 * g0 + f1 * g1), logz, counts


def _rows(batch: pa.RecordBatch):
    for i, j, raw, off in slices(batch.column(0)):
        yield i, j, tokens(raw, off)


def _sums(rows: DataFrame, fn, value: str = "v double") -> np.ndarray:
    """Adds what `fn(batches)` yields per partition, (positions, values), by position; at most a few times N rows return."""

    def run(batches):
        for at, v in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(v.astype(np.float64))], ["k", "v"])

    got = rows.mapInArrow(tidy(run), "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(3 * N)
    out[got.column("k").to_numpy()] = got.column("v").to_numpy()
    return out


class Field:
    """A fitted model: feature weights, bias, transitions, calibration."""

    def __init__(self, weights: np.ndarray, bias: float, trans: np.ndarray, scale: float, shift: float):
        self.weights, self.bias, self.trans, self.scale, self.shift = weights.astype(np.float32), bias, trans, scale, shift

    def marginals(self, feats: np.ndarray, chains: np.ndarray) -> np.ndarray:
        return forward_backward(self.weights[feats].sum(1, dtype=np.float64) + self.bias, chains, self.trans)[0]


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def _highest(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest marginal of each text; 0 without tokens."""
    out = np.zeros(len(first) - 1)
    some = first[1:] > first[:-1]
    if len(p):
        out[some] = np.maximum.reduceat(p, first[:-1][some])
    return out


def _lbfgs(fun, x: np.ndarray, steps: int, memory: int = 6) -> np.ndarray:
    f, g = fun(x)
    s_list, y_list = [], []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, y in reversed(list(zip(s_list, y_list))):
            a = s @ q / (y @ s)
            alphas.append(a)
            q -= a * y
        q *= (s_list[-1] @ y_list[-1]) / (y_list[-1] @ y_list[-1]) if s_list else 1.0 / max(1.0, float(np.abs(g).max()))
        for (s, y), a in zip(zip(s_list, y_list), reversed(alphas)):
            q += (a - y @ q / (y @ s)) * s
        step, slope = 1.0, float(g @ q)
        for _ in range(8):
            x2 = x - step * q
            f2, g2 = fun(x2)
            if f2 <= f - 1e-4 * step * slope:
                break
            step /= 3
        else:
            return x
        if (y := g2 - g) @ (s := x2 - x) > 1e-10:
            s_list, y_list = [*s_list, s][-memory:], [*y_list, y][-memory:]
        done = abs(f - f2) <= 1e-4 * max(1.0, abs(f))
        x, f, g = x2, f2, g2
        if done:
            return x
    return x


def fit(labelled: DataFrame, steps: int = 12) -> Field:
    """Field of `labelled` (text, y): rows that the caller has bounded. Without any row of either kind the score is
    constant and below THRESHOLD: nothing tells toxic from clean, so nothing is flagged."""
    rows = stored(labelled.select(F.col("text").cast("string").alias("text"), F.col("y").cast("int").alias("y")).repartition(int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "fit")
    n, n1 = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n1 or n1 == n:
        base = float(_logit(np.array([min((n1 + 0.5) / (n + 1), THRESHOLD / 2)]))[0])
        return Field(np.zeros(N), base, np.zeros((2, 2)), 0.0, base)

    def frequencies(batches):
        df = np.zeros((2, N))
        for b in batches:
            y = np.array(b.column(1).to_pylist(), np.int64)
            for i, j, (_, _, first, _, feats) in _rows(b):
                for d in range(j - i):
                    df[y[i + d]][np.unique(feats[first[d] : first[d + 1]])] += 1
        for k in (0, 1):
            at = np.flatnonzero(df[k])
            yield at + k * N, df[k][at]

    df = _sums(rows, frequencies)
    clean, toxic = df[:N], df[N : 2 * N]
    # how much oftener than by chance a feature stands in toxic documents; one pseudo-document on both sides, as few prove little
    odds = np.log((toxic + 1) / (n1 + 2)) - np.log((clean + 1) / (n - n1 + 2))
    odds = np.where(toxic >= 2, odds, 0.0).astype(np.float32)
    strongest = float(odds.max())

    def label(y: np.ndarray, first: np.ndarray, feats: np.ndarray) -> np.ndarray:
        a = odds[feats].max(1) if len(feats) else np.zeros(0, np.float32)
        out = np.zeros(len(a))
        for d in np.flatnonzero(y == 1):
            s = a[first[d] : first[d + 1]]
            if len(s) and s.max() >= 0.4 * strongest:  # else nothing in it can be told from clean text
                out[first[d] : first[d + 1]] = s >= max(0.5 * strongest, 0.8 * s.max())
                out[first[d] + int(s.argmax())] = 1.0
        return out

    def evaluate(x: np.ndarray):
        w, bias, trans = x[:N].astype(np.float32), float(x[N]), np.append(x[N + 1 : N + 4], 0.0).reshape(2, 2)

        def gradient(batches):
            grad, rest = np.zeros(N), np.zeros(6)
            for b in batches:
                y = np.array(b.column(1).to_pylist(), np.int64)
                for i, j, (_, _, first, chains, feats) in _rows(b):
                    t = label(y[i:j], first, feats)
                    score = w[feats].sum(1, dtype=np.float64) + bias
                    p, logz, counts = forward_backward(score, chains, trans, True)
                    inner = np.ones(len(t), bool)
                    inner[chains] = False
                    k = t.astype(np.int64)
                    seen = np.bincount(2 * k[:-1][inner[1:]] + k[1:][inner[1:]], minlength=4) if len(t) > 1 else np.zeros(4)
                    d = p - t
                    grad += np.bincount(feats.ravel(), np.repeat(d, feats.shape[1]), N)
                    rest[0] += d.sum()
                    rest[1:5] += counts.ravel() - seen
                    # the factor of the emissions that forward_backward takes out is that of log Z
                    rest[5] += logz - float(np.clip(score, -40, 40) @ t) - float(trans.ravel() @ seen)
            at = np.flatnonzero(grad)
            yield at, grad[at]
            yield N + np.arange(6), rest

        out = _sums(rows, gradient)
        g = np.append(out[: N + 1], out[N + 1 : N + 4]) + L2 * np.append(x[:N], np.zeros(4))
        return out[N + 5] + L2 / 2 * float(x[:N] @ x[:N]), g

    x0 = np.zeros(N + 4)
    x0[N] = -3.0
    x = _lbfgs(evaluate, x0, steps)
    field = Field(x[:N], float(x[N]), np.append(x[N + 1 : N + 4], 0.0).reshape(2, 2), 1.0, 0.0)

    def highest(batches):
        for b in batches:
            for i, j, (_, _, first, chains, feats) in _rows(b):
                yield pa.RecordBatch.from_arrays([pa.array(_highest(field.marginals(feats, chains), first)), b.column(1).slice(i, j - i)], ["m", "y"])

    got = rows.mapInArrow(tidy(highest), "m double, y int").toArrow()  # two numbers for each of the bounded fit rows
    m, y = _logit(got.column("m").to_numpy()) / 4, got.column("y").to_numpy().astype(float)
    a, b = 1.0, 0.0
    for _ in range(50):  # logistic calibration, a slightly damped Newton
        q = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        w = q * (1 - q) + 1e-9
        h = np.array([[(w * m * m).sum() + 0.1, (w * m).sum()], [(w * m).sum(), w.sum() + 0.1]])
        da, db = np.linalg.solve(h, [((q - y) * m).sum() + 0.1 * (a - 1), (q - y).sum() + 0.1 * b])
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-8:
            break
    field.scale, field.shift = max(float(a), 0.0) / 4, float(b)
    return field


def score(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with columns __score (0 to 1) and __spans (array of byte starts and ends of toxic token runs, in UTF-8),
    names that `docs` must not have (see common.shielded)."""
    at = docs.columns.index("text")
    names = docs.columns

    def run(batches):
        for b in batches:
            for i, j, raw, off in slices(b.column(at)):
                ws, we, first, chains, feats = tokens(raw, off)
                p = field.marginals(feats, chains)
                s = 1 / (1 + np.exp(-np.clip(field.scale * _logit(_highest(p, first)) + field.shift, -30, 30)))
                bad = np.flatnonzero(p >= 0.5)
                doc = np.searchsorted(first, bad, "right") - 1
                lists: list[list[dict]] = [[] for _ in range(j - i)]
                for d, x, y in zip(doc.tolist(), (ws[bad] - off[doc]).tolist(), (we[bad] - off[doc]).tolist()):
                    lists[d].append({"start": x, "end": y})
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(s), pa.array(lists, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=[*names, "__score", "__spans"],
                )

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.mapInArrow(tidy(run), f"{fields}, __score double, __spans array<struct<start:long,end:long>>")


def held_out():
    """True where crc32 of doc_id as text is 2 mod 4; null doc_id: true."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Field:
    """Field of about `rows` labelled documents (doc_id, text) x (doc_id, toxic), none of them held out. Rows are
    taken by a hash of doc_id. Of several labels of one document the highest counts; null labels and ids don't."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y"))
    n = known.count()
    keep = int(min(1.0, rows / max(n, 1)) * (1 << 30))
    sample = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < keep)
    # about FIT_ROWS rows of two numbers
    return fit(docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("text", "y"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the toxic spans of each row of `docs` (doc_id, text). Null and empty texts
    have no tokens and get the score of a highest marginal of 0. Repeated rows are scored alike. Other columns are not read.
    An empty table gives no rows."""
    field = fit_on(docs, labels)
    out = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), field)
    return out.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"), F.col("__spans").alias("spans"))
