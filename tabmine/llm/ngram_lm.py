"""Stupid-backoff language-model scores from n-gram counts of the whole corpus.

Count tables of all n-grams up to `order` are partitioned by hash (lookup.py); every document's n-grams are joined to them
and the scores are summed per document. A document is scored by the other documents: its own occurrences are taken off
the counts. So an n-gram counts only if it occurs elsewhere too, hence only if both its (n-1)-grams do: longer n-grams are
asked for after the shorter ones, and only where those were found. This drops nothing but zeros.

With c the counts without the document and N its words less than the corpus', a word w after context u is worth
c(u w) / c(u) if c(u w) > 0, else ALPHA times its worth after the context without the first word; without context
c(w) / N, and ALPHA / N for a word not seen elsewhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lookup
from .common import NOT_SPACE, mix, prefix_sums, range_hash, slices, spans, word_hashes

ALPHA = 0.4
ORDER = 3
#: Bits of an n-gram's hash (the last one is always 1). Of a million million n-grams, one in 100,000 shares its key.
KEY_BITS = 58


def chunk_words(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts of a chunk, and the first word of each text (one more entry than texts)."""
    hashes, firsts, n = [], [np.zeros(1, np.int64)], 0
    for _, _, raw, off in slices(col):
        s, e, first = spans(raw, off, NOT_SPACE)
        hashes.append(word_hashes(raw, s, e))
        firsts.append(first[1:] + n)
        n += len(s)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


class ChunkGrams:
    """The n-grams of a chunk's documents, found step by step with the answers for shorter ones."""

    def __init__(self, text: pa.ChunkedArray):
        self.words, self.first = chunk_words(text)
        self.doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self.at_end = self.first[1:][self.doc]
        self.sums = prefix_sums(self.words)
        self.others: list[np.ndarray] = []  # per order: occurrences in other documents of the n-gram that starts here
        self.N = 0

    def positions(self, n: int) -> np.ndarray:
        at = np.arange(len(self.words))
        ok = at + n <= self.at_end
        if n > 1:
            prev = self.others[n - 2]
            ok &= prev > 0
            ok[:-1] &= prev[1:] > 0
            ok[-1:] = False
        return np.flatnonzero(ok)

    def keys(self, n: int):
        """(start positions, sorted distinct keys, index of each position's key, occurrences per key)."""
        at = self.positions(n)
        h = (mix(range_hash(self.sums, at, at + n) + np.uint64(n)) >> np.uint64(64 - KEY_BITS)) | np.uint64(1)  # 0 stands for the number of words
        keys, inv, count = np.unique(h, return_inverse=True, return_counts=True)
        return at, keys, inv, count

    def ask(self, n: int):
        _, keys, _, count = self.keys(n)
        if n == 1:
            return np.append(np.uint64(0), keys), np.append(len(self.words), count)
        return keys, count

    def learn(self, n: int, found: np.ndarray) -> None:
        at, keys, inv, _ = self.keys(n)
        if n == 1:
            self.N, found = int(found[0]), found[1:]
        pair = self.doc[at].astype(np.int64) * max(len(keys), 1) + inv
        own, where, times = np.unique(pair, return_inverse=True, return_counts=True)
        out = np.zeros(len(self.words), np.int64)
        out[at] = found[inv] - times[where]
        self.others.append(out)

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """(words, summed natural logarithms) of each document."""
        length = np.diff(self.first)
        rest = np.maximum(self.N - length, 1)[self.doc].astype(np.float64)
        c1 = self.others[0]
        value = np.where(c1 > 0, np.maximum(c1, 1), ALPHA) / rest
        for n in range(2, len(self.others) + 1):
            has = np.zeros(len(self.words), bool)  # words with n - 1 words before them in their document
            last = np.arange(len(self.words)) - (n - 1)
            ok = last >= self.first[:-1][self.doc]
            has[ok] = True
            num, den = np.zeros(len(self.words)), np.ones(len(self.words))
            num[ok] = self.others[n - 1][last[ok]]
            den[ok] = np.maximum(self.others[n - 2][last[ok]], 1)
            value = np.where(has, np.where(num > 0, num / den, ALPHA * value), value)
        return length, np.bincount(self.doc, np.log(value), len(length)) if len(length) else np.zeros(0)


def lm_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logarithms), mean_log_score (null without words) of each row.

    Null or empty text: no words, log_score 0. Repeated rows are documents of their own, so copies raise each other's
    counts. Other columns are ignored; an empty table gives no rows."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_bytes = lookup.text_bytes(src)
    dealt = lookup.deal(src, n_bytes)
    buckets = max(1, n_bytes // (6 * lookup.BUCKET_KEYS))
    schema = "doc_id long, n_words long, log_score double"

    def known(t: pa.Table, found: pa.Table | None, upto: int) -> ChunkGrams:
        g = ChunkGrams(t.column("text"))
        for n in range(1, upto + 1):
            g.learn(n, lookup.answers_of(found, n))
        return g

    def asks(n: int):
        def ask(t, found):
            if not t.num_rows:
                return lookup.ask_table(0, np.zeros(0, np.uint64), [], buckets, KEY_BITS)
            keys, count = known(t, found, n - 1).ask(n)
            return lookup.ask_table(t.column("chunk")[0].as_py(), keys, [count], buckets, KEY_BITS)

        return ask

    first = asks(1)
    answers = lookup.answer(dealt.groupBy("chunk").applyInArrow(lambda t: first(t, None), lookup.ASK), lookup.total, 1)
    for n in range(2, order + 1):
        asked = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(asks(n), lookup.ASK)
        answers = answers.unionByName(lookup.answer(asked, lookup.total, n))

    def scored(t, found):
        if not t.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "log_score": pa.array([], pa.float64())})
        n, s = known(t, found, order).scores()
        return pa.table({"doc_id": t.column("doc_id"), "n_words": pa.array(n, pa.int64()), "log_score": pa.array(s)})

    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, schema)
    return out.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
