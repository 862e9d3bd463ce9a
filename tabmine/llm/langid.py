"""Language identification with hyperdimensional profiles.

Every letter, of any alphabet, has a random vector of +1/-1, drawn from its code point. An n-gram of letters is bound by multiplying the vectors of its letters, each
permuted (rolled) by its place; a text bundles (adds) the vectors of its n-grams; a language's prototype is the bundle of
its training texts, each with equal weight. A text gets the language whose prototype has the highest cosine with its own
vector. The n-gram counts of a slice of texts are matrices, multiplied with the matrices of the n-grams' vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, tidy

DIM = 1024
_ROWS = 128  # texts of one slice
_GRAMS = 8192  # n-grams of one count matrix
_STATE: dict[str, np.ndarray] = {}


def letter_codes() -> np.ndarray:
    """Letter of every code point: the code point of its lower case, 0 (the blank) for all that is no letter."""
    if "codes" not in _STATE:
        codes = np.zeros(0x110000, np.int64)
        for c in range(0x110000):
            if chr(c).isalpha():
                s = chr(c).lower()
                codes[c] = ord(s) if len(s) == 1 else c
        _STATE["codes"] = codes
    return _STATE["codes"]


def letter_vectors(letters: np.ndarray, dim: int = DIM) -> np.ndarray:
    """A row of +1/-1 per letter, drawn from its whole code point: no two letters share their bits."""
    words = -(-dim // 64)
    seed = letters.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    bits = np.unpackbits(mix(mix(seed + np.uint64(1))).view(np.uint8), axis=1)[:, :dim]
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def gram_vectors(grams: np.ndarray, dim: int = DIM) -> np.ndarray:
    """One row per trigram code, 21 bits a letter: rho^2(a) * rho(b) * c."""
    letters, at = np.unique(np.concatenate([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF]), return_inverse=True)
    a, b, c = at.reshape(3, -1)
    v = letter_vectors(letters, dim)
    return (np.roll(v, 2, 1)[a] * np.roll(v, 1, 1)[b] * v[c]).astype(np.float32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, trigram code) of every letter with its neighbours. Letters only, lower-cased; runs of
    anything else are one blank, and a blank stands before and after every text."""
    joined = "\n".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    off = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    k = np.concatenate([letter_codes()[cp], [0]])
    doc = np.repeat(np.arange(len(texts)), np.diff(off))
    keep = np.ones(len(k), bool)
    keep[1:] = (k[1:] > 0) | (k[:-1] > 0)
    k, doc = k[keep], doc[keep]
    before = np.concatenate([[0], k[:-2]])  # a blank before the first text; the others share the one between
    centre = k[:-1] > 0
    return doc[:-1][centre], before[centre] << 42 | k[:-1][centre] << 21 | k[1:][centre]


def text_vectors(texts: list[str], dim: int = DIM) -> np.ndarray:
    """A row per text: the bundle of its trigrams; zero without letters. Distinct trigrams are bundled in blocks of
    _GRAMS, so memory is bounded for any alphabet."""
    out = np.zeros((len(texts), dim), np.float32)
    if not texts:
        return out
    doc, gram = trigrams(texts)
    order = np.argsort(gram, kind="stable")
    doc, gram = doc[order], gram[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
    ends = np.append(first, len(gram))
    for i in range(0, len(first), _GRAMS):
        n = min(_GRAMS, len(first) - i)
        place = np.repeat(np.arange(n), np.diff(ends[i : i + n + 1]))
        rows = doc[ends[i] : ends[i + n]]
        m = np.bincount(rows * n + place, minlength=len(texts) * n).reshape(len(texts), n)
        out += m.astype(np.float32) @ gram_vectors(gram[first[i : i + n]], dim)
    return out


def _groups(col: pa.Array):
    for i, j, _, _ in slices(col, 1 << 20):
        for a in range(i, j, _ROWS):
            z = min(j, a + _ROWS)
            yield a, z, [t or "" for t in col.slice(a, z - a).to_pylist()]


def fit(docs: DataFrame, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Prototypes of the non-null `lang` values over all rows of `docs` (text, lang): every text adds its vector scaled
    to length 1. Partitions add their texts up first; a language's sums meet as one row per place of the vector, and
    `dim` numbers per language reach the driver. Texts without letters add nothing."""
    src = docs.where(F.col("lang").isNotNull()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))

    def add(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_pylist()
            for i, j, texts in _groups(b.column(0)):
                v = text_vectors(texts, dim)
                norm = np.sqrt((v.astype(np.float64) ** 2).sum(1))
                v = v / np.maximum(norm, 1e-9)[:, None]
                names = np.array(langs[i:j], object)
                for name in set(langs[i:j]):
                    sums[name] = sums.get(name, 0) + v[names == name].astype(np.float64).sum(0)
        for name, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.rint(s * 2**20).astype(np.int64))], ["lang", "k", "v"])

    # sums of whole numbers: the same whatever the order of the partitions
    rows = src.mapInArrow(tidy(add), "lang string, k int, v long").groupBy("lang", "k").agg(F.sum("v").alias("v"))
    per = rows.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("p")).orderBy("lang").collect()
    proto = np.array([[x["v"] for x in r["p"]] for r in per], np.float64).reshape(len(per), dim)
    norm = np.sqrt((proto**2).sum(1, keepdims=True))
    return [r["lang"] for r in per], proto / np.maximum(norm, 1e-9)


def predict(docs: DataFrame, langs: list[str], proto: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1) of each row. A null text or one without letters gets `und` and 0, as
    does any text if no language was learned. Ties go to the first language by code point."""
    dim = proto.shape[1]
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for b in batches:
            for i, j, texts in _groups(b.column(1)):
                v = text_vectors(texts, dim).astype(np.float64)
                norm = np.sqrt((v**2).sum(1))
                cos = v @ proto.T / np.maximum(norm, 1e-9)[:, None] if langs else np.zeros((len(texts), 1))
                best = cos.argmax(1)
                none = (norm == 0) | (not langs)
                names = ["und" if z else langs[k] for k, z in zip(best, none)]
                score = np.where(none, 0.0, np.clip(cos[np.arange(len(best)), best], 0.0, 1.0))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return src.mapInArrow(tidy(run), "doc_id long, lang_pred string, score double")


def held_out(folds: int, fold: int):
    """True where crc32 of doc_id as text falls into the fold; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(True))


def language(docs: DataFrame, dim: int = DIM) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; learned from the rows of `docs` that are not held out (crc32 mod 5
    is not 0). Null or letterless text: `und` and 0, and nothing is learned from it. A null doc_id is held out; repeated
    rows are rows of their own; ties go to the first language by code point; texts of any length are read whole; other
    columns are ignored; an empty table gives no rows."""
    langs, proto = fit(docs.where(~held_out(5, 0)), dim)
    return predict(docs, langs, proto if langs else np.zeros((0, dim))).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")
