"""Counting and looking up 64-bit keys of documents by hash partition, in bulk.

Documents are dealt into chunks of bounded size. A chunk's task derives its keys (n-grams, windows), sorts them and asks
for them: one row per key range ("bucket") that carries the chunk's distinct keys of the range with a value each. A
bucket's task merges the chunks' keys, reduces their values and answers every chunk with one number per asked key, in the
asked order. A key that all documents share is still one entry per chunk. Keys and answers travel as byte planes of
sorted differences, which compress well; a bucket holds `BUCKET_KEYS` keys on average, as the hash deals them evenly."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

#: Text bytes of a chunk aimed at.
CHUNK_BYTES = 6 << 20
BUCKET_KEYS = 2_000_000
ASK = "chunk long, bucket long, keys binary, v0 binary, v1 binary"
ANSWER = "chunk long, bucket long, round int, found binary"


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1, write_content_size=True), zstandard.ZstdDecompressor()


def pack(x: np.ndarray) -> bytes:
    """Compressed byte planes of 64-bit numbers: the upper planes of small numbers and differences are mostly zero."""
    return _ZIP.compress(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), 8).T).data)


def unpack(b: bytes, dtype=np.int64) -> np.ndarray:
    planes = np.frombuffer(_UNZIP.decompress(b), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(dtype)


def deal(docs: DataFrame, n_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """`docs` with a column `chunk`, by a hash of doc_id and text."""
    n = max(1, -(-n_bytes // chunk_bytes))
    return docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def edges(n_buckets: int, bits: int) -> np.ndarray:
    """First key of every bucket but the first."""
    return np.array([b * (1 << bits) // n_buckets for b in range(1, n_buckets)], np.uint64)


def ask_table(chunk: int, keys: np.ndarray, values: list[np.ndarray], n_buckets: int, bits: int = 64) -> pa.Table:
    """Rows that ask for sorted distinct `keys` below 2^bits."""
    cut = np.concatenate([[0], np.searchsorted(keys, edges(n_buckets, bits)), [len(keys)]])
    rows: dict[str, list] = {k: [] for k in ("chunk", "bucket", "keys", "v0", "v1")}
    for b in np.flatnonzero(np.diff(cut)):
        a, z = cut[b], cut[b + 1]
        rows["chunk"].append(chunk)
        rows["bucket"].append(int(b))
        rows["keys"].append(pack(np.concatenate([keys[a : a + 1], np.diff(keys[a:z])])))
        for k in (0, 1):
            rows[f"v{k}"].append(pack(values[k][a:z].astype(np.int64)) if k < len(values) else b"")
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    release()
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), types)})


def answer(ask: DataFrame, reduce: Callable[[np.ndarray, list[np.ndarray]], np.ndarray], round_: int) -> DataFrame:
    """`reduce(first positions of the groups of equal keys, sorted values)` gives a number per group."""

    def run(key, t):
        chunks, parts, vals = t.column("chunk").to_pylist(), [], ([], [])
        for k, a, b in zip(t.column("keys").to_pylist(), t.column("v0").to_pylist(), t.column("v1").to_pylist()):
            parts.append(np.cumsum(unpack(k, np.uint64), dtype=np.uint64))
            vals[0].append(unpack(a))
            if b:
                vals[1].append(unpack(b))
        keys = np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        got = reduce(first, [np.concatenate(v)[order] for v in vals if v]).astype(np.int64)
        out = np.empty(len(keys), np.int64)
        out[order] = np.repeat(got, np.diff(np.append(first, len(keys))))
        at = np.cumsum([0] + [len(p) for p in parts])
        bucket = key[0].as_py()
        release()
        return pa.table(
            {
                "chunk": pa.array(chunks, pa.int64()),
                "bucket": pa.array([bucket] * len(chunks), pa.int64()),
                "round": pa.array([round_] * len(chunks), pa.int32()),
                "found": pa.array([pack(out[a:z]) for a, z in zip(at[:-1], at[1:])], pa.binary()),
            }
        )

    return ask.groupBy("bucket").applyInArrow(run, ANSWER)


def answers_of(t: pa.Table, round_: int) -> np.ndarray:
    """The answers of one round for a chunk's sorted keys."""
    rows = sorted((b, f) for b, r, f in zip(t.column("bucket").to_pylist(), t.column("round").to_pylist(), t.column("found").to_pylist()) if r == round_)
    return np.concatenate([unpack(f) for _, f in rows]) if rows else np.zeros(0, np.int64)


def total(first: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    return np.add.reduceat(values[0], first)
