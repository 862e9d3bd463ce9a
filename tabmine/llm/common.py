"""Shared helpers of the text operators: Arrow text buffers, vectorised word
hashes, scratch tables in the shared checkpoint folder, input clean-up."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tabmine.session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a Python task; a longer single text is handled alone.
SLICE_BYTES = 2 << 20


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true inside the given inclusive byte ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


# The separators of the word patterns of the contracts.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))  # [^\x20\x09-\x0D]+
ALNUM = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
SPACE_WORD = r"[^\x20\x09-\x0D]+"

#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts the
    lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


try:
    _TRIM: Callable | None = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # another C library
    _TRIM = None


def release() -> None:
    """Give freed memory back: Python workers live on between tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def tidy(run: Callable) -> Callable:
    """A mapInArrow function that releases its memory at the end of the partition."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return inner


def shielded(docs: DataFrame, *known: str) -> DataFrame:
    """`docs` with every column but the `known` ones under a private name, so that no name of a user's column meets one
    that an operator adds. Give the names back with toDF(*docs.columns)."""
    return docs.toDF(*[c if c in known else f"column {k}" for k, c in enumerate(docs.columns)])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = col.chunk(0) if col.num_chunks else pa.array([], pa.large_binary())
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    col = col.cast(pa.large_binary())
    _, off, data = col.buffers()
    n = len(col)
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + n + 1] if n else np.zeros(1, np.int64)
    base = int(offsets[0])
    size = int(offsets[-1]) - base
    raw = np.frombuffer(data, np.uint8)[base : base + size] if size else np.zeros(0, np.uint8)
    return raw, offsets - base


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive row ranges (first, last) of a text column of about `limit` bytes each, with bytes and offsets."""
    raw, off = utf8(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def spans(raw: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and the first word number of every text (one more entry than texts).
    A word never crosses a text's border."""
    w = inside[raw]
    n = len(raw)
    first = np.zeros(n + 1, bool)
    first[off] = True
    prev = np.zeros(n, bool)
    prev[1:] = w[:-1]
    nxt = np.zeros(n, bool)
    nxt[:-1] = w[1:]
    starts = np.flatnonzero(w & (~prev | first[:n]))
    ends = np.flatnonzero(w & (~nxt | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_M), -1, 1 << 64))
_TAB = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        size = max(n, 1 << 16)
        p = np.full(size, _M, np.uint64)
        q = np.full(size, _INV, np.uint64)
        p[0] = q[0] = 1
        _POW["p"], _POW["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POW["p"][:n], _POW["q"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of 64-bit values, for range_hash()."""
    p, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the value ranges [start, end), equal for equal sequences."""
    _, q = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * q[starts])


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_sums(_TAB[raw]), starts, ends)


def byte_sums(raw: np.ndarray) -> np.ndarray:
    return prefix_sums(_TAB[raw])
