"""Exact duplicates by Grace hash partitioning, equality always decided on complete contents.

A record is a text (runs of separators made one space) with the least doc_id and the number of the rows it stands for.
First, every chunk of rows merges its equal records in an open-addressing table, so that a text that a third of all rows
have goes on once a chunk. The chunk's leading records are written in the shared folder, then dealt into buckets by
hash. A bucket whose records fit BUCKET_BYTES is settled by one open-addressing table. The records of larger buckets are
merged by chunks again (sorted by hash, so that equal ones meet), written as the next level's records and dealt into more
buckets, until every bucket fits. Rows then read their answer along the links from record to record, each a join on a key
that at most a chunk of rows shares."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, slices, stored, tidy

BUCKET_BYTES, CHUNK_BYTES = 16 << 20, 4 << 20
#: A record costs this many bytes beside its text.
RECORD_BYTES = 64
#: Each level deals into this many times more buckets a byte than the one before.
FAN = 4

_RECORD = [("rid", pa.int64()), ("lead", pa.int64()), ("h", pa.int64()), ("text", pa.large_binary()), ("least", pa.int64()), ("stay", pa.int64()), ("n", pa.int64())]
_ROWS = pa.schema([*_RECORD, ("doc_id", pa.int64()), ("text_sha256", pa.large_string())])
_RECORDS = pa.schema(_RECORD)
_ANSWERS = pa.schema([("rid", pa.int64()), ("keep_id", pa.int64()), ("stay", pa.int64()), ("group_size", pa.int64())])
RECORD_TYPES = "rid long, lead long, h long, text binary, least long, stay long, n long"


def normalise(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of separators becomes one space; (bytes, offsets) of the texts."""
    gap = ~NOT_SPACE[raw]
    again = np.zeros(len(raw), bool)
    again[1:] = gap[1:] & gap[:-1]
    again[off[:-1][off[:-1] < len(raw)]] = False
    place = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(~again, out=place[1:])
    return np.where(gap, np.uint8(32), raw)[~again], place[off]


def leaders(h: np.ndarray, texts: pa.Array) -> np.ndarray:
    """For every record the number of the first record with the same content: linear probing in an open-addressing table,
    all records a probe at a time. Equal contents begin at one slot and stay together, so they end at one owner."""
    n = len(h)
    mask = (1 << max(1, int(2 * n - 1).bit_length())) - 1 if n else 0
    held, slot = np.full(mask + 1, -1, np.int64), (h & mask).astype(np.int64)
    owner, todo = np.arange(n), np.arange(n)
    while len(todo):
        free = todo[held[slot[todo]] < 0]
        held[slot[free][::-1]] = free[::-1]  # the first record of a slot takes it
        at = held[slot[todo]]
        same = at == todo
        near = np.flatnonzero(~same & (h[at] == h[todo]))
        if len(near):
            same[near] = pc.equal(texts.take(pa.array(at[near])), texts.take(pa.array(todo[near]))).to_numpy(zero_copy_only=False)
        owner[todo[same]] = at[same]
        todo = todo[~same]
        slot[todo] = (slot[todo] + 1) & mask
    return owner


def _least(owner: np.ndarray, least: pa.Array, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading records, and for each the record of its group with the smallest (doc_id, row), nulls last."""
    none = np.asarray(least.is_null())
    order = np.lexsort((stay, least.fill_null(0).to_numpy(), none, owner))
    lead, at = np.unique(owner[order], return_index=True)
    return lead, order[at]


def _merged(rid: np.ndarray, h: np.ndarray, texts: pa.Array, least: pa.Array, stay: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """One chunk's records with the record that leads each; text, least, stay and n stand on leading records only."""
    owner = leaders(h, texts)
    lead, best = _least(owner, least, stay)
    total = np.zeros(len(h), np.int64)
    np.add.at(total, owner, n)
    where = np.full(len(h), -1, np.int64)
    where[lead] = np.arange(len(lead))
    follows = pa.array(owner != np.arange(len(h)))
    at = pa.array(where, mask=np.asarray(follows))
    empty = pa.nulls(len(h), pa.large_binary())
    return [pa.array(rid), pa.array(rid[owner]), pa.array(h), pc.if_else(follows, empty, texts), least.take(pa.array(best)).take(at), pa.array(stay[best]).take(at), pa.array(total, mask=np.asarray(follows))]


def _binary(raw: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])


@tidy
def read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> the first level's records, and of every row its doc_id and the hash of its text."""
    next_rid = TaskContext.get().partitionId() << 40
    for batch in batches:
        doc_ids, texts = batch.column(0).cast(pa.int64()), batch.column(1)
        for i, j, raw, off in slices(texts, CHUNK_BYTES):
            raw, off = normalise(raw, off)
            data = raw.tobytes()
            digests = [hashlib.sha256(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            h = np.frombuffer(b"".join(d.digest()[:8] for d in digests), "<i8")
            rid = np.arange(next_rid, next_rid + j - i)
            next_rid += j - i
            ids = doc_ids.slice(i, j - i)
            record = _merged(rid, h, _binary(raw, off), ids, rid, np.ones(j - i, np.int64))
            yield pa.RecordBatch.from_arrays([*record, ids, pa.array([d.hexdigest() for d in digests], pa.large_string())], schema=_ROWS)


def _columns(batch: pa.RecordBatch | pa.Table) -> tuple:
    rid, h, stay, n = (np.asarray(batch.column(c)).astype(np.int64) for c in ("rid", "h", "stay", "n"))
    text, least = batch.column("text"), batch.column("least")
    if isinstance(text, pa.ChunkedArray):
        text, least = text.combine_chunks(), least.combine_chunks()
    return rid, h, text.cast(pa.large_binary()), least, stay, n


@tidy
def merge_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records sorted by hash -> records merged within chunks of two or more."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:
            j = max(i + 2, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + CHUNK_BYTES)))
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays(_merged(*_columns(part)), schema=_RECORDS)
            i = j


def settle(bucket: pa.Table) -> pa.Table:
    """All records of a bucket -> the answer of each."""
    rid, h, texts, least, stay, n = _columns(bucket)
    owner = leaders(h, texts)
    lead, best = _least(owner, least, stay)
    total = np.zeros(len(h), np.int64)
    np.add.at(total, owner, n)
    group = np.searchsorted(lead, owner)
    return pa.Table.from_arrays([pa.array(rid), least.take(pa.array(best[group])), pa.array(stay[best[group]]), pa.array(total[owner])], schema=_ANSWERS)


def _answers(records: DataFrame, level: int) -> DataFrame:
    """rid, keep_id, stay, group_size of every leading record of a written level."""
    # the first level's rows hold texts on leading records only
    records = records.where("text is not null").select("rid", "h", "text", "least", "stay", "n")
    size = F.octet_length("text").cast("long") + RECORD_BYTES
    total = records.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    buckets = max(1, 2 * total // BUCKET_BYTES) * FAN**level
    records = records.withColumn("bucket", F.pmod(F.xxhash64("h", F.lit(level)), F.lit(buckets)))
    large = records.groupBy("bucket").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("records"))
    large = stored(large.where((F.col("bytes") > BUCKET_BYTES) & (F.col("records") > 1)).select("bucket"), "large_buckets")
    schema = "rid long, keep_id long, stay long, group_size long"
    if large.isEmpty():
        return records.groupBy("bucket").applyInArrow(settle, schema)
    small = records.join(large, "bucket", "left_anti").groupBy("bucket").applyInArrow(settle, schema)
    # some buckets' worth of neighbours in hash order a partition, but eight records at least: copies of one text meet,
    # however long it is, and every level has fewer of them
    rest = stored(records.join(large, "bucket", "left_semi").drop("bucket"), f"large_records_{level}")
    parts = max(1, min(total // (4 * BUCKET_BYTES), rest.count() // 8))
    rest = rest.repartitionByRange(parts, "h", "rid").sortWithinPartitions("h")
    merged = stored(rest.mapInArrow(merge_records, RECORD_TYPES), f"records_{level + 1}")
    below = stored(_answers(merged, level + 1), f"answers_{level + 1}").withColumnRenamed("rid", "lead")
    return small.unionByName(merged.select("rid", "lead").join(below, "lead").drop("lead"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of `docs`.

    Cases: a null text is empty. The row with the smallest doc_id stays, null ids last; keep_id is null if all ids of a
    group are. Of rows that repeat one doc_id and text exactly one is kept. Texts of any length are compared whole; one
    longer than a bucket has a bucket of its own. An empty table gives no rows. Other columns are not read."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read_rows, RECORD_TYPES + ", doc_id long, text_sha256 string")
    rows = stored(rows, "records_0")
    answers = _answers(rows, 0).select(F.col("rid").alias("lead"), "keep_id", F.col("stay").alias("stays"), "group_size")
    return rows.select("rid", "lead", "doc_id", "text_sha256").join(answers, "lead").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("stays")).alias("kept"), "text_sha256")
