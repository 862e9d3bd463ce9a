"""Removal of repeated byte strings by suffix order (bwt.py), dealt out so that equal windows meet.

A window is `window` consecutive bytes of one document. Its anchor is the smallest hash of the GRAM-byte strings inside it.
A run is a stretch of windows with the same anchor, its block the bytes they cover. Equal windows have equal anchors, so

1. windows of an anchor that only one run has are unique; if all its runs have the same block, all are repeated;
2. of the other runs, those whose block another run has too are repeated, and one run stands for each block;
3. of the runs left, windows whose hash occurs once are unique; the stretches of the others go to the bucket of their
   anchor, equal stretches once, where merged Burrows-Wheeler transforms tell which windows are repeated.

Steps 1 to 3 ask for keys in bulk (lookup.py): a key that all documents share is one entry per chunk, and a bucket holds
each different stretch once, however many documents have it."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bwt, lookup
from .common import byte_sums, mix, range_hash, slices
from .phrases import sliding_min

WINDOW, GRAM = 200, 32
#: Text bytes of a chunk, and of the part of it in work: every byte in work costs some 100 bytes of arrays for a moment.
CHUNK_BYTES, STEP_BYTES = 3 << 20, 1 << 20
#: Text bytes for each bucket of stretches.
BUCKET_BYTES = 16 << 20
_RUNS, _ANCHORS, _BLOCKS, _PLAN, _WINDOWS, _FOUND = range(6)


def _sorted(t: pa.Table) -> pa.Table:
    """A chunk's rows in an order that every reading of the chunk agrees on."""
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _runs(t: pa.Table, window: int) -> np.ndarray:
    """Columns start, windows, anchor, block hash of all runs of a chunk; starts count from the chunk's first byte.
    The lowest bit of the block hash tells that the anchor stands twice or more in the block, so that windows may
    repeat inside the run."""
    out, base = [np.zeros((4, 0), np.int64)], 0
    for _, _, raw, off in slices(t.column("text"), STEP_BYTES):
        n = len(raw)
        if n >= window:
            sums = byte_sums(raw)
            at = np.arange(n - GRAM + 1)
            gram = range_hash(sums, at, at + GRAM)
            anchor = sliding_min(gram, window - GRAM + 1)
            left = np.repeat(off[1:], np.diff(off))[: len(anchor)] - np.arange(len(anchor))  # bytes to the document's end
            ok = left >= window
            new = np.ones(len(anchor) + 1, bool)
            new[1:-1] = (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1])
            new[off[off < len(anchor)]] = True
            b = np.flatnonzero(new)
            s, e = b[:-1], b[1:]
            s, e = s[ok[s]], e[ok[s]]
            block = range_hash(sums, s, e + window - 1) & np.uint64((1 << 63) - 2)
            twice = _times(gram, anchor[s], s, e + window - GRAM) > 1
            out.append(np.stack([s + base, e - s, anchor[s].view(np.int64), block.view(np.int64) | twice]))
        base += n
    return np.concatenate(out, 1)


def _times(values: np.ndarray, wanted: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """How often `wanted` stands in each range [a, z) of `values`."""
    out = np.zeros(len(a), np.int64)
    for i in range(0, len(a), 2048):
        x, n = a[i : i + 2048], (z - a)[i : i + 2048]
        at = np.arange(n.sum()) + np.repeat(x - (np.cumsum(n) - n), n)
        same = values[at] == np.repeat(wanted[i : i + 2048], n)
        out[i : i + 2048] = np.add.reduceat(same, np.cumsum(n) - n)
    return out


class Chunk:
    """A chunk's runs."""

    def __init__(self, t: pa.Table):
        m = lookup.unpack(t.column("found")[0].as_py()).reshape(4, -1)
        self.number = t.column("chunk")[0].as_py()
        self.start, self.count, self.anchor, self.block, self.twice = m[0], m[1], m[2].view(np.uint64), m[3] & ~np.int64(1), (m[3] & 1) > 0

    def codes(self, info: pa.Table) -> np.ndarray:
        """Per run: 0 alone with its anchor, 1 all runs of the anchor have its block, 2 several blocks, or one that may repeat itself."""
        keys = np.unique(self.anchor)
        found = lookup.answers_of(info, _ANCHORS)
        return found[np.searchsorted(keys, self.anchor)] if len(keys) else np.zeros(0, np.int64)

    def blocks(self, info: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Runs with code 2 and their block keys."""
        k = np.flatnonzero(self.codes(info) == 2)
        return k, mix(self.block[k].view(np.uint64))

    def repeated_runs(self, info: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """(runs all of whose windows are repeated, runs that stand for their block in step 3)."""
        k, key = self.blocks(info)
        keys = np.unique(key)
        found = lookup.answers_of(info, _BLOCKS)
        found = found[np.searchsorted(keys, key)] if len(keys) else np.zeros(0, np.int64)
        again = (found & 1) > 0
        mine = (found >> 1) == _place(self.number, self.start[k])
        return np.concatenate([np.flatnonzero(self.codes(info) == 1), k[again]]), k[mine]


class Plan:
    """What steps 1 and 2 leave of a chunk: the runs for step 3 and those that are repeated whole."""

    def __init__(self, info: pa.Table):
        raw = next(b for r, b in zip(info.column("round").to_pylist(), info.column("found").to_pylist()) if r == _PLAN)
        x = lookup.unpack(raw)
        n = int(x[0])
        self.start, self.count, self.anchor = x[1 : 1 + 3 * n].reshape(3, n)
        self.known_start, self.known_count = x[1 + 3 * n :].reshape(2, -1)
        self.info = info


def _row(chunk: int, round_: int, found: bytes) -> pa.Table:
    return pa.table({"chunk": pa.array([chunk], pa.int64()), "bucket": pa.array([0], pa.int64()), "round": pa.array([round_], pa.int32()), "found": pa.array([found], pa.binary())})


def _place(chunk: int, at: np.ndarray) -> np.ndarray:
    """One number per byte of the corpus."""
    return (np.int64(chunk) << np.int64(36)) + at


def _anchor_code(first: np.ndarray, v: list[np.ndarray]) -> np.ndarray:
    """From the least block (lowest bit: the chunk has two runs) and the greatest block of each chunk."""
    entries = np.diff(np.append(first, len(v[0])))
    again = (np.maximum.reduceat(v[0] & 1, first) > 0) | (entries > 1)
    return np.where(np.minimum.reduceat(v[0] & ~np.int64(1), first) != np.maximum.reduceat(v[1], first), 2, again)


def _block_code(first: np.ndarray, v: list[np.ndarray]) -> np.ndarray:
    """Twice the first place of the block, plus one if there is another."""
    return 2 * np.minimum.reduceat(v[0], first) + (np.add.reduceat(v[1], first) > 1)


def _again(first: np.ndarray, v: list[np.ndarray]) -> np.ndarray:
    return (np.add.reduceat(v[0], first) > 1).astype(np.int64)


def _grouped(keys: np.ndarray, *values: np.ndarray):
    """Sort by key (values follow, ascending inside a key) and give the first places of the groups."""
    order = np.lexsort([*values[::-1], keys])
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], first, [v[order] for v in values], np.diff(np.append(first, len(keys)))


def _step3_windows(t: pa.Table, plan: Plan, window: int):
    """Per slice of the text: (starts of the windows of step 3, their hashes, run of each, the bytes, first byte)."""
    base = 0
    for _, _, raw, off in slices(t.column("text"), STEP_BYTES):
        k = np.flatnonzero((plan.start >= base) & (plan.start < base + len(raw)))
        if len(k):
            n = plan.count[k]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(plan.start[k] - base, n)
            yield at, range_hash(byte_sums(raw), at, at + window), np.repeat(k, n), raw, base
        base += len(raw)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of `docs` (doc_id, text): every byte covered by a window
    that also starts anywhere else, in the same document too, is removed; all windows are judged on the input.

    Null or empty text: no bytes. Rows are documents of their own, also if doc_ids repeat or are null. Other columns are
    ignored; an empty table gives no rows."""
    if window <= GRAM:
        raise ValueError(f"window must be above {GRAM}")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_bytes = lookup.text_bytes(src)
    dealt = lookup.deal(src, n_bytes, CHUNK_BYTES)
    buckets = max(1, n_bytes // (32 * lookup.BUCKET_KEYS))
    window_buckets = max(1, n_bytes // (8 * lookup.BUCKET_KEYS))
    meetings = max(1, n_bytes // BUCKET_BYTES)
    none = np.zeros(0, np.uint64)

    def runs(t):
        return _row(t.column("chunk")[0].as_py(), _RUNS, lookup.pack(_runs(_sorted(t), window).reshape(-1)))

    def ask_anchors(t):
        c = Chunk(t)
        # a run that may repeat itself counts as another block, 0, so that its windows are looked at
        keys, first, (block,), size = _grouped(np.concatenate([c.anchor, c.anchor[c.twice]]), np.concatenate([c.block, np.zeros(c.twice.sum(), np.int64)]))
        last = first + size - 1
        return lookup.ask_table(c.number, keys, [block[first] | (size > 1), block[last]], buckets)

    def ask_blocks(t, info):
        if not t.num_rows:
            return lookup.ask_table(0, none, [], buckets)
        c = Chunk(t)
        k, key = c.blocks(info)
        keys, first, (place,), size = _grouped(key, _place(c.number, c.start[k]))
        return lookup.ask_table(c.number, keys, [place[first], size], buckets)

    def plan(t, info):
        if not t.num_rows:
            return _row(0, _PLAN, lookup.pack(np.zeros(1, np.int64))).slice(0, 0)
        c = Chunk(t)
        known, standing = c.repeated_runs(info)
        parts = [np.array([len(standing)], np.int64), c.start[standing], c.count[standing], c.anchor[standing].view(np.int64), c.start[known], c.count[known]]
        return _row(c.number, _PLAN, lookup.pack(np.concatenate(parts)))

    def ask_windows(t, info):
        if not t.num_rows:
            return lookup.ask_table(0, none, [], window_buckets)
        hashes = [h for _, h, _, _, _ in _step3_windows(_sorted(t), Plan(info), window)]
        keys, count = np.unique(np.concatenate(hashes) if hashes else none, return_counts=True)
        return lookup.ask_table(t.column("chunk")[0].as_py(), keys, [count], window_buckets)

    def stretches(t, info):
        """Stretches of step 3 for the buckets."""
        rows: list[tuple] = []
        if t.num_rows:
            chunk, todo = t.column("chunk")[0].as_py(), Plan(info)
            parts = list(_step3_windows(_sorted(t), todo, window))
            keys = np.unique(np.concatenate([p[1] for p in parts])) if parts else none
            again = lookup.answers_of(info, _WINDOWS)
            for at, h, run, raw, base in parts:
                ok = again[np.searchsorted(keys, h)] > 0
                at, run = at[ok], run[ok]
                if len(at):
                    cut = np.flatnonzero((np.diff(at) != 1) | (run[1:] != run[:-1])) + 1
                    body = raw.tobytes()
                    for a, z in zip(np.concatenate([[0], cut]).tolist(), np.concatenate([cut, [len(at)]]).tolist()):
                        piece = body[int(at[a]) : int(at[z - 1]) + window]
                        meet = int(mix(todo.anchor[run[a] : run[a] + 1].view(np.uint64))[0] % np.uint64(meetings))
                        rows.append((chunk, int(at[a]) + base, meet, hashlib.blake2b(piece, digest_size=16).digest(), piece))
        cols = list(zip(*rows)) if rows else [()] * 5
        return pa.table({k: pa.array(v, ty) for k, v, ty in zip(("chunk", "at", "meet", "digest", "piece"), cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))})

    def meet(t):
        """Repeated windows of the different stretches of a bucket; those with several copies are repeated whole."""
        digest, piece, copies = (t.column(k).to_pylist() for k in ("digest", "piece", "copies"))
        got = bwt.repeated_windows(piece, window)
        out = [np.arange(len(p) - window + 1) if n > 1 else g for p, n, g in zip(piece, copies, got)]
        ranges = []
        for x in out:
            cut = np.flatnonzero(np.diff(x) != 1) + 1
            lo, hi = (x[np.concatenate([[0], cut])], x[np.concatenate([cut - 1, [len(x) - 1]])]) if len(x) else (x, x)
            ranges.append(lookup.pack(np.concatenate([lo, hi - lo + 1]).astype(np.int64)))
        return pa.table({"meet": t.column("meet"), "digest": pa.array(digest, pa.binary()), "ranges": pa.array(ranges, pa.binary())})

    def finish(t, info):
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        ids = pa.array([], pa.int64())
        if t.num_rows:
            t = _sorted(t)
            ids = t.column("doc_id")
            done = Plan(info)
            starts, counts = [done.known_start], [done.known_count]
            for r, at, b in zip(*(info.column(k).to_pylist() for k in ("round", "bucket", "found"))):
                if r == _FOUND:
                    lo, n = lookup.unpack(b).reshape(2, -1)
                    starts.append(lo + at)
                    counts.append(n)
            starts, counts = np.concatenate(starts), np.concatenate(counts)
            base = 0
            for _, _, raw, off in slices(t.column("text"), STEP_BYTES):
                k = (starts >= base) & (starts < base + len(raw))
                edge = np.zeros(len(raw) + 1, np.int32)
                np.add.at(edge, starts[k] - base, 1)
                np.add.at(edge, starts[k] - base + counts[k] + window - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept, rest = raw[~gone].tobytes(), np.concatenate([[0], np.cumsum(~gone)])
                first = gone.copy()
                first[1:] &= ~gone[:-1]
                heads = off[:-1][off[:-1] < len(raw)]
                first[heads] = gone[heads]
                spans = np.concatenate([[0], np.cumsum(first)])
                for a, z in zip(off[:-1].tolist(), off[1:].tolist()):
                    out["n_bytes"].append(z - a)
                    out["n_removed"].append(z - a - int(rest[z] - rest[a]))
                    out["n_spans"].append(int(spans[z] - spans[a]))
                    out["kept_sha256"].append(hashlib.sha256(kept[rest[a] : rest[z]]).hexdigest())
                base += len(raw)
        types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
        return pa.table({"doc_id": ids, **{k: pa.array(v, types[k]) for k, v in out.items()}})

    by_chunk = dealt.groupBy("chunk")
    found_runs = by_chunk.applyInArrow(runs, lookup.ANSWER)
    by_run = found_runs.groupBy("chunk")
    anchors = lookup.answer(by_run.applyInArrow(ask_anchors, lookup.ASK), _anchor_code, _ANCHORS)
    blocks = lookup.answer(by_run.cogroup(anchors.groupBy("chunk")).applyInArrow(ask_blocks, lookup.ASK), _block_code, _BLOCKS)
    info = by_run.cogroup(anchors.unionByName(blocks).groupBy("chunk")).applyInArrow(plan, lookup.ANSWER)
    windows = lookup.answer(by_chunk.cogroup(info.groupBy("chunk")).applyInArrow(ask_windows, lookup.ASK), _again, _WINDOWS)
    sent = by_chunk.cogroup(info.unionByName(windows).groupBy("chunk")).applyInArrow(stretches, "chunk long, at long, meet long, digest binary, piece binary")
    different = sent.groupBy("meet", "digest").agg(F.first("piece").alias("piece"), F.count(F.lit(1)).alias("copies"))
    found = different.groupBy("meet").applyInArrow(meet, "meet long, digest binary, ranges binary")
    back = sent.select("chunk", "at", "meet", "digest").join(found, ["meet", "digest"])
    back = back.select("chunk", F.col("at").alias("bucket"), F.lit(_FOUND).alias("round"), F.col("ranges").alias("found"))
    return by_chunk.cogroup(info.unionByName(back).groupBy("chunk")).applyInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
