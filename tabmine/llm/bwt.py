"""Repeated windows of a collection of byte strings, from merged Burrows-Wheeler transforms of their parses.

Strings are cut into phrases after every TRIGGER bytes whose hash is 0 modulo MEAN; a phrase carries the TRIGGER bytes
before it, so no phrase is a proper prefix of another one and phrases can be compared on their own. With phrases ranked
by their bytes, a string becomes a short sequence of ranks. Each shard of strings gets the transform of its sequences;
two transforms are merged by refining their interleave (Holt and McMillan): if the rows are in the order of their first k
symbols, dealing them out by the symbol before them, stably, orders them by k + 1. Nothing is sorted from scratch. The
merged order gives the common prefix of neighbouring suffixes, hence the intervals of suffixes that agree on D bytes.

A window starts `a` bytes before the first suffix that lies whole in it; it is repeated if another suffix of the same
interval at depth window - a has the same `a` bytes before it."""

from __future__ import annotations

import numpy as np

from .common import byte_sums, mix, range_hash

TRIGGER, MEAN = 8, 16
#: Symbols of a shard whose transform is made by sorting.
SHARD_SYMBOLS = 1 << 15


def parse(raw: np.ndarray, off: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the phrases' suffixes, string of each, rank of each phrase from 1). The last phrase of a string ends with it."""
    n = len(raw)
    p = np.arange(TRIGGER, n + 1)
    hot = p[range_hash(sums, p - TRIGGER, p) % np.uint64(MEAN) == 0] - TRIGGER  # start of the trigger
    owner = np.searchsorted(off, hot, "right") - 1
    inside = hot + TRIGGER <= off[np.minimum(owner + 1, len(off) - 1)]
    t, owner = hot[inside], owner[inside]
    end = np.empty(len(t), np.int64)
    if len(t):
        same = np.append(owner[1:] == owner[:-1], False)
        end = np.where(same, np.append(t[1:], 0) + TRIGGER, off[owner + 1])
    body = raw.tobytes()
    phrases = [body[a:z] for a, z in zip(t.tolist(), end.tolist())]
    rank = {w: k for k, w in enumerate(sorted(set(phrases)), 1)}
    return t, owner, np.fromiter((rank[w] for w in phrases), np.int64, len(phrases))


def transform(rank: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, symbol before each suffix; 0 before the first of a string) of one shard, by prefix doubling."""
    n = len(rank)
    order_key, k = rank.copy(), 1
    while True:
        nxt = np.zeros(n, np.int64)
        if k < n:
            ok = owner[k:] == owner[:-k]
            nxt[:-k][ok] = order_key[k:][ok]
        order = np.lexsort([nxt, order_key])
        a, b = order_key[order], nxt[order]
        new = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))]) + 1 if n else a
        order_key = np.empty(n, np.int64)
        order_key[order] = new
        k *= 2
        if not n or new[-1] == n or k > n:
            break
    before = np.zeros(n, np.int64)
    if n > 1:
        before[1:] = np.where(owner[1:] == owner[:-1], rank[:-1], 0)
    return order, before[order]


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], last: tuple[np.ndarray, np.ndarray], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge two transforms (positions, symbols before). `last`: the rank of each shard's string ends, which are the only
    rows that no other row leads to: the empty suffixes before them are kept as a fixed block."""
    n1, n2 = len(a[1]), len(b[1])
    sym = np.concatenate([a[1], b[1]])  # rows of both shards; a row is known by its number here
    n_end = (len(last[0]), len(last[1]))
    # the empty suffix of each string is a row of its own, first in order, with the string's last phrase before it
    rows_sym = np.concatenate([last[0], last[1], sym])
    source = np.concatenate([np.zeros(n_end[0], np.int8), np.ones(n_end[1], np.int8), np.zeros(n1, np.int8), np.ones(n2, np.int8)])
    m = n_end[0] + n_end[1]
    # symbols of each source in its own order: ends first, then its suffixes
    own = [np.concatenate([last[0], a[1]]), np.concatenate([last[1], b[1]])]
    z = source
    for _ in range(steps):
        s = np.empty(len(z), np.int64)
        one = z == 1
        s[~one], s[one] = own[0], own[1]
        live = np.flatnonzero(s > 0)
        new = np.concatenate([z[:m], z[live[np.argsort(s[live], kind="stable")]]])
        if np.array_equal(new, z):
            break
        z = new
    tail = z[m:]
    one = tail == 1
    pos, before = np.empty(n1 + n2, np.int64), np.empty(n1 + n2, np.int64)
    pos[~one], pos[one] = a[0], b[0]
    before[~one], before[one] = a[1], b[1]
    return pos, before


def suffix_order(rank: np.ndarray, owner: np.ndarray, steps: int) -> np.ndarray:
    """Numbers of the phrases in the order of the suffixes that start with them, right to `steps` symbols."""
    n = len(rank)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
    # shards of whole strings
    shard = np.zeros(len(ends), np.int64)
    shard[1:] = ends[:-1] // SHARD_SYMBOLS
    parts = []
    for k in np.unique(shard):
        mine = np.flatnonzero(shard == k)
        lo = 0 if mine[0] == 0 else int(ends[mine[0] - 1]) + 1
        hi = int(ends[mine[-1]]) + 1
        order, before = transform(rank[lo:hi], owner[lo:hi])
        parts.append(((order + lo, before), rank[ends[mine]]))
    while len(parts) > 1:
        merged = []
        for i in range(0, len(parts) - 1, 2):
            (x, ex), (y, ey) = parts[i], parts[i + 1]
            merged.append((merge(x, y, (ex, ey), steps), np.concatenate([ex, ey])))
        parts = merged + parts[len(parts) - len(parts) % 2 :]
    return parts[0][0][0]


def common_prefixes(raw: np.ndarray, t: np.ndarray, room: np.ndarray, limit: int) -> np.ndarray:
    """Bytes in common of each suffix with the one before it, up to `limit`; 0 for the first."""
    padded = np.concatenate([raw, np.zeros(limit + 16, np.uint8)])
    out = np.zeros(len(t), np.int64)
    if len(t) < 2:
        return out
    live = np.arange(1, len(t))
    got = np.zeros(len(t), np.int64)
    lanes = np.arange(8)
    for k in range(0, limit, 8):
        x = padded[t[live - 1, None] + k + lanes] != padded[t[live, None] + k + lanes]
        miss = x.any(1)
        got[live] = np.where(miss, k + x.argmax(1), k + 8)
        live = live[~miss]
        if not len(live):
            break
    out[1:] = np.minimum(got[1:], np.minimum(room[1:], room[:-1]))
    return np.minimum(out, limit)


def repeated_windows(strings: list[bytes], window: int) -> list[np.ndarray]:
    """For each string, the starts of its windows that also start elsewhere in the collection."""
    raw = np.frombuffer(b"".join(strings), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    sums = byte_sums(raw)
    t, owner, rank = parse(raw, off, sums)
    order = suffix_order(rank, owner, window + 1)
    ts, os_ = t[order], owner[order]
    lcp = common_prefixes(raw, ts, off[os_ + 1] - ts, window)
    # bytes between a suffix and the one before it in its string (or the string's start)
    gap = t - np.where(np.append(False, owner[1:] == owner[:-1]) if len(t) else np.zeros(0, bool), np.append(0, t[:-1]) if len(t) else t, off[owner] - 1 if len(t) else t)
    gs, start = gap[order], off[os_]
    found, seen = [], np.zeros(len(raw), bool)
    for a in range(0, window - TRIGGER + 1):
        s = ts - a
        ok = np.flatnonzero((gs > a) & (s >= start) & (s + window <= off[os_ + 1]))
        if not len(ok):
            if not (gs > a).any():
                break
            continue
        interval = np.cumsum(lcp < window - a)
        key = mix(interval[ok].astype(np.uint64)) + range_hash(sums, s[ok], ts[ok])
        seen[s[ok]] = True
        _, inv, count = np.unique(key, return_inverse=True, return_counts=True)
        found.append(s[ok][count[inv] > 1])
    # windows without any trigger: too regular to be cut, compared whole
    at = np.arange(len(raw))
    owner_at = np.repeat(np.arange(len(strings)), np.diff(off))
    rest = np.flatnonzero(~seen & (at + window <= off[owner_at + 1]))
    if len(rest):
        _, inv, count = np.unique(range_hash(sums, rest, rest + window), return_inverse=True, return_counts=True)
        found.append(rest[count[inv] > 1])
    flat = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    cut = np.searchsorted(flat, off)
    return [flat[cut[k] : cut[k + 1]] - off[k] for k in range(len(strings))]
