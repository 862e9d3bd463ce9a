"""Removal of repeated passages with Aho-Corasick automata.

1. Confirm recurring passages. A window is `window` consecutive words. Every window names its anchor, the smallest hash of
   the GRAM-word grams inside it: equal windows have equal anchors, and neighbouring windows mostly share theirs. Windows
   whose anchor occurs in two documents are hashed whole; those that occur in two documents are recurring, and belong to
   their first document (smallest doc_id). Maximal runs of a document's own recurring windows are the passages.
2. Compile. Passages are dealt into shards by their document. A shard's automaton (pyahocorasick, over word numbers) holds
   a GRAM-word gram at every (window - GRAM + 1)-th word of each passage and at its end, so every window of a passage
   holds one of them whole.
3. Stream. Every stretch of recurring windows of a later document goes through the automaton of its first document's
   shard. Each gram found is extended both ways, word by word, along the passage; matches of at least `window` words are
   occurrences, confirmed on the words themselves. Hot shards are streamed by many tasks, each with the shard's passages.

Documents without a window that recurs cannot hold a passage and are finished in step 1."""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lookup
from .common import NOT_SPACE, mix, prefix_sums, range_hash, slices, spans, stored, utf8, word_hashes

WINDOW, GRAM = 50, 25
#: Text bytes of stretches that one task streams through a shard's automaton.
STREAM_BYTES = 16 << 20


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    m, k = x, 1
    while 2 * k <= w:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return np.minimum(m[:n], m[w - k : w - k + n])


class Chunk:
    """Words, windows and anchors of a chunk's documents."""

    def __init__(self, t: pa.Table, window: int):
        self.window = window
        self.ids = t.column("doc_id").to_pylist()
        self.text = t.column("text").combine_chunks()
        hashes, firsts, n = [], [np.zeros(1, np.int64)], 0
        for _, _, raw, off in slices(self.text):
            s, e, first = spans(raw, off, NOT_SPACE)
            hashes.append(word_hashes(raw, s, e))
            firsts.append(first[1:] + n)
            n += len(s)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.concatenate(firsts)
        length = np.diff(self.first)
        # starts of the windows of documents that have an id
        has = np.array([i is not None for i in self.ids], bool)
        count = np.where(has, np.maximum(length - window + 1, 0), 0)
        self.row = np.repeat(np.arange(len(length)), count)
        self.at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.first[:-1][self.row]
        self.doc = np.array([i or 0 for i in self.ids], np.int64)[self.row]
        self.sums = prefix_sums(self.words)
        if len(self.at):
            all_ = np.arange(len(self.words) - GRAM + 1)
            self.anchor = sliding_min(range_hash(self.sums, all_, all_ + GRAM), window - GRAM + 1)[self.at]
        else:
            self.anchor = np.zeros(0, np.uint64)

    def ask(self, h: np.ndarray, doc: np.ndarray):
        """(sorted distinct keys, least and greatest document of each)."""
        order = np.lexsort([doc, h])
        h, doc = h[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(h)) - 1 if len(h) else first
        return h[first], doc[first], doc[last]

    def ask_anchors(self):
        return self.ask(self.anchor, self.doc)

    def likely(self, found: np.ndarray):
        """Windows whose anchor occurs in two documents."""
        keys = np.unique(self.anchor)
        w = np.flatnonzero(found[np.searchsorted(keys, self.anchor)] > 0) if len(keys) else np.zeros(0, np.int64)
        return w, range_hash(self.sums, self.at[w], self.at[w] + self.window)

    def byte_spans(self, row: int) -> tuple[bytes, np.ndarray, np.ndarray]:
        raw, off = utf8(self.text.slice(row, 1))
        s, e, _ = spans(raw, off, NOT_SPACE)
        return raw.tobytes(), s, e


def _runs(at: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Index ranges of consecutive positions with the same label."""
    if not len(at):
        return []
    cut = np.flatnonzero((np.diff(at) != 1) | (label[1:] != label[:-1])) + 1
    b = np.concatenate([[0], cut, [len(at)]])
    return list(zip(b[:-1].tolist(), b[1:].tolist()))


def _two_docs(first: np.ndarray, v: list[np.ndarray]) -> np.ndarray:
    return (np.minimum.reduceat(v[0], first) != np.maximum.reduceat(v[1], first)).astype(np.int64)


def _first_doc(first: np.ndarray, v: list[np.ndarray]) -> np.ndarray:
    """Documents times two, plus one if there is a second document."""
    low = np.minimum.reduceat(v[0], first)
    return 2 * low + (low != np.maximum.reduceat(v[1], first))


_PART = "kind int, shard long, chunk long, row long, doc_id long, at long, text string, n_words long, n_removed long, kept string"


def _confirm(docs: DataFrame, window: int) -> DataFrame:
    """Step 1, stored: kind 0 passages (shard, doc_id, text), 1 stretches (shard, chunk, row, doc_id, at, text),
    2 whole documents that have stretches (chunk, row, doc_id, text), 3 finished documents."""
    n_bytes = lookup.text_bytes(docs)
    dealt = lookup.deal(docs, n_bytes)
    buckets = max(1, n_bytes // (6 * lookup.BUCKET_KEYS))
    shards = max(1, n_bytes // lookup.CHUNK_BYTES)

    def ask_anchors(t):
        c = Chunk(t, window)
        keys, low, high = c.ask_anchors()
        return lookup.ask_table(t.column("chunk")[0].as_py(), keys, [low, high], buckets)

    anchors = lookup.answer(dealt.groupBy("chunk").applyInArrow(ask_anchors, lookup.ASK), _two_docs, 1)

    def ask_windows(t, found):
        if not t.num_rows:
            return lookup.ask_table(0, np.zeros(0, np.uint64), [], buckets)
        c = Chunk(t, window)
        w, h = c.likely(lookup.answers_of(found, 1))
        keys, low, high = c.ask(h, c.doc[w])
        return lookup.ask_table(t.column("chunk")[0].as_py(), keys, [low, high], buckets)

    windows = lookup.answer(dealt.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(ask_windows, lookup.ASK), _first_doc, 2)
    answers = anchors.unionByName(windows)

    def split(t, found):
        rows: list[tuple] = []
        if t.num_rows:
            c = Chunk(t, window)
            chunk = t.column("chunk")[0].as_py()
            w, h = c.likely(lookup.answers_of(found, 1))
            keys = np.unique(h)
            got = lookup.answers_of(found, 2)
            got = got[np.searchsorted(keys, h)] if len(keys) else got
            owner, again = got >> 1, (got & 1) > 0
            w, owner = w[again], owner[again]
            row, at = c.row[w], c.at[w] - c.first[:-1][c.row[w]]
            own = owner == c.doc[w]
            shard = (mix(owner.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
            where = np.searchsorted(row, np.arange(len(c.ids) + 1))
            length = np.diff(c.first)
            for r, doc_id in enumerate(c.ids):
                a, z = where[r], where[r + 1]
                n = int(length[r])
                mine = own[a:z]
                raw, s, e = c.byte_spans(r)
                words = [raw[x:y] for x, y in zip(s.tolist(), e.tolist())]
                if z > a:
                    for kind, sel in ((0, np.flatnonzero(mine)), (1, np.flatnonzero(~mine))):
                        pos, sh = at[a:z][sel], shard[a:z][sel]
                        for x, y in _runs(pos, sh):
                            lo, hi = int(pos[x]), int(pos[y - 1]) + window
                            rows.append((kind, int(sh[x]), chunk, r, doc_id, lo, b" ".join(words[lo:hi]).decode(), None, None, None))
                kept = b" ".join(words)
                if z > a and not mine.all():
                    rows.append((2, None, chunk, r, doc_id, None, kept.decode(), None, None, None))
                else:
                    rows.append((3, None, chunk, r, doc_id, None, None, n, 0, hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows)) if rows else [()] * 10
        types = (pa.int32(), *[pa.int64()] * 5, pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table({f.split()[0]: pa.array(v, k) for f, v, k in zip(_PART.split(", "), cols, types)})

    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(split, _PART)
    return stored(out, "passages")


class Passages:
    """The automaton of a shard's passages."""

    def __init__(self, texts: list[str], window: int):
        self.window = window
        self.words = [t.split(" ") for t in texts]
        self.vocab: dict[str, int] = {}
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        stride = window - GRAM + 1
        seeds: dict[tuple, list[tuple[int, int]]] = {}
        for k, ws in enumerate(self.words):
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws]
            for o in dict.fromkeys([*range(0, len(ws) - GRAM + 1, stride), len(ws) - GRAM]):
                seeds.setdefault(tuple(ids[o : o + GRAM]), []).append((k, o))
        for key, places in seeds.items():
            self.machine.add_word(key, places)
        if seeds:
            self.machine.make_automaton()
        self.any = bool(seeds)

    def find(self, text: str) -> list[tuple[int, int]]:
        """Word ranges of `text` that are occurrences of `window` or more words of a passage."""
        ws = text.split(" ")
        if not self.any or len(ws) < self.window:
            return []
        ids = tuple(self.vocab.get(w, 0) for w in ws)
        done: dict[tuple[int, int], int] = {}  # alignment with a passage -> end of the match seen
        out = []
        for last, places in self.machine.iter(ids):
            p = last - GRAM + 1
            for k, o in places:
                line = (k, p - o)
                if done.get(line, 0) > last:
                    continue
                ref = self.words[k]
                a, b = p, o
                while a > 0 and b > 0 and ws[a - 1] == ref[b - 1]:
                    a, b = a - 1, b - 1
                z, y = last + 1, o + GRAM
                while z < len(ws) and y < len(ref) and ws[z] == ref[y]:
                    z, y = z + 1, y + 1
                done[line] = z
                if z - a >= self.window:
                    out.append((a, z))
        return out


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of `docs` (doc_id, text): every word covered by a window that
    also occurs in a document with a smaller doc_id is removed.

    Null or empty text: no words. A row without doc_id loses nothing and is nobody's earlier document; rows that repeat a
    doc_id don't remove from each other. Other columns are ignored."""
    if window < GRAM:
        raise ValueError(f"window must be at least {GRAM}")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = _confirm(src, window)

    def part(kind: int) -> DataFrame:
        return parts.where(F.col("kind") == kind).toDF(*parts.columns)

    passages, stretches = part(0), part(1)
    load = stretches.groupBy("shard").agg(F.ceil(F.sum(F.octet_length("text")) / STREAM_BYTES).cast("long").alias("tasks"))
    sent = passages.select("shard", "text").join(load, "shard").withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1))).select("shard", "task", "text")
    asked = stretches.select("shard", "chunk", "row", "at", "text").join(load, "shard").withColumn("task", F.pmod(F.xxhash64("chunk", "row", "at"), F.col("tasks"))).select("shard", "task", "chunk", "row", "at", "text")

    def stream(stretch, passage):
        m = Passages(passage.column("text").to_pylist(), window)
        rows = []
        for chunk, row, at, text in zip(*(stretch.column(c).to_pylist() for c in ("chunk", "row", "at", "text"))):
            rows += [(chunk, row, at + a, at + z) for a, z in m.find(text)]
        cols = list(zip(*rows)) if rows else [()] * 4
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("chunk", "row", "a", "z"), cols)})

    found = asked.groupBy("shard", "task").cogroup(sent.groupBy("shard", "task")).applyInArrow(stream, "chunk long, row long, a long, z long")

    def finish(whole, hits):
        n = whole.num_rows
        out = {"doc_id": whole.column("doc_id") if n else pa.array([], pa.int64()), "n_words": [], "n_removed": [], "kept_sha256": []}
        marks: dict[int, list[tuple[int, int]]] = {}
        for row, a, z in zip(*(hits.column(c).to_pylist() for c in ("row", "a", "z"))):
            marks.setdefault(row, []).append((a, z))
        for row, text in zip(whole.column("row").to_pylist(), whole.column("text").to_pylist()):
            ws = text.split(" ")
            gone = np.zeros(len(ws), bool)
            for a, z in marks.get(row, ()):
                gone[a:z] = True
            out["n_words"].append(len(ws))
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(" ".join(w for w, g in zip(ws, gone) if not g).encode()).hexdigest())
        types = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
        return pa.table({k: pa.array(v, types[k]) if k in types else v for k, v in out.items()})

    whole = part(2).select("chunk", "row", "doc_id", "text")
    cut = whole.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    rest = part(3).select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
    return rest.unionByName(cut)
