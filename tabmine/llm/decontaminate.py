"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' word sequences form one automaton (states, suffix links, transitions by word). Documents are streamed through
it: at every word the longest item passage ending there is known. A passage of `window` words or more, or a whole shorter
item, marks its words as hit. The automaton is sent with the tasks only while the items stay below `MAX_ITEM_WORDS`;
more items are dealt into shards, each an automaton and a pass of its own, and the spans of a document are united."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, shielded, slices, spans, stored, tidy, utf8, word_hashes

#: Item words of one automaton (about 1 KB each in a task).
MAX_ITEM_WORDS = 50_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Automaton:
    """Generalised suffix automaton over word sequences, with the items of every window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        seqs = []
        for item, words in items:
            if words:
                seqs.append((item, [self.vocab.setdefault(w, len(self.vocab)) for w in words]))
        for _, seq in seqs:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self._annotate(seqs)
        pairs = {(a, b) for _, seq in seqs for a, b in zip(seq, seq[1:])}
        self.pairs = np.array(sorted(a * len(self.vocab) + b for a, b in pairs), np.int64)
        self.least = min([window, *(len(s) for _, s in seqs)])
        words = list(self.vocab)
        raw = np.frombuffer(b"".join(words), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        h = word_hashes(raw, off[:-1], off[1:]) if words else np.zeros(0, np.uint64)
        order = np.argsort(h)
        self.hashes, self.ids = h[order], order.astype(np.int64)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length

        def clone_for(p: int, q: int) -> int:
            if length[p] + 1 == length[q]:
                return q
            new = len(nxt)
            nxt.append(dict(nxt[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            link[q] = new
            while p >= 0 and nxt[p].get(c) == q:
                nxt[p][c] = new
                p = link[p]
            return new

        if c in nxt[last]:
            return clone_for(last, nxt[last][c])
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            link[cur] = clone_for(p, nxt[p][c])
        return cur

    def _annotate(self, seqs: list[tuple[str, list[int]]]) -> None:
        """win[v]: the state of the last `window` words of v's strings; items[u]: items that hold that window;
        short[v]: (length, item) of whole shorter items that end v's strings."""
        n = len(self.next)
        order = sorted(range(1, n), key=self.length.__getitem__)
        self.win = [-1] * n
        for v in order:
            if self.length[v] >= self.window:
                up = self.win[self.link[v]]
                self.win[v] = up if up >= 0 else v
        self.items: dict[int, set[str]] = {}
        ends: dict[int, list[tuple[int, str]]] = {}
        for item, seq in seqs:
            v = 0
            for c in seq:
                v = self.next[v][c]
                if self.win[v] >= 0:
                    self.items.setdefault(self.win[v], set()).add(item)
            if len(seq) < self.window:
                ends.setdefault(v, []).append((len(seq), item))
        self.short: list[tuple[tuple[int, str], ...]] = [()] * n
        for v in order:
            self.short[v] = tuple(ends.get(v, ())) + self.short[self.link[v]]

    def walk(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges [first, last) and items, of one word sequence."""
        hits, items, v, n = [], set(), 0, 0
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for j, w in enumerate(words):
            c = self.vocab.get(w, -1)
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v, n = nxt[v][c], n + 1
            else:
                v = n = 0
            if n >= window:
                hits.append((j + 1 - window, j + 1))
                items |= self.items[self.win[v]]
            for k, item in self.short[v]:
                if n >= k:
                    hits.append((j + 1 - k, j + 1))
                    items.add(item)
        return hits, items

    def match(self, raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, set[str]]]:
        """Per text: number of words, byte starts and ends of the words, hit flags, items."""
        low = LOWER[raw]
        ws, we, first = spans(low, off, ALNUM)
        n = len(ws)
        wid = np.full(n, -1, np.int64)
        if n and len(self.hashes):
            h = word_hashes(low, ws, we)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            known = self.hashes[at] == h
            wid[known] = self.ids[at[known]]
        live = wid >= 0
        if self.least >= 2 and n:  # only stretches of words that follow each other in an item can match
            pair = np.zeros(n, bool)
            both = np.flatnonzero(live[:-1] & live[1:])
            code = wid[both] * len(self.vocab) + wid[both + 1]
            if len(self.pairs):
                at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
                pair[both[self.pairs[at] == code]] = True
            pair[first[first > 0] - 1] = False  # not across texts
            live = pair.copy()
            live[1:] |= pair[:-1]
            joined = pair
        else:
            joined = np.zeros(n, bool)
            joined[:-1] = live[:-1] & live[1:]
        body = low.tobytes()
        hit = np.zeros(n, bool)
        found: dict[int, set[str]] = {}
        if live.any():
            # stretches: maximal runs where each word is joined to the next, inside one text
            cut = np.ones(n + 1, bool)
            cut[1:n] = ~joined[:-1]
            cut[first] = True
            b = np.flatnonzero(cut)
            run_s, run_e = b[:-1], b[1:]
            keep = (run_e - run_s >= self.least) & live[np.minimum(run_s, n - 1)]
            run_s, run_e = run_s[keep], run_e[keep]
            doc = np.searchsorted(first, run_s, "right") - 1
            for s, e, d in zip(run_s.tolist(), run_e.tolist(), doc.tolist()):
                got, items = self.walk([body[ws[k] : we[k]] for k in range(s, e)])
                if items:
                    found.setdefault(d, set()).update(items)
                    for x, y in got:
                        hit[s + x : s + y] = True
        for d in range(len(off) - 1):
            a, z = first[d], first[d + 1]
            yield z - a, ws[a:z], we[a:z], hit[a:z], found.get(d, set())


def _words(text: str | None) -> list[bytes]:
    raw, off = utf8(pa.array([text], pa.large_string()))
    low = LOWER[raw]
    s, e, _ = spans(low, off, ALNUM)
    b = low.tobytes()
    return [b[x:y] for x, y in zip(s.tolist(), e.tolist())]


def automata(benchmark: DataFrame, window: int, max_words: int = MAX_ITEM_WORDS) -> Iterator[Automaton]:
    """One automaton per shard of at most about `max_words` item words, built from one shard's items at a time."""
    words = F.regexp_count(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), F.lit(WORD))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(words.cast("long"))).first()[0] or 0
    shards = max(1, -(-int(total) // max_words))
    for k in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)
        yield Automaton([(r["item_id"], _words(r["text"])) for r in part.collect() if r["item_id"] is not None], window)


_FOUND = "__n_words long, __n_hit long, __hits array<long>, __items array<string>"


def _locate(docs: DataFrame, model: Automaton, first: bool, last_columns: list[str], max_coverage: float | None = None) -> DataFrame:
    """One pass: adds the hit word ranges (flat starts and ends) and items of `model` to those of earlier passes.
    With `max_coverage`, hit words leave the text and documents with more of them hit leave the table."""
    at, n_in = docs.columns.index("text"), len(docs.columns)
    out = [c for c in docs.columns if c in last_columns]
    places = [docs.columns.index(c) for c in out]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in out)
    counted = out.index("n_chars") if max_coverage is not None and "n_chars" in out else None

    def run(batches):
        for b in batches:
            for i, j, raw, off in slices(b.column(at)):
                part = b.slice(i, j - i)
                old_hits = part.column(n_in - 2).to_pylist() if not first else [[]] * (j - i)
                old_items = part.column(n_in - 1).to_pylist() if not first else [[]] * (j - i)
                n_words, n_hit, ranges, items, texts = [], [], [], [], {}
                body = raw.tobytes()
                for d, ((n, ws, _, hit, got), before, known) in enumerate(zip(model.match(raw, off), old_hits, old_items)):
                    for a, z in zip(before[::2], before[1::2]):
                        hit[a:z] = True
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).tolist()
                    n_words.append(int(n))
                    n_hit.append(int(hit.sum()))
                    ranges.append(edge)
                    items.append(sorted(got.union(known)))
                    if edge and max_coverage is not None:
                        texts[d] = _without(body, ws, edge, int(off[d]), int(off[d + 1]))
                cols = [part.column(k) for k in places]
                if texts:
                    changed = cols[out.index("text")].to_pylist()
                    for d, t in texts.items():
                        changed[d] = t
                    cols[out.index("text")] = pa.array(changed, pa.string())
                    if counted is not None:
                        sizes = cols[counted].to_pylist()
                        for d, t in texts.items():
                            sizes[d] = len(t)
                        cols[counted] = pa.array(sizes, cols[counted].type)
                if max_coverage is None:
                    cols += [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(ranges, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(cols, names=[*out, "__n_words", "__n_hit", "__hits", "__items"])
                else:
                    stays = [h <= max_coverage * n for h, n in zip(n_hit, n_words)]
                    yield pa.RecordBatch.from_arrays(cols, names=out).filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(tidy(run), fields if max_coverage is not None else f"{fields}, {_FOUND}")


def _without(body: bytes, starts: np.ndarray, ranges: list[int], begin: int, end: int) -> str:
    """The text of bytes [begin, end) without the words of the ranges, each gone up to the next word."""
    out, pos = [], begin
    for a, z in zip(ranges[::2], ranges[1::2]):
        out.append(body[pos : int(starts[a])])
        pos = int(starts[z]) if z < len(starts) else end
    out.append(body[pos:end])
    return b"".join(out).decode("utf-8")


def locate(docs: DataFrame, benchmark: DataFrame, window: int, keep: list[str], max_coverage: float | None = None) -> DataFrame:
    """`keep` columns of `docs` with __n_words, __n_hit, __hits, __items (or without the hit words). More than one automaton: one stored pass each,
    so that a task holds one at a time."""
    models = list(automata(benchmark, window))
    out = docs
    for k, m in enumerate(models):
        last = k == len(models) - 1
        if k:
            out = stored(out, "hits").select(*docs.columns, "__hits", "__items")
        out = _locate(out, m, k == 0, keep if last else docs.columns, max_coverage if last else None)
    return out


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of `docs` (doc_id, text).

    Null or empty text: no words. Items without words or without item_id never match; repeated items count once by
    item_id. Repeated documents are each a row. Further columns are ignored."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = locate(src, benchmark, window, ["doc_id"])
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("__items")), 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """The documents without benchmark passages: hit words go (with the bytes up to the next kept word), and a document
    with more than `max_coverage` of its words hit goes whole. Other columns stay; a column n_chars follows a changed text.
    Clean documents are returned unchanged, null texts too. Columns beside text and n_chars may have any name. An empty
    table gives no rows, an empty benchmark all of them."""
    inner = shielded(docs, "text", "n_chars")
    return locate(inner, benchmark, window, inner.columns, max_coverage).select(*inner.columns).toDF(*docs.columns)
