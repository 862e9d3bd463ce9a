"""Product codes of vectors, learned by a dual-tree form of Lloyd's rounds on whole numbers.

Vectors become floor(4096 x) and are cut into 8 parts. Every block of rows builds one tree a part position (median splits on
the widest coordinate; nodes keep their bounding box, size and coordinate sums) and writes it once in the shared folder. A
round builds a like tree over the entries and walks both down together: an entry node stays a candidate of a node of rows
while its nearest box distance is not above the least farthest distance of the others, and of single entries one goes when
another is closer (or as close, with a lower index) everywhere in the box. A node with one candidate left is assigned whole
by its cached size and sums. Leaves with several candidates compare whole-number distances. All bounds are whole numbers, so
nothing is rounded. Only sums per (part, entry, coordinate) leave a task."""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tidy

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK_ROWS, LEAF_ROWS = 4096, 16
#: Sums travel as digits of this many bits, so that tasks' sums add up in long columns whatever their size.
LIMB = 40


def whole(x: np.ndarray) -> np.ndarray:
    """floor(4096 x): int64 where that is exact, Python integers beyond."""
    top = float(np.abs(x).max()) if x.size else 0.0
    if top * SCALE < 2**62:
        return np.floor(x * SCALE).astype(np.int64)
    return np.array([int(v) * SCALE if abs(v) >= 2**53 else int(np.floor(v * SCALE)) for v in x.ravel().tolist()], object).reshape(x.shape)


def _compact(x: np.ndarray) -> np.ndarray:
    """The smallest signed integer type that holds all values."""
    if x.dtype == object or not x.size:
        return x
    low, high = int(x.min()), int(x.max())
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _wide(*arrays: np.ndarray) -> type:
    """int64 where every box distance and difference of squares is proven to fit, else Python integers."""
    top = max((max(abs(int(a.min())), abs(int(a.max()))) for a in arrays if a.size), default=0)
    dims = max(a.shape[1] for a in arrays)
    return np.int64 if 8 * max(dims, 1) * (top + 1) ** 2 < 2**62 else object


@dataclass
class Tree:
    """A balanced binary tree over rows: `order` are the rows in leaf order; node i of level l holds the places
    cuts(l)[i] to cuts(l)[i + 1] of that order."""

    rows: np.ndarray  # in leaf order
    order: np.ndarray
    depth: int

    def cuts(self, level: int) -> np.ndarray:
        return len(self.rows) * np.arange((1 << level) + 1) // (1 << level)


def plant(rows: np.ndarray, leaf: int) -> Tree:
    n, depth = len(rows), 0
    while n > leaf << depth:
        depth += 1
    tree, order = Tree(rows, np.arange(n), depth), np.arange(n)
    for level in range(depth if rows.shape[1] else 0):
        cuts, halves = tree.cuts(level), tree.cuts(level + 1)
        for i in range(1 << level):
            a, m, b = cuts[i], halves[2 * i + 1], cuts[i + 1]
            if a < m < b:
                own = rows[order[a:b]]
                widest = int(np.argmax(own.max(0) - own.min(0)))
                order[a:b] = order[a:b][np.argsort(own[:, widest], kind="stable")]
    return Tree(rows[order], order, depth)


def _levels(tree: Tree, kind: type) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Size, lowest, highest coordinate and coordinate sums of the nodes of every level (of empty nodes, any)."""
    rows, out = tree.rows.astype(kind), []
    for level in range(tree.depth + 1):
        cuts = tree.cuts(level)
        at = np.minimum(cuts[:-1], len(rows) - 1)
        out.append((np.diff(cuts), np.minimum.reduceat(rows, at, 0), np.maximum.reduceat(rows, at, 0), np.add.reduceat(rows, at, 0)))
    return out


@dataclass
class Part:
    """What a block keeps of one part position: its tree and the nodes' boxes, sizes and sums."""

    tree: Tree
    levels: list


def keep(rows: np.ndarray) -> Part:
    tree = plant(rows, LEAF_ROWS)
    levels = _levels(tree, object if rows.dtype == object else np.int64)
    tree.rows = _compact(tree.rows)
    return Part(tree, [(size, _compact(lo), _compact(hi), total) for size, lo, hi, total in levels])


def _box_distances(lo, hi, elo, ehi, kind) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between points of the boxes of rows and of entries."""
    near, far = (np.zeros((len(lo), len(elo)), kind) for _ in range(2))
    for d in range(lo.shape[1]):
        below, above = elo[None, :, d] - hi[:, None, d], lo[:, None, d] - ehi[None, :, d]
        gap = np.maximum(np.maximum(below, above), 0)
        near += gap * gap
        reach = np.maximum(ehi[None, :, d] - lo[:, None, d], hi[:, None, d] - elo[None, :, d])
        far += reach * reach
    return near, far


def _beaten(lo, hi, entries, index, best, kind) -> np.ndarray:
    """[node, entry]: the entry loses to the node's best entry at every point of the node's box."""
    a = entries[best]  # the entry with the least farthest distance
    worst = (a * a).sum(1)[:, None] - (entries * entries).sum(1)[None]
    for d in range(lo.shape[1]):
        turn = 2 * (entries[None, :, d] - a[:, None, d])
        worst = worst + np.maximum(lo[:, None, d] * turn, hi[:, None, d] * turn)
    return ((worst < 0) | ((worst == 0) & (index[best][:, None] < index[None]))) & (np.arange(len(entries))[None] != best[:, None])


def assign(part: Part, entries: np.ndarray, label: bool = False):
    """(rows per entry, coordinate sums per entry, nodes assigned whole, rows compared), or with `label` the entry and the
    squared distance of each row."""
    tree, k = part.tree, len(entries)
    kind = _wide(tree.rows, entries)
    book = plant(entries.astype(kind), 1)
    shelves = _levels(book, kind)
    counts, sums = np.zeros(k, np.int64), np.zeros(entries.shape, part.levels[0][3].dtype)
    which = np.zeros(len(tree.rows), np.int64)
    open_, cand, shelf, settled, compared = np.zeros(1, np.int64), np.ones((1, 1), bool), 0, 0, 0
    for level in range(tree.depth + 1):
        size, lo, hi, total = part.levels[level]
        lo, hi = lo[open_].astype(kind), hi[open_].astype(kind)
        while True:  # the entries go down a level with the rows; at the rows' leaves, all the rest
            esize, elo, ehi, _ = shelves[shelf]
            cand = cand & (esize > 0)[None]
            near, far = _box_distances(lo, hi, elo, ehi, kind)
            most = far.max() + 1 if far.size else 0
            far = np.where(cand, far, most)
            cand = cand & (near <= far.min(1)[:, None])
            if shelf == book.depth or level < tree.depth:
                break
            shelf, cand = shelf + 1, np.repeat(cand, 2, axis=1)
        if shelf == book.depth:
            full = np.flatnonzero(esize > 0)
            index, single = book.order, cand[:, full]  # one entry a node at the lowest shelf
            single = single & ~_beaten(lo, hi, book.rows, index, np.argmin(far[:, full], axis=1), kind)
            cand[:, full] = single
            sure = single.sum(1) == 1
            winner = index[np.argmax(single, axis=1)]
            np.add.at(counts, winner[sure], size[open_[sure]])
            np.add.at(sums, winner[sure], total[open_[sure]])
            settled += int(sure.sum())
            if label:
                cuts = tree.cuts(level)
                for node, w in zip(open_[sure], winner[sure]):
                    which[cuts[node] : cuts[node + 1]] = w
            open_, cand = open_[~sure], cand[~sure]
        if not len(open_):
            break
        if level < tree.depth:
            open_, cand = np.repeat(open_ * 2, 2), np.repeat(cand, 2, axis=0)
            open_[1::2] += 1
            held = part.levels[level + 1][0][open_] > 0
            open_, cand = open_[held], cand[held]
            if shelf < book.depth:
                shelf, cand = shelf + 1, np.repeat(cand, 2, axis=1)
    if len(open_):
        cuts = tree.cuts(tree.depth)
        length = np.diff(cuts)[open_]
        at = np.concatenate([np.arange(cuts[i], cuts[i + 1]) for i in open_])
        may = np.zeros((len(open_), k), bool)
        may[:, book.order] = cand[:, np.flatnonzero(shelves[book.depth][0] > 0)]
        may = np.repeat(may, length, axis=0)
        x, books = tree.rows[at].astype(kind), entries.astype(kind)
        dist = np.zeros((len(at), k), kind)
        for d in range(x.shape[1]):
            step = x[:, None, d] - books[None, :, d]
            dist += step * step
        dist = np.where(may, dist, dist.max() + 1)
        won = np.argmin(dist, axis=1)
        which[at] = won
        np.add.at(counts, won, 1)
        np.add.at(sums, won, x.astype(sums.dtype))
        compared = len(at)
    if not label:
        return counts, sums, settled, compared
    gap = tree.rows.astype(kind) - entries.astype(kind)[which]
    codes, errors = np.zeros(len(which), np.int64), np.zeros(len(which), object)
    codes[tree.order], errors[tree.order] = which, (gap * gap).sum(1)
    return codes, errors


def _cut(length: int) -> list[int]:
    return [length * i // PARTS for i in range(PARTS + 1)]


def _rows_of(batch: pa.RecordBatch, length: int) -> np.ndarray:
    x = batch.column("x")
    return np.asarray(x.flatten()).astype(np.float64).reshape(len(x), length)


def plant_blocks(length: int):
    """vec_id, x, label -> per block of rows its ids, labels and pickled trees."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = _cut(length)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                own = batch.slice(i, BLOCK_ROWS)
                rows = whole(_rows_of(own, length))
                trees = pickle.dumps([keep(rows[:, a:b]) for a, b in zip(cuts, cuts[1:])], protocol=5)
                lists = [pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), own.column(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.binary())], names=["vec_ids", "labels", "trees"])

    return run


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """Digits of base 2^LIMB, lowest first; the last carries the sign."""
    place = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


def _round(books: list[np.ndarray]):
    """Blocks -> count and coordinate sums per (part, entry); the count stands at coordinate -1."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], int] = defaultdict(int)
        for batch in batches:
            for blob in batch.column("trees"):
                for p, part in enumerate(pickle.loads(blob.as_buffer())):
                    counts, totals, _, _ = assign(part, books[p])
                    for e in np.flatnonzero(counts).tolist():
                        sums[p, e, -1] += int(counts[e])
                        for d, value in enumerate(totals[e].tolist()):
                            sums[p, e, d] += value
        out = [(*key, place, digit) for key, value in sums.items() for place, digit in _limbs(value)]
        if out:
            types = [pa.int32()] * 4 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["part", "entry", "at", "place", "value"])

    return run


def _encode(books: list[np.ndarray]):
    """Blocks -> vec_id, label, code, error; error is null beyond a long."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = pickle.loads(batch.column("trees")[i].as_buffer())
                done = [assign(part, book, label=True) for part, book in zip(parts, books)]
                codes = np.stack([c for c, _ in done], axis=1).astype(np.uint8)
                error = sum(e for _, e in done)
                out = [v if v < 1 << 63 else None for v in error.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids")[i].values, batch.column("labels")[i].values, pa.array([bytes(r).hex() for r in codes], pa.string()), pa.array(out, pa.int64())],
                    names=["vec_id", "label", "code", "error"])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array of double), label of the rows without a null vector and null or non-finite components."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label").where("x is not null")
    return v.where(~F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf")))))


def learn(rows: DataFrame) -> tuple[DataFrame | None, list[np.ndarray]]:
    """The written blocks of the rows of usable() and the codebooks after the last round. The 16 seed rows and the sums per
    (part, entry, coordinate) are all that reaches the driver."""
    order = [F.asc_nulls_last("vec_id"), F.asc("x")]
    first = rows.orderBy(*order).first()
    if first is None:
        return None, []
    length, cuts = len(first["x"]), _cut(len(first["x"]))
    rows = rows.where(F.size("x") == length)
    seeds = [r["x"] for r in rows.orderBy(*order).limit(ENTRIES).collect()]
    seeds = whole(np.array(seeds, np.float64).reshape(len(seeds), length))
    books = [seeds[:, a:b] for a, b in zip(cuts, cuts[1:])]
    kinds = dict(rows.dtypes)
    schema = f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, trees binary"
    blocks = stored(rows.mapInArrow(plant_blocks(length), schema), "trees")
    for _ in range(ROUNDS):
        parts = blocks.select("trees").mapInArrow(_round(books), "part int, entry int, at int, place int, value long")
        found: dict[tuple[int, int, int], int] = defaultdict(int)
        for r in parts.groupBy("part", "entry", "at", "place").agg(F.sum("value").alias("value")).collect():
            found[r["part"], r["entry"], r["at"]] += r["value"] << (LIMB * r["place"])
        new = []
        for p, book in enumerate(books):
            lines = [[found[p, e, d] // found[p, e, -1] for d in range(book.shape[1])] if (p, e, -1) in found else row for e, row in enumerate(book.tolist())]
            big = any(abs(v) >= 2**62 for line in lines for v in line)
            new.append(np.array(lines, object if big else np.int64).reshape(book.shape))
        books = new
    return blocks, books


def codebook_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row of usable().

    Cases: a null vec_id takes part and comes last where order counts; rows that repeat a vec_id are ordered by their vector.
    Fewer than 16 rows seed fewer entries. Lengths that 8 does not divide are cut at length * i // 8; vectors of another
    length than the first row's take no part. Components of any size are exact; an error, or a sum of errors, beyond a long
    is null. An empty table gives no rows. Other columns are not read."""
    rows = usable(vectors)
    blocks, books = learn(rows)
    kinds = dict(rows.dtypes)
    if blocks is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    done = stored(blocks.mapInArrow(_encode(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    per_label = stored(done.groupBy("label").agg(F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error")), "label_errors")
    per_label = per_label.withColumnRenamed("label", "of_label")
    return done.join(per_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
