"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

1. Each text becomes its set of shingles (64-bit hashes), a fingerprint of the set and a signature of COORDS coordinates.
   Equal sets form one class, represented by its smallest doc_id; only classes go on.
2. A class is posted under each pair (coordinate, value). Two sets of similarity 0.8 share at least MATCHES of COORDS
   coordinates but for a chance of 4e-6 (less above 0.8). Prefix: with the pairs in one global order, rarest first, two such
   signatures meet in their first COORDS - MATCHES + 1 pairs, so only those are posted, and of those only pairs that two
   classes have; the frequent half of a signature is never merged. Skip: classes whose sizes rule the similarity out are
   passed over.
3. Merging, first in ROUNDS over stars: every class against two classes of each of its lists, drawn by hash, that are in
   other components; the one it shares most coordinates with is confirmed on the full sets, and confirmed links are joined
   into components. Then over what is left, lists that still hold several components. Of lists of up to SHORT classes,
   pairs in different components that share MATCHES coordinates are confirmed, but for those that cannot be linked by how
   many of their shingles no other open set has.
4. Longer lists, mostly near copies of one text, go by their differences from a common base. Lists of one main component
   make a family; its base holds the shingles of most of SLOTS members (any base gives the same links, a good one gives
   short differences). Sets i and j with differences d_i and d_j from the base differ in d_i + d_j - 2 common places, so
   they are linked if and only if 2 (100 + percent) common >= W_i + W_j, where W = (100 + percent) d - (100 - percent) n.
   The member of the least W is linked with every member that needs no common place with it; a pair of the others
   must share differences, and a prefix join over these, rarest first, finds it. Copies with many edits of their own thus
   meet only copies with the same edits, not every member of their family.

A group of m near copies so costs about m pairs a round, not m^2, and no link between different components is lost.

Collisions are counted on seven bits per coordinate, seven coordinates to a long (a match always matches there, so
nothing is missed)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmine.operators.components import connected_components

from . import lookup
from .common import LOWER, NOT_SPACE, mix, prefix_sums, range_hash, slices, spans, stored, tidy, word_hashes

COORDS, MATCHES = 64, 36
PREFIX = COORDS - MATCHES + 1
#: Rounds over stars before the remaining pairs are confirmed.
ROUNDS = 2
#: Classes of a list that are still compared pair by pair.
SHORT = 32
#: Members at most whose majority makes a family's base.
SLOTS = 15
#: Bytes up to which the families' bases are sent with the scan of their members.
SENT_BYTES = 32 << 20
#: Differences of an Arrow batch.
BATCH = 1 << 20
#: Classes of a chunk and posting keys of a bucket in the frequency count.
CHUNK_CLASSES, BUCKET_KEYS = 10_000, 1_000_000
#: Smallest set that can be linked with a different one: 4 of 5 shingles.
LEAST = 4
#: Ids up to which the table of wanted classes is sent with the scan of the texts; beyond, texts are shuffled.
SENT_IDS = 1_000_000
LANES = 7
_PACKS = [f"p{k}" for k in range(-(-COORDS // LANES))]
_A = np.random.default_rng(11).integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.default_rng(12).integers(0, 1 << 63, COORDS, dtype=np.uint64)
_C = np.random.default_rng(13).integers(0, 1 << 63, COORDS, dtype=np.uint64)


def shingle_sets(raw: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and the first place of each text.
    A text of fewer words is one shingle."""
    low = LOWER[raw]
    s, e, first = spans(low, off, NOT_SPACE)
    sums = prefix_sums(word_hashes(low, s, e))
    n = np.diff(first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][doc]
    end = np.minimum(at + words, first[1:][doc])
    h = mix(range_hash(sums, at, end) + (end - at).astype(np.uint64))
    order = np.lexsort([h, doc])
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


def signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Posting keys (coordinate and value in one 64-bit hash) of each non-empty set."""
    start = first[:-1][first[1:] > first[:-1]]
    out = np.empty((len(start), COORDS), np.uint64)
    for k in range(COORDS if len(start) else 0):
        v = (h ^ _B[k]) * _A[k]
        out[:, k] = mix(np.minimum.reduceat(v ^ (v >> np.uint64(31)), start) + _C[k])
    return out


def fingerprints(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, as two longs; 0 for an empty one."""
    out = []
    for c in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(first) - 1, np.uint64)
        some = first[1:] > first[:-1]
        if some.any():
            total[some] = mix(np.add.reduceat(mix(h ^ np.uint64(c)), first[:-1][some]))
        out.append(total.view(np.int64))
    return out[0], out[1]


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), f1, f2 (fingerprint), sig (the posting keys) of each row, stored."""

    def run(batches):
        for b in batches:
            for i, j, raw, off in slices(b.column(1)):
                h, first = shingle_sets(raw, off, words)
                f1, f2 = fingerprints(h, first)
                n = np.diff(first)
                sig = iter(signatures(h, first))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n), pa.array(f1), pa.array(f2), pa.array([next(sig).tobytes() if k else None for k in n.tolist()], pa.binary())],
                    ["doc_id", "n", "f1", "f2", "sig"],
                )

    return stored(docs.mapInArrow(tidy(run), "doc_id long, n long, f1 long, f2 long, sig binary"), "signatures")


def _postings(classes: DataFrame) -> DataFrame:
    """key, c, n, p0.. of each class's prefix, without the keys that only one class has; stored."""
    total = classes.count()
    chunks, buckets = max(1, -(-total // CHUNK_CLASSES)), max(1, total * COORDS // BUCKET_KEYS)
    dealt = classes.select("c", "n", "sig").withColumn("chunk", F.pmod(F.xxhash64("c"), F.lit(chunks)))

    def matrix(t) -> np.ndarray:
        return np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint64).reshape(t.num_rows, COORDS)

    def ask(t):
        keys, count = np.unique(matrix(t), return_counts=True)
        return lookup.ask_table(t.column("chunk")[0].as_py(), keys, [count], buckets)

    frequent = lookup.answer(dealt.groupBy("chunk").applyInArrow(ask, lookup.ASK), lookup.total, 1)
    types = [("key", pa.int64()), ("c", pa.int64()), ("n", pa.int64()), *((p, pa.int64()) for p in _PACKS)]

    def post(t, found):
        if not t.num_rows:
            return pa.table({k: pa.array([], v) for k, v in types})
        m = matrix(t)
        keys = np.unique(m)
        f = lookup.answers_of(found, 1)[np.searchsorted(keys, m)]
        order = np.lexsort([m.ravel(), f.ravel(), np.repeat(np.arange(len(m)), COORDS)]).reshape(m.shape)[:, :PREFIX]
        key, freq = m.ravel()[order], f.ravel()[order]
        row, col = np.nonzero(freq > 1)
        packs = _packed(m)
        cols = [key[row, col].view(np.int64), t.column("c").to_numpy()[row], t.column("n").to_numpy()[row], *(packs[row, k] for k in range(packs.shape[1]))]
        return pa.table({k: pa.array(x, v) for (k, v), x in zip(types, cols)})

    out = dealt.groupBy("chunk").cogroup(frequent.groupBy("chunk")).applyInArrow(post, ", ".join(f"{k} long" for k, _ in types))
    return stored(out, "postings")


def _packed(m: np.ndarray) -> np.ndarray:
    """Seven bits of each key, in the lower bytes of longs, LANES to a long; lanes without a key are 0."""
    n, k = m.shape
    out = np.zeros((n, -(-k // LANES), 8), np.uint8)
    lanes = np.zeros((n, out.shape[1] * LANES), np.uint8)
    lanes[:, :k] = m & np.uint64(0x7F)
    out[:, :, :LANES] = lanes.reshape(n, -1, LANES)
    return out.reshape(n, -1).view(np.int64)


def _collisions(a: str, b: str) -> Column:
    """Equal lanes of two packed signatures: adding 127 to a lane of p ^ q carries into its eighth bit unless it is 0."""
    differ = F.lit(0)
    for p in _PACKS:
        x = F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}")) + F.lit(0x007F7F7F7F7F7F7F)
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x0080808080808080)))
    return F.lit(COORDS) - differ


def _prefixed(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """c, set (sorted shingle hashes) of the classes in `ids` (id: the representative's doc_id, c), stored."""
    ids = stored(ids, "wanted")
    known = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    texts = docs.join(known, F.col("doc_id") == F.col("id")).select("c", "text")

    def sets(batches):
        for b in batches:
            for i, j, raw, off in slices(b.column(1)):
                h, first = shingle_sets(raw, off, words)
                f1, _ = fingerprints(h, first)
                # several rows may share the representative's id; the class is the one with its fingerprint
                mine = np.flatnonzero(f1 == b.column(0).slice(i, j - i).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(f1[mine]), pa.array([h[first[k] : first[k + 1]].tobytes() for k in mine], pa.binary())], ["c", "set"])

    return stored(texts.mapInArrow(tidy(sets), "c long, set binary").dropDuplicates(["c"]), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are linked."""
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("c").alias("b"), F.col("set").alias("sb")), "b")

    def check(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(both.select("a", "b", "sa", "sb").mapInArrow(tidy(check), "a long, b long"), "links")


def _shared(sets: DataFrame) -> DataFrame:
    """c, shared: how many shingles of the set stand in another one of `sets`."""
    n_bytes = int(sets.agg(F.sum(F.octet_length("set"))).first()[0] or 0)
    chunks, buckets = max(1, -(-n_bytes // lookup.CHUNK_BYTES)), max(1, n_bytes // (8 * BUCKET_KEYS))
    dealt = sets.withColumn("chunk", F.pmod(F.xxhash64("c"), F.lit(chunks)))

    def ask(t):
        keys, count = np.unique(np.frombuffer(b"".join(t.column("set").to_pylist()), np.uint64), return_counts=True)
        return lookup.ask_table(t.column("chunk")[0].as_py(), keys, [count], buckets)

    found = lookup.answer(dealt.groupBy("chunk").applyInArrow(ask, lookup.ASK), lookup.total, 1)

    def count(t, answers):
        if not t.num_rows:
            return pa.table({k: pa.array([], pa.int64()) for k in ("c", "shared")})
        blobs = t.column("set").to_pylist()
        flat = np.frombuffer(b"".join(blobs), np.uint64)
        keys = np.unique(flat)
        also = lookup.answers_of(answers, 1)[np.searchsorted(keys, flat)] > 1
        ends = np.cumsum([len(b) // 8 for b in blobs])
        got = np.diff(np.concatenate([[0], np.cumsum(also)[ends - 1]]))
        return pa.table({"c": t.column("c"), "shared": pa.array(got.astype(np.int64))})

    return stored(dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(count, "c long, shared long"), "shared")


def _families(long: DataFrame) -> DataFrame:
    """g, c, n of the classes in each family: the lists in which most classes have the label g; stored."""
    votes = long.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
    main = votes.groupBy("key").agg(F.max(F.struct("k", "label")).alias("m")).select("key", F.col("m.label").alias("g"))
    return stored(long.join(main, "key").select("g", "c", "n").distinct(), "families")


def _differences(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """g, c, n, d (number of differences), w (see above), delta (the shingles in which the set and the family's base
    differ), stored."""
    slot = F.pmod(F.xxhash64("c", "g"), F.lit(SLOTS))
    drawn = families.groupBy("g", slot.alias("slot")).agg(F.min("c").alias("c")).select("g", "c")

    def majority(t):
        blobs = t.column("set").to_pylist()
        x, k = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_counts=True)
        return pa.table({"g": t.column("g").slice(0, 1), "base": pa.array([x[2 * k > len(blobs)].tobytes()], pa.binary())})

    base = stored(drawn.join(sets, "c").select("g", "set").groupBy("g").applyInArrow(majority, "g long, base binary"), "bases")
    n_bytes = int(base.agg(F.sum(F.octet_length("base"))).first()[0] or 0)
    both = families.join(sets, "c").join(F.broadcast(base) if n_bytes <= SENT_BYTES else base, "g")

    def differ(batches):
        for b in batches:
            at, held, size = 0, [], 0
            pairs = list(zip(b.column(3).to_pylist(), b.column(4).to_pylist()))
            for k, (x, y) in enumerate(pairs, 1):
                held.append(np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                size += len(held[-1])
                if size >= BATCH or k == len(pairs):
                    ends = np.cumsum([0, *map(len, held)])
                    delta = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(held).view(np.int64)))
                    cols = [*(b.column(c).slice(at, k - at) for c in range(3)), pa.array(np.diff(ends)), delta]
                    yield pa.RecordBatch.from_arrays(cols, ["g", "c", "n", "d", "delta"])
                    at, held, size = k, [], 0

    out = both.select("g", "c", "n", "set", "base").mapInArrow(tidy(differ), "g long, c long, n long, d long, delta array<long>")
    return stored(out.withColumn("w", (100 + percent) * F.col("d") - (100 - percent) * F.col("n")), "differences")


def _with_family(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """`rows` with the columns of their family, one row of `facts` a family."""
    return rows.join(F.broadcast(facts) if facts.count() <= SENT_IDS else facts, "g")


def _family_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members (g, c, n, d, w, delta, label, least: the family's least w) with different labels that
    can be linked, without those that need no common difference with the least member."""
    far = F.col("w") + F.col("least") > 0
    first = members.where(far).groupBy("g").agg(F.min("w").alias("least_far"))
    open_ = _with_family(members.withColumn("far", far), stored(first, "far"))
    unit = 2 * (100 + percent)
    # one of a pair is far: the common places that any partner asks for
    asked = F.greatest(F.lit(1), F.ceil((F.col("w") + F.when(F.col("far"), F.col("least")).otherwise(F.col("least_far"))) / unit))
    each = open_.select("g", "c", "n", "d", "w", "label", "far", (F.col("d") - asked + 1).alias("prefix"), F.explode("delta").alias("x"))
    each = stored(each, "places")
    known = each.groupBy("g", "x").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # places of one member only match nothing: they stand first in its order and need no row
    shared = each.join(known, ["g", "x"])
    total = shared.select("*", F.count(F.lit(1)).over(Window.partitionBy("g", "c")).alias("held"), F.row_number().over(Window.partitionBy("g", "c").orderBy("f", "x")).alias("nth"))
    posted = total.select("g", "x", "c", "n", "w", "label", "far", (F.col("held") - F.col("nth")).alias("after"), (F.col("d") - F.col("held") + F.col("nth")).alias("rank"), "prefix")
    posted = stored(posted.where(F.col("rank") <= F.col("prefix")).drop("rank", "prefix"), "places")
    fits = (100 * F.least("n", "m_n") >= percent * F.greatest("n", "m_n")) & (unit * (1 + F.least("after", "m_after")) >= F.col("w") + F.col("m_w"))
    pairs = posted.where("far").join(_prefixed(posted, "m_", ["g", "x"]), ["g", "x"]).where((F.col("label") != F.col("m_label")) & (~F.col("m_far") | (F.col("c") < F.col("m_c"))) & fits)
    return pairs.select(F.least("c", "m_c").alias("a"), F.greatest("c", "m_c").alias("b"))


def _components(links: DataFrame) -> DataFrame:
    """c, label of every class that has a link."""
    nodes = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    return connected_components(nodes, links).select(F.col("id").alias("c"), F.col("comp").alias("label"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of `docs` (doc_id, text).

    Words are runs of anything but the ASCII white space, A-Z lower-cased; a set holds the distinct shingles of `words`
    words, a shorter text whole. Sets with 100 * common >= percent * union are linked (percent at least 80: the match
    threshold is laid out for that); a document's component is the smallest doc_id reachable, and that one is kept.
    Null and empty texts have no set and no link. Rows with the same doc_id are one document with several sets. A row
    without doc_id has component_id null, is kept and links nothing. Other columns are ignored."""
    if percent < 80:
        raise ValueError("percent must be at least 80")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = _signed(src, words)
    # class c: the sets with one fingerprint; rep: its smallest doc_id
    some = rows.where("n > 0 and doc_id is not null")
    classes = stored(some.groupBy(F.col("f1").alias("c"), "f2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    reps = classes.select("c", "rep")
    posted = _postings(classes.where(F.col("n") >= LEAST))

    sizes = (100 * F.least("n", "m_n") >= percent * F.greatest("n", "m_n")) & (_collisions("", "m_") >= MATCHES)
    def ids_of(c: DataFrame) -> DataFrame:
        return reps.join(c.distinct(), "c").select(F.col("rep").alias("id"), "c")

    links, labelled = None, posted.withColumn("label", F.col("c"))
    for r in range(ROUNDS):
        drawn = F.struct(F.xxhash64("c", "key", F.lit(r)), "c", "n", "label", *_PACKS)
        two = labelled.groupBy("key").agg(F.array(F.max(drawn), F.min(drawn)).alias("m")).select("key", F.explode("m").alias("m"))
        two = two.select("key", *[F.col(f"m.{x}").alias(f"m_{x}") for x in ("c", "n", "label", *_PACKS)])
        stars = labelled.join(two, "key").where((F.col("label") != F.col("m_label")) & sizes).select("c", "m_c", _collisions("", "m_").alias("hits"))
        best = stars.groupBy("c").agg(F.max(F.struct("hits", "m_c")).alias("m"))
        best = stored(best.select(F.col("c").alias("a"), F.col("m.m_c").alias("b")), "pairs")
        got = _confirmed(best, _sets(src, ids_of(best.select(F.col("a").alias("c")).union(best.select("b"))), words), percent)
        links = got if links is None else links.unionByName(got)
        labelled = posted.join(_components(links), "c", "left").withColumn("label", F.coalesce("label", "c"))
        labelled = stored(labelled, "labelled")
    # lists that lie in one component have nothing left to find
    lists = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("k")).where("lo < hi")
    rest = stored(labelled.join(lists.select("key", (F.col("k") > SHORT).alias("long")), "key"), "open")
    sets = _sets(src, ids_of(rest.select("c")), words)
    families = _families(rest.where("long"))
    near = None
    if families.count():
        deltas = _differences(families, sets, percent)
        centre = stored(deltas.groupBy("g").agg(F.min(F.struct("w", "c")).alias("m")).select("g", F.col("m.w").alias("least"), F.col("m.c").alias("centre")), "centres")
        deltas = _with_family(deltas, centre)
        star = deltas.where((F.col("w") + F.col("least") <= 0) & (F.col("c") != F.col("centre"))).select(F.col("c").alias("a"), F.col("centre").alias("b"))
        links = links.unionByName(_confirmed(stored(star.distinct(), "pairs"), sets, percent))
        labels = stored(_components(links), "labels")
        rest = rest.drop("label").join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
        near = _family_pairs(deltas.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c")), percent)
    rest = rest.where(~F.col("long")).drop("long").join(_shared(sets), "c")
    # what only one set has is in no intersection, but in the union
    low = F.least("shared", "m_shared")
    possible = 100 * low >= percent * (F.col("n") + F.col("m_n") - low)
    pairs = _prefixed(rest, "", ["key"]).join(_prefixed(rest, "m_", ["key"]), "key").where((F.col("c") < F.col("m_c")) & (F.col("label") != F.col("m_label")) & sizes & possible)
    pairs = pairs.select(F.col("c").alias("a"), F.col("m_c").alias("b"))
    more = _confirmed(stored((pairs if near is None else pairs.unionByName(near)).distinct(), "pairs"), sets, percent)

    members = stored(some.select("doc_id", F.col("f1").alias("c")).distinct(), "members")
    # a document with several sets ties their classes together
    several = members.groupBy("doc_id").agg(F.min("c").alias("a"), F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id", "a")
    ties = members.join(several, "doc_id").where("a <> c").select("a", F.col("c").alias("b"))
    label = _components(stored(links.unionByName(more).unionByName(ties), "all-links"))
    least = reps.join(label, "c", "left").withColumn("label", F.coalesce("label", "c"))
    smallest = least.groupBy("label").agg(F.min("rep").alias("component_id"))
    per_class = least.join(smallest, "label").select("c", "component_id")
    found = rows.join(per_class, (F.col("f1") == F.col("c")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left")
    found = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    # an empty row of a document that has other sets shares their component
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
