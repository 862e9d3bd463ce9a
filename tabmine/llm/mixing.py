"""Mixing sources to target token shares by entropy balancing.

The rates r_d >= 0 of the documents minimise  sum_d size_d * (r_d * ln r_d - r_d)  under one token constraint per source,
sum_{d in s} size_d * r_d = target_s. The convex dual  sum_d size_d * exp(lambda_s(d)) - sum_s lambda_s * target_s  has one
multiplier per source and rates r_d = exp(lambda_s(d)): each document starts at rate 1 and is tilted exponentially. The
documents are added up to one row per source first; Newton steps on that distributed table solve the dual. Rates become
whole copies by systematic rounding along each source's documents in order of size, so that a source's taken tokens
follow its target closely. Only DataFrame functions; nothing but sums reaches the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, shielded, stored

#: No source's target, and no document's copies, exceed this many times its size.
MAX_REPEATS = 3
#: Starting points tried for the rounding of each source.
OFFSETS = 16


def _placed(df: DataFrame, order: list[Column], group: list[str], name: str) -> DataFrame:
    """`df`, range-partitioned by group and order and stored with the number of its partition in `__part`."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *[F.col(g).asc_nulls_last() for g in group], *order).withColumn("__part", F.spark_partition_id()), name)


def _running(df: DataFrame, value: Column, out: str, order: list[Column], group: list[str]) -> DataFrame:
    """Adds the running sum of `value` in the given order within `group` to a placed table: rows add up inside each
    partition and are shifted by the sums of the partitions before (one row per partition and group)."""
    df = df.withColumn("__v", value)
    sums = df.groupBy("__part", *group).agg(F.sum("__v").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    sums = sums.select(F.col("__part").alias("__p"), *[F.col(g).alias(f"__{g}") for g in group], "__before")
    on = F.col("__part") == F.col("__p")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__{g}"))
    inside = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("__in", F.sum("__v").over(inside)).join(sums, on)
    return df.withColumn(out, F.col("__in") + F.col("__before")).drop("__p", "__v", "__in", "__before", *[f"__{g}" for g in group])


def targets(per_source: DataFrame) -> DataFrame:
    """source, source_size, target: shares 1, 2, 3, repeating over the sources by code point (null last) of all tokens;
    a target stops at MAX_REPEATS times the source's size and the excess is shared again by weight."""
    order = [F.col("source").asc_nulls_last()]
    t = _running(_placed(per_source, order, [], "sources"), F.lit(1), "rank", order, []).drop("__part")
    t = stored(t.withColumn("w", (F.col("rank") - 1) % 3 + 1).drop("rank"), "weights")
    total, weight = t.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    cap = (F.lit(MAX_REPEATS) * F.col("source_size")).cast("decimal(38,0)")
    rest, w_rest, known = total, weight, -1
    while True:
        # capped: MAX_REPEATS * size <= rest * w / w_rest, in whole numbers
        capped = cap * F.lit(max(w_rest, 1)).cast("decimal(19,0)") <= F.col("w").cast("decimal(19,0)") * F.lit(rest).cast("decimal(19,0)")
        n, used, w_used = t.agg(F.count_if(capped), F.coalesce(F.sum(F.when(capped, F.col("source_size") * MAX_REPEATS)), F.lit(0)), F.coalesce(F.sum(F.when(capped, F.col("w"))), F.lit(0))).first()
        if n == known or n == 0 or w_used == weight:
            break
        known, rest, w_rest = n, total - used, weight - w_used
    share = (F.col("w") * F.lit(rest)).cast("double") / F.lit(float(max(w_rest, 1)))
    return t.select("source", "source_size", F.when(capped, (F.col("source_size") * MAX_REPEATS).cast("double")).otherwise(share).alias("target"))


def balance(constraints: DataFrame, tolerance: float = 1e-13, max_steps: int = 200) -> DataFrame:
    """Newton's method on the dual: adds `rate` = exp(lambda) to (source, source_size, target). A step is
    lambda - gradient / Hessian = lambda - (size * exp(lambda) - target) / (size * exp(lambda)), cut to +-2.
    Sources without tokens or with target 0 get rate 0. Raises if the steps don't converge."""
    live = (F.col("source_size") > 0) & (F.col("target") > 0)
    t = constraints.withColumn("lam", F.lit(0.0))
    for step in range(max_steps):
        got = F.col("source_size") * F.exp("lam")
        move = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), (F.col("target") - got) / got))
        t = t.withColumn("move", F.when(live, move).otherwise(0.0)).withColumn("lam", F.col("lam") + F.col("move"))
        if step % 4 == 3:  # four steps a job
            t = stored(t, "dual")
            if (t.agg(F.max(F.abs("move"))).first()[0] or 0.0) <= tolerance:
                return t.withColumn("rate", F.when(live, F.round(F.exp("lam"), 12)).otherwise(0.0)).drop("lam", "move")
    raise RuntimeError("the dual did not converge")


def sized(docs: DataFrame) -> DataFrame:
    """Adds `size`: the number of words of the text (null: 0)."""
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(SPACE_WORD)), F.lit(0)).cast("long"))


def copies(rows: DataFrame) -> DataFrame:
    """Adds source_size, target and copies to stored `rows` (rid, doc_id, source, size).

    Within a source, documents are ordered by (size, doc_id, rid); with rate r and offset u, document k gets
    floor(k r + u) - floor((k - 1) r + u) copies. Of OFFSETS offsets, each source takes the one whose taken tokens come
    nearest the target. What still lacks (or is too much) is made up in the same order: one copy more (less) for the
    smallest documents that can have it, as long as their sizes fit in. Reruns agree."""
    order = [F.col("size"), F.col("doc_id").asc_nulls_first(), F.col("rid")]
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    dual = balance(targets(stored(per_source, "source-sizes"))).withColumnRenamed("source", "__s")
    r = _running(_placed(rows, order, ["source"], "ranked"), F.lit(1), "rank", order, ["source"])
    r = r.join(dual, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")

    def at(u: Column) -> Column:
        # a rate is at most MAX_REPEATS; the bound only guards the last bit of the products
        return F.least(F.lit(MAX_REPEATS).cast("long"), F.floor(F.col("rank") * F.col("rate") + u) - F.floor((F.col("rank") - 1) * F.col("rate") + u))

    us = [F.lit((k + 0.5) / OFFSETS) for k in range(OFFSETS)]
    tries = r.groupBy("source").agg(F.first("target").alias("t"), *[F.sum(F.col("size") * at(u)).alias(f"u{k}") for k, u in enumerate(us)])
    tried = F.array(*[F.struct(F.abs(F.col(f"u{k}") - F.col("t")).alias("gap"), F.lit(k).alias("k"), (F.col("t") - F.col(f"u{k}")).alias("lack")) for k in range(OFFSETS)])
    best = tries.select(F.col("source").alias("__s"), F.array_min(tried).alias("__b"))
    r = r.join(best, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    r = r.withColumn("copies", at((F.col("__b.k") + 0.5) / OFFSETS)).withColumn("__lack", F.col("__b.lack")).drop("__b", "rank", "rate")
    can = F.when(F.col("__lack") > 0, F.col("copies") < MAX_REPEATS).otherwise(F.col("copies") > 0) & (F.col("size") > 0)
    r = _running(stored(r, "rounded"), F.when(can, F.col("size")).otherwise(0), "__used", order, ["source"])
    more = F.when(can & (F.col("__used") <= F.abs("__lack")), F.signum("__lack").cast("long")).otherwise(0)
    return r.withColumn("copies", F.col("copies") + more).drop("__lack", "__used", "__part")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of each row of `docs` (doc_id, text, source).

    Null text: size 0, taken 0. A null source is a source of its own, last. Repeated rows count each. Other columns are
    ignored. An empty table gives an empty result."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    rows = stored(sized(src).drop("text").withColumn("rid", F.monotonically_increasing_id()), "sizes")
    return copies(rows).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row of `docs` as often as its copies say (0 to MAX_REPEATS), same columns, whatever
    the names of those beside doc_id, text and source. Nulls, ties and empty tables as in mix()."""
    rows = stored(shielded(docs, "doc_id", "text", "source").withColumn("__rid", F.monotonically_increasing_id()), "mix-input")
    small = sized(rows.select(F.col("__rid").alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")).drop("text")
    taken = copies(stored(small, "sizes")).where("copies > 0").select(F.col("rid").alias("__rid"), F.col("copies").cast("int").alias("__copies"))
    out = rows.join(taken, "__rid").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return out.drop("__rid", "__copies", "__copy").toDF(*docs.columns)
