"""How quality filters interact: what every order of five filters keeps, removes and finds already removed.

A document's failures are bits. Four come from its own text; the fifth, "an equal text has a smaller doc_id", is an
existential self-join: the rows whose text hash occurs under two ids are left-semi joined on hash, exact text and smaller
doc_id with the least id of every repeated text (pre-aggregated, so a text that a third of all rows share is one row on
that side; the joined tables are written first, so that a skewed partition of the other side can be split). The ids of that
join are united with the other failure ids, bits are combined per id, and the counts per (part, bit combination), at most 32
a part, give every order without touching the documents again.

Cases: a null text is empty, a null source is the part ''. A null doc_id is smaller than none and has none smaller. Rows that
repeat a doc_id and text count each, and fail E only by a smaller id. Of several labels of one doc_id, quality or toxic is 1
if one of them is. Texts are compared whole. An empty table gives no rows. Other columns are not read."""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
# Separators and odd characters of the contract.
SEPARATOR, SEPARATORS, ODD = r"[\x20\x09-\x0D]+", " \t\n\x0b\x0c\r", r"[#$%&*|]"


def _own(docs: DataFrame) -> DataFrame:
    """doc_id, part, text (never null) and h, the hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select("doc_id", part.alias("part"), text.alias("text")).withColumn("h", F.xxhash64("text"))


def text_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, h, bits: which of the filters A to D each row fails."""
    trimmed = F.btrim("text", F.lit(SEPARATORS))
    d = _own(docs).withColumn("none", F.when(trimmed == "", 1).otherwise(0)).withColumn("words", F.split(trimmed, SEPARATOR))
    n, distinct = F.size("words") - F.col("none"), F.size(F.array_distinct("words")) - F.col("none")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    fails = {
        "A": n < MIN_WORDS,
        "B": 100 * distinct.cast("long") < DISTINCT_PERCENT * n.cast("long"),
        "C": 100 * capitals > CAPITAL_PERCENT * F.length("text").cast("long"),
        "D": F.col("text").rlike(ODD),
    }
    bits = sum((F.when(cond, BIT[f]).otherwise(0) for f, cond in fails.items()), F.lit(0))
    return d.select("doc_id", "part", "h", bits.alias("bits"))


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, part, h of the rows whose text another row has under a smaller doc_id."""
    d = _own(docs)
    ids = d.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    hashes = stored(ids.select("h"), "repeated_hashes")
    rows = stored(d.join(hashes, "h", "left_semi"), "repeated_texts")
    first = rows.groupBy("h", "text").agg(F.min("doc_id").alias("first_id"))
    first = stored(first.select(F.col("h").alias("first_h"), F.col("text").alias("first_text"), "first_id"), "first_ids")
    same = (rows.h == first.first_h) & (rows.text == first.first_text) & (first.first_id < rows.doc_id)
    return rows.join(first, same, "left_semi").select("doc_id", "part", "h")


def combinations_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good, toxic: documents of every combination of failures, and those labelled good or toxic."""
    ids = text_failures(docs).withColumn("n", F.lit(1).cast("long")).unionByName(
        copies(docs).select("*", F.lit(BIT["E"]).alias("bits"), F.lit(0).cast("long").alias("n")))
    per_id = ids.groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(m) for c, m in (("quality", "good"), ("toxic", "bad"))])
    per_id = per_id.join(marks, "doc_id", "left")
    return per_id.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(F.col(m), F.lit(0))).alias(c) for m, c in (("good", "good"), ("bad", "toxic"))])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per (part, filter_order, step): kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A step depends only on its filter and the set of filters before it: 80 such pairs are counted a part, then dealt to
    the 600 (order, step) pairs, a constant table. A row that fails k filters is removed by each of them in k-th part of
    all orders, which gives the Shapley sums."""
    counts = combinations_of(docs, labels)
    pairs = [(sum(BIT[x] for x in before), BIT[f]) for f in FILTERS for k in range(5) for before in combinations(FILTERS.replace(f, ""), k)]
    before, own = F.col("p.before"), F.col("p.own")
    met = F.array(*[F.struct(F.lit(b).alias("before"), F.lit(f).alias("own")) for b, f in pairs])
    fails, open_ = F.col("bits").bitwiseAND(own) != 0, F.col("bits").bitwiseAND(before) == 0

    def total(cond, value="n"):
        return F.sum(F.when(cond, F.col(value)).otherwise(F.lit(0).cast("long")))

    share = F.expr(f"n * ({factorial(len(FILTERS))} div bit_count(bits))")
    steps = counts.withColumn("p", F.explode(met)).groupBy("part", before.alias("before"), own.alias("own")).agg(
        total(~fails & open_).alias("kept"), total(fails & open_).alias("removed"), total(fails & ~open_).alias("redundant"),
        total(F.col("bits") == own).alias("unique_fails"), total(fails & open_, "good").alias("good_lost"),
        total(fails & open_, "toxic").alias("toxic_lost"), F.sum(F.when(fails, share).otherwise(F.lit(0).cast("long"))).alias("shapley"))
    orders = [("".join(o), k + 1, sum(BIT[x] for x in o[:k]), BIT[o[k]]) for o in permutations(FILTERS) for k in range(len(FILTERS))]
    order_table = docs.sparkSession.createDataFrame(orders, "filter_order string, step int, before int, own int")
    return steps.join(F.broadcast(order_table), ["before", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
