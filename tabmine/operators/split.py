"""Train/test splits with exact sizes and no per-class sort in one task.

Rows are ordered by a seeded hash ``md5(id || seed)``. The per-class cut is
found by radix selection on the 60-bit hash prefix: each level is one
``groupBy(class, bin).count`` over the rows still in play (uniform hashes
make bins balanced), so a class holding a third of all rows never lands in
one task. Only when the boundary bin of a class is small are its rows
ranked by a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .profile import c

BITS = 60
LEVEL_BITS = 16
FINAL_ROWS = 1_000_000
MAX_LITERAL_GROUPS = 1000
MAX_BROADCAST_GROUPS = 100_000


def hash_key(id_col: str, seed: int = 42):
    """(md5 hex, 60-bit numeric prefix) of the seeded order key."""
    h = F.md5(F.concat(c(id_col).cast("string"), F.lit(str(seed))))
    return h, F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def _thresholds(keyed: DataFrame, group: str, want: DataFrame) -> DataFrame:
    """Per group the (hkey, h, id) struct of the row at 1-based rank ``k``.

    ``keyed`` has columns group, __hk (bigint), __h (string), __id;
    ``want`` has group, k (rank wanted, >= 1) and n (group size).
    """
    small = want.count() <= MAX_BROADCAST_GROUPS  # one row per group: broadcast only under a checked bound

    def side(t: DataFrame) -> DataFrame:
        return F.broadcast(t) if small else t

    state = want.select(c(group).alias("__g"), F.col("k").alias("__k"), F.lit(0).cast("bigint").alias("__pre"),
                        F.lit(0).alias("__bits"), F.lit(0).cast("bigint").alias("__off"), F.col("n").alias("__n"))
    done = None
    bits = 0
    while True:
        live = state.where(F.col("__n") > FINAL_ROWS) if bits < BITS else state.limit(0)
        final = state.where(F.col("__n") <= FINAL_ROWS) if bits < BITS else state
        # groups whose remaining candidates are few: rank them exactly
        cand = keyed.join(side(final), keyed[group].eqNullSafe(final["__g"]))
        if bits > 0:
            cand = cand.where(F.shiftright(F.col("__hk"), BITS - bits) == F.col("__pre"))
        w = Window.partitionBy("__g").orderBy("__hk", "__h", "__id")
        picked = (
            cand.withColumn("__r", F.row_number().over(w) + F.col("__off"))
            .where(F.col("__r") == F.col("__k"))
            .select(F.col("__g"), F.struct("__hk", "__h", "__id").alias("__t"))
        )
        done = picked if done is None else done.unionByName(picked)
        if bits >= BITS or live.limit(1).count() == 0:
            break
        nb = min(LEVEL_BITS, BITS - bits)
        cand = keyed.join(side(live), keyed[group].eqNullSafe(live["__g"]))
        if bits > 0:
            cand = cand.where(F.shiftright(F.col("__hk"), BITS - bits) == F.col("__pre"))
        hist = cand.groupBy(
            "__g", "__k", "__off", (F.shiftright(F.col("__hk"), BITS - bits - nb)).alias("__bin")
        ).agg(F.count(F.lit(1)).alias("__cnt"))
        # at most 2^16 bins per live group: a small window per group
        wc = Window.partitionBy("__g").orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("__cum", F.sum("__cnt").over(wc) + F.col("__off"))
        state = hist.where(
            (F.col("__cum") >= F.col("__k")) & (F.col("__cum") - F.col("__cnt") < F.col("__k"))
        ).select(
            "__g", "__k", F.col("__bin").alias("__pre"), F.lit(bits + nb).alias("__bits"),
            (F.col("__cum") - F.col("__cnt")).alias("__off"), F.col("__cnt").alias("__n"),
        )
        state = state.cache()
        bits += nb
    return done


def stratified_split(df: DataFrame, id_col: str, target: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """L1: per class, the ``max(1, floor(n_c * test))`` rows with the smallest
    seeded hash are test rows (a singleton class has no train row). Adds
    ``is_test`` BOOLEAN."""
    h, hk = hash_key(id_col, seed)
    keyed = df.select("*", hk.alias("__hk"), h.alias("__h"), c(id_col).alias("__id"))
    want = keyed.groupBy(c(target)).agg(F.count(F.lit(1)).alias("n")).select(
        c(target), "n", F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(test))).cast("bigint").alias("k")
    )
    thr = _thresholds(keyed, target, want)
    return _apply(df, keyed, target, thr)


def _apply(df: DataFrame, keyed: DataFrame, group: str, thr: DataFrame) -> DataFrame:
    """Mark rows at or below their group's threshold. The threshold table has
    one row per class: when small it is collected once and becomes a literal
    map, so the split is a plain projection for every later consumer."""
    rows = thr.limit(MAX_LITERAL_GROUPS + 1).collect()
    if len(rows) <= MAX_LITERAL_GROUPS:
        key = F.struct("__hk", "__h", "__id")
        cond = F.lit(False)
        for r in rows:
            t = r["__t"]
            lit_t = F.struct(F.lit(t["__hk"]).alias("__hk"), F.lit(t["__h"]).alias("__h"),
                             F.lit(t["__id"]).cast(dict(keyed.dtypes)["__id"]).alias("__id"))
            grp = c(group).isNull() if r["__g"] is None else (c(group) == F.lit(r["__g"]))
            cond = F.when(grp, key <= lit_t).otherwise(cond)
        return keyed.select(*[c(x) for x in df.columns], F.coalesce(cond, F.lit(False)).alias("is_test"))
    out = keyed.join(thr, keyed[group].eqNullSafe(thr["__g"]), "left")
    is_test = F.struct("__hk", "__h", "__id") <= F.col("__t")
    return out.select(*[c(x) for x in df.columns], F.coalesce(is_test, F.lit(False)).alias("is_test"))


def random_split(df: DataFrame, id_col: str, test: float = 0.2, seed: int = 42, exact: bool = True) -> DataFrame:
    """L2: unstratified. ``exact``: ceil(n * test) rows with the smallest
    seeded hash; otherwise the hash fraction below ``test`` (no count pass)."""
    h, hk = hash_key(id_col, seed)
    if not exact:
        return df.withColumn("is_test", hk < F.lit(int(test * (1 << BITS))))
    keyed = df.select("*", hk.alias("__hk"), h.alias("__h"), c(id_col).alias("__id"), F.lit(0).alias("__all"))
    want = keyed.groupBy("__all").agg(F.count(F.lit(1)).alias("n")).select(
        "__all", "n", F.ceil(F.col("n") * F.lit(test)).cast("bigint").alias("k")
    ).where(F.col("k") >= 1)
    thr = _thresholds(keyed, "__all", want)
    return _apply(df, keyed, "__all", thr)


def auto_split(df: DataFrame, id_col: str, target: str, test: float = 0.2, seed: int = 42, stratify: bool = True) -> DataFrame:
    """Stratify unless disabled or some class has fewer than 2 rows."""
    if stratify:
        small = df.groupBy(c(target)).count().where(F.col("count") < 2).limit(1).count()
        if small == 0:
            return stratified_split(df, id_col, target, test, seed)
    return random_split(df, id_col, test, seed)
