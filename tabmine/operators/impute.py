"""Missing values: drops, constant imputations, ordered fills, class means,
k-nearest-donor imputation, and the per-column + global composition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import placed
from ..functions.quantiles import column_quantiles
from ..sources.io import normalize_missing
from .profile import c, numeric_columns

SMALL_TABLE_ROWS = 1_000_000  # broadcast bound for per-class / per-partition tables


def drop_missing_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """M1: tokens normalised, then rows with any null dropped."""
    return normalize_missing(df).na.drop("any", subset=list(cols) if cols else None)


def columns_with_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    cols = list(cols) if cols is not None else df.columns
    row = df.agg(*[F.max(c(x).isNull().cast("int")).alias(f"m{i}") for i, x in enumerate(cols)]).first()
    return [x for i, x in enumerate(cols) if row[f"m{i}"]]


def drop_missing_columns(df: DataFrame) -> DataFrame:
    """M2: drop every column that holds a null (after token normalisation)."""
    df = normalize_missing(df)
    bad = columns_with_nulls(df)
    return df.drop(*bad)


def _fill_with(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    return df.select(
        *[
            (F.coalesce(c(x).cast("double"), F.lit(values[x]).cast("double")).alias(x) if x in values else c(x))
            for x in df.columns
        ]
    )


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """M3: numeric columns, mean of non-null cells; ints become double; an
    all-null column stays null. One aggregate pass."""
    df = normalize_missing(df)
    cols = list(cols) if cols is not None else numeric_columns(df)
    row = df.agg(*[F.avg(c(x)).alias(f"m{i}") for i, x in enumerate(cols)]).first()
    return _fill_with(df, {x: row[f"m{i}"] for i, x in enumerate(cols)})


def impute_median(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """M4: exact median (linear interpolation) with bounded memory."""
    df = normalize_missing(df)
    cols = list(cols) if cols is not None else numeric_columns(df)
    q = column_quantiles(df, cols, [0.5])
    return _fill_with(df, {x: q[x][0] for x in cols})


def impute_mode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """M7: most frequent value (smallest on ties), computed as a distributed
    count per value followed by a top-1."""
    df = normalize_missing(df)
    cols = list(cols) if cols is not None else df.columns
    fills = {}
    for x in cols:
        top = (
            df.where(c(x).isNotNull())
            .groupBy(c(x).alias("v"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("v"))
            .limit(1)
            .collect()
        )
        fills[x] = top[0]["v"] if top else None
    types = dict(df.dtypes)
    return df.select(
        *[(F.coalesce(c(x), F.lit(fills[x]).cast(types[x])).alias(x) if x in fills else c(x)) for x in df.columns]
    )


def impute_class_mean(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """M8: null -> mean of the row's class. The per-class table has one row per
    class; it is broadcast only when that count is checked to be small, else
    joined by shuffle. Rows with a null target are unchanged."""
    cols = list(cols) if cols is not None else [x for x in numeric_columns(df) if x != target]
    means = df.where(c(target).isNotNull()).groupBy(c(target).alias("__t")).agg(
        *[F.avg(c(x)).alias(f"__m{i}") for i, x in enumerate(cols)]
    )
    n_classes = means.count()
    side = F.broadcast(means) if n_classes <= SMALL_TABLE_ROWS else means
    joined = df.join(side, c(target).eqNullSafe(F.col("__t")), "left")
    idx = {x: i for i, x in enumerate(cols)}
    return joined.select(
        *[
            (F.coalesce(c(x).cast("double"), F.col(f"__m{idx[x]}")).alias(x) if x in idx else c(x))
            for x in df.columns
        ]
    )


def _directional_fill(df: DataFrame, cols: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str],
                      reverse: bool, n_buckets: int | None) -> DataFrame:
    """Fill in order and then fill the remainder the other way.

    Rows are range-partitioned by partition keys and all order columns, so that
    neither a hot partition key nor a hot order value is sorted in one task; a
    carry table of one row per (partition key, range partition) passes the
    last non-null value across the borders.
    """
    pk = [c(p) for p in partition_by]
    o = [c(x).desc() if reverse else c(x).asc() for x in order_by]
    b = placed(df, [*pk, *[c(x).asc() for x in order_by]], n_buckets)
    bucket_dir = F.col("__b").desc() if reverse else F.col("__b").asc()
    w_in = Window.partitionBy(*pk, "__b").orderBy(*o)
    run = w_in.rowsBetween(Window.unboundedPreceding, 0)
    local = b.select(
        "*",
        *[F.last(c(x), ignorenulls=True).over(run).alias(f"__l{i}") for i, x in enumerate(cols)],
    )
    key = F.struct(*[c(x) for x in order_by])
    last_by, first_by = (F.min_by, F.max_by) if reverse else (F.max_by, F.min_by)
    carry = b.groupBy(*pk, "__b").agg(
        *[last_by(c(x), F.when(c(x).isNotNull(), key)).alias(f"__cl{i}") for i, x in enumerate(cols)],
        *[first_by(c(x), F.when(c(x).isNotNull(), key)).alias(f"__cf{i}") for i, x in enumerate(cols)],
    )
    wc = Window.partitionBy(*pk).orderBy(bucket_dir)
    prev = wc.rowsBetween(Window.unboundedPreceding, -1)
    allw = wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = carry.select(
        *[c(p).alias(f"__p{j}") for j, p in enumerate(partition_by)], F.col("__b").alias("__cb"),
        *[F.last(f"__cl{i}", ignorenulls=True).over(prev).alias(f"__prev{i}") for i in range(len(cols))],
        *[F.first(f"__cf{i}", ignorenulls=True).over(allw).alias(f"__first{i}") for i in range(len(cols))],
    )
    cond = F.col("__b") == F.col("__cb")
    for j, p in enumerate(partition_by):
        cond = cond & c(p).eqNullSafe(F.col(f"__p{j}"))
    joined = local.join(carry, cond, "left")
    idx = {x: i for i, x in enumerate(cols)}
    return joined.select(
        *[
            (F.coalesce(c(x), F.col(f"__l{idx[x]}"), F.col(f"__prev{idx[x]}"), F.col(f"__first{idx[x]}")).alias(x)
             if x in idx else c(x))
            for x in df.columns
        ]
    )


def impute_ffill(df: DataFrame, cols: Sequence[str], order_by: Sequence[str],
                 partition_by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """M5: last non-null value in order (within partition_by); leading nulls
    then take the first non-null value. ``order_by`` must be a total order
    (end it with a unique id)."""
    return _directional_fill(df, cols, list(order_by), list(partition_by), False, n_buckets)


def impute_bfill(df: DataFrame, cols: Sequence[str], order_by: Sequence[str],
                 partition_by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """M6: next non-null value in order; trailing nulls take the last one."""
    return _directional_fill(df, cols, list(order_by), list(partition_by), True, n_buckets)


def impute(df: DataFrame, global_strategy: str | None, per_column: Mapping[str, str] | None = None,
           order_by: Sequence[str] | None = None, target: str | None = None, id_col: str | None = None,
           k: int = 5) -> DataFrame:
    """Per-column strategies first (mean, median, ffill, bfill, drop),
    then the global strategy on what is left. A global strategy of None
    skips everything (reference behaviour)."""
    if global_strategy is None:
        return df
    per_column = dict(per_column or {})
    out = normalize_missing(df)
    for strat in ("mean", "median"):
        cols = [x for x, s in per_column.items() if s == strat]
        if cols:
            out = impute_mean(out, cols) if strat == "mean" else impute_median(out, cols)
    for strat in ("ffill", "bfill"):
        cols = [x for x, s in per_column.items() if s == strat]
        if cols:
            if not order_by:
                raise ValueError("ffill/bfill need order_by")
            out = (impute_ffill if strat == "ffill" else impute_bfill)(out, cols, order_by)
    drops = [x for x, s in per_column.items() if s == "drop"]
    if drops:
        out = out.drop(*drops)
    g = global_strategy
    if g == "drop_rows":
        return out.na.drop("any")
    if g == "drop_columns":
        return drop_missing_columns(out)
    if g == "mean":
        return impute_mean(out)
    if g == "median":
        return impute_median(out)
    if g == "mode":
        return impute_mode(out)
    if g in ("ffill", "bfill"):
        if not order_by:
            raise ValueError("ffill/bfill need order_by")
        cols = [x for x in out.columns if x not in order_by]
        return (impute_ffill if g == "ffill" else impute_bfill)(out, cols, order_by)
    if g == "class_mean":
        if target is None:
            raise ValueError("class_mean needs a target")
        return impute_class_mean(out, target)
    if g == "knn":
        from .knn import impute_knn

        if id_col is None:
            raise ValueError("knn needs an id column")
        return impute_knn(out, id_col, [x for x in numeric_columns(out) if x not in (id_col, target)], k)
    raise ValueError(f"unknown strategy {g!r}")
