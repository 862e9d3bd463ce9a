"""IQR and z-score outliers. Quantiles come from the bounded-memory exact
helper; masks and counts are projections and one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from .profile import c


def iqr_bounds(df: DataFrame, cols: Sequence[str], factor: float = 1.5) -> dict[str, tuple]:
    """(q1, q3, lower, upper) per column; None when the column is all null."""
    q = column_quantiles(df, cols, [0.25, 0.75])
    out = {}
    for x in cols:
        q1, q3 = q[x]
        if q1 is None:
            out[x] = (None, None, None, None)
        else:
            iqr = q3 - q1
            out[x] = (q1, q3, q1 - factor * iqr, q3 + factor * iqr)
    return out


def _outside(x: str, lo: float, hi: float):
    return (c(x) < F.lit(lo)) | (c(x) > F.lit(hi))


def detect_outliers_iqr(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """O1: bounds Q1-1.5 IQR / Q3+1.5 IQR; outliers strictly outside; null is
    not an outlier; percentage of all rows."""
    spark = df.sparkSession
    b = iqr_bounds(df, cols)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, x in enumerate(cols):
        q1, q3, lo, hi = b[x]
        aggs.append(F.count_if(_outside(x, lo, hi)).alias(f"o{i}") if lo is not None else F.lit(0).alias(f"o{i}"))
    row = df.agg(*aggs).first()
    n = row["__n"]

    def r(v):
        return None if v is None else round(float(v), digits)

    rows = []
    for i, x in enumerate(cols):
        q1, q3, lo, hi = b[x]
        k = int(row[f"o{i}"])
        rows.append((x, r(q1), r(q3), r(lo), r(hi), k, round(k * 100.0 / n, digits) if n else 0.0))
    return spark.createDataFrame(
        rows, "column string, q1 double, q3 double, lower double, upper double, n_outliers bigint, pct_outliers double"
    )


def outlier_mask(df: DataFrame, cols: Sequence[str], name: str = "is_outlier") -> DataFrame:
    """Row-level mask: outside the IQR fences in any of the columns."""
    b = iqr_bounds(df, cols)
    conds = [F.coalesce(_outside(x, b[x][2], b[x][3]), F.lit(False)) for x in cols if b[x][2] is not None]
    mask = F.lit(False)
    for cond in conds:
        mask = mask | cond
    return df.withColumn(name, mask)


def remove_outliers_iqr(df: DataFrame, cols: Sequence[str], mode: str = "sequential") -> DataFrame:
    """O2: keep lo <= x <= hi per column; rows null in a processed column are
    dropped. ``sequential`` recomputes the bounds of each column on the rows
    left by the previous one (reference order); ``simultaneous`` uses the
    bounds of the full table in one filter."""
    if mode not in ("sequential", "simultaneous"):
        raise ValueError("mode must be 'sequential' or 'simultaneous'")
    out = df
    if mode == "simultaneous":
        b = iqr_bounds(df, cols)
        for x in cols:
            if b[x][2] is not None:
                out = out.where(c(x).between(b[x][2], b[x][3]))
        return out
    for x in cols:
        b = iqr_bounds(out, [x])[x]
        if b[2] is None:
            continue
        out = out.where(c(x).between(b[2], b[3]))
    return out


def boxplot_stats(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """O3: quartiles, whiskers (extreme values inside the fences), mean, sd."""
    spark = df.sparkSession
    b = iqr_bounds(df, cols)
    aggs = []
    for i, x in enumerate(cols):
        q1, q3, lo, hi = b[x]
        inside = c(x).between(lo, hi) if lo is not None else F.lit(False)
        aggs += [
            F.min(F.when(inside, c(x))).cast("double").alias(f"wl{i}"),
            F.max(F.when(inside, c(x))).cast("double").alias(f"wh{i}"),
            F.avg(c(x)).alias(f"m{i}"),
            F.stddev_samp(c(x)).alias(f"s{i}"),
        ]
    row = df.agg(*aggs).first()

    def r(v):
        return None if v is None else round(float(v), digits)

    rows = [
        (x, r(b[x][0]), r(b[x][1]), r(b[x][2]), r(b[x][3]), r(row[f"wl{i}"]), r(row[f"wh{i}"]), r(row[f"m{i}"]), r(row[f"s{i}"]))
        for i, x in enumerate(cols)
    ]
    return spark.createDataFrame(
        rows,
        "column string, q1 double, q3 double, lower_fence double, upper_fence double, "
        "whisker_low double, whisker_high double, mean double, sd double",
    )


def detect_outliers_zscore(df: DataFrame, cols: Sequence[str], z: float = 3.0, digits: int = 4) -> DataFrame:
    """|x - mean| / sd_pop > z (sd 0 -> no outliers)."""
    spark = df.sparkSession
    st = df.agg(*[F.avg(c(x)).alias(f"m{i}") for i, x in enumerate(cols)],
                *[F.stddev_pop(c(x)).alias(f"s{i}") for i, x in enumerate(cols)], F.count(F.lit(1)).alias("__n")).first()
    aggs = []
    for i, x in enumerate(cols):
        m, s = st[f"m{i}"], st[f"s{i}"]
        if m is None or not s:
            aggs.append(F.lit(0).alias(f"o{i}"))
        else:
            aggs.append(F.count_if(F.abs((c(x) - F.lit(m)) / F.lit(s)) > z).alias(f"o{i}"))
    row = df.agg(*aggs).first()
    n = st["__n"]
    rows = [
        (x, None if st[f"m{i}"] is None else round(st[f"m{i}"], digits),
         None if st[f"s{i}"] is None else round(st[f"s{i}"], digits),
         int(row[f"o{i}"]), round(int(row[f"o{i}"]) * 100.0 / n, digits) if n else 0.0)
        for i, x in enumerate(cols)
    ]
    return spark.createDataFrame(rows, "column string, mean double, sd double, n_outliers bigint, pct_outliers double")
