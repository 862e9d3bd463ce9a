"""Profiling, projections, filters and validation (one aggregate pass each)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import column_quantiles


def c(name: str):
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by schema, no job."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def nanvl_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN -> NULL on float features (Spark treats NaN as a large value)."""
    types = dict(df.dtypes)
    return df.select(
        *[
            (F.nanvl(c(x), F.lit(None).cast("double")).alias(x) if x in cols and types[x] in ("double", "float") else c(x))
            for x in df.columns
        ]
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, name, type, n_rows, n_columns)."""
    spark = df.sparkSession
    n = df.count()
    rows = [(i, f.name, f.dataType.simpleString(), n, len(df.columns)) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, n_rows bigint, n_columns int")


def head(df: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    """First n rows by id (planned as TakeOrderedAndProject)."""
    return df.orderBy(c(id_col)).limit(n)


def five_number_summary(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """Min, Q1, median, Q3, max per column, linear interpolation, nulls skipped."""
    spark = df.sparkSession
    cols = list(cols) if cols is not None else numeric_columns(df)
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    mm = df.agg(*[F.min(c(x)).cast("double").alias(f"mn{i}") for i, x in enumerate(cols)],
                *[F.max(c(x)).cast("double").alias(f"mx{i}") for i, x in enumerate(cols)]).first()

    def r(v):
        return None if v is None else round(float(v), digits)

    rows = [
        (x, r(mm[f"mn{i}"]), r(q[x][0]), r(q[x][1]), r(q[x][2]), r(mm[f"mx{i}"]))
        for i, x in enumerate(cols)
    ]
    return spark.createDataFrame(rows, "column string, min double, q1 double, median double, q3 double, max double")


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5: null count and percentage per column, plus the table total, from one pass."""
    cols = list(cols) if cols is not None else df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(c(x).isNull()).alias(f"m{i}") for i, x in enumerate(cols)])
    stack = ", ".join(f"'{x.replace(chr(39), chr(39) * 2)}', m{i}" for i, x in enumerate(cols))
    long = agg.selectExpr("__n", f"stack({len(cols)}, {stack}) as (column, n_missing)")
    return long.select(
        "column",
        F.col("n_missing").cast("bigint").alias("n_missing"),
        F.round(F.when(F.col("__n") > 0, F.col("n_missing") * 100.0 / F.col("__n")).otherwise(0.0), 4).alias("pct_missing"),
        F.sum("n_missing").over(__whole()).cast("bigint").alias("total_missing"),
    )


def __whole():
    from pyspark.sql import Window

    # the long table holds one row per column: a whole-frame window over it is tiny
    return Window.partitionBy(F.lit(0))


def filter_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """AND of inclusive ranges (unknown columns ignored, nulls dropped);
    pushed to the Parquet scan by Catalyst."""
    conds = [c(k).between(lo, hi) for k, (lo, hi) in ranges.items() if k in df.columns]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def select_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Projection."""
    return df.select(*[c(x) for x in cols])


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count per class, number of classes, max/min ratio, imbalance flag (max > 10 min)."""
    from pyspark.sql import Window

    counts = df.groupBy(c(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0))  # one row per class: small
    return counts.select(
        "class",
        "n",
        F.count(F.lit(1)).over(w).alias("n_classes"),
        F.round(F.max("n").over(w) / F.min("n").over(w), 4).alias("imbalance_ratio"),
        (F.max("n").over(w) > F.min("n").over(w) * 10).alias("imbalanced"),
    )


def is_continuous_target(df: DataFrame, col: str) -> DataFrame:
    """Float column and (> 20 distinct or > half the rows distinct or any
    fractional value). Also warns above 50 classes."""
    dtype = dict(df.dtypes)[col]
    is_float = dtype in ("double", "float") or dtype.startswith("decimal")
    x = c(col)
    agg = df.agg(
        F.count_distinct(x).alias("n_unique"),
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.max((x.cast("double") != F.floor(x.cast("double"))).cast("int")), F.lit(0)).alias("frac"),
    )
    cont = F.lit(is_float) & ((F.col("n_unique") > 20) | (F.col("n_unique") > F.col("n_rows") * 0.5) | (F.col("frac") == 1))
    return agg.select(
        F.lit(col).alias("column"),
        F.col("n_unique").cast("bigint").alias("n_unique"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
        (F.col("frac") == 1).alias("has_fraction"),
        cont.alias("continuous"),
        (F.col("n_unique") > 50).alias("many_classes"),
    )


# Per-algorithm requirements (min_samples, min_features,
# requires_no_missing, requires_non_negative, min_classes, partition_or_hierarchical).
ALGORITHM_RULES = {
    "KMeans": (3, 1, True, False, None, True),
    "K-Medoids": (3, 1, True, False, None, True),
    "DBSCAN": (5, 1, True, False, None, False),
    "AGNES": (3, 1, True, False, None, True),
    "DIANA": (3, 1, True, False, None, True),
    "k-NN": (10, 1, True, False, 2, False),
    "Naive Bayes": (5, 1, True, True, 2, False),
    "C4.5": (5, 1, True, False, 2, False),
    "SVM": (10, 1, True, False, 2, False),
}


def validate_table(df: DataFrame | None) -> tuple[bool, str]:
    """A table is usable with at least one numeric column; nulls are
    allowed. (ok, message) from the schema alone."""
    if df is None:
        return False, "no table given"
    if not numeric_columns(df):
        return False, "the table needs at least 1 numeric column"
    return True, ""


def validate_algorithm(df: DataFrame, features: Sequence[str], algo: str, target: str | None = None) -> DataFrame:
    """All checks of one algorithm from a single aggregate pass; output
    (check, severity, observed, limit, ok)."""
    if algo not in ALGORITHM_RULES:
        raise ValueError(f"unknown algorithm {algo!r}")
    min_samples, min_features, no_missing, non_neg, min_classes, part = ALGORITHM_RULES[algo]
    aggs = [
        F.count(F.lit(1)).alias("n"),
        reduce(lambda a, b: a + b, [F.count_if(c(x).isNull()) for x in features], F.lit(0)).alias("missing"),
        reduce(lambda a, b: a + b, [F.count_if(c(x) < 0) for x in features], F.lit(0)).alias("negative"),
    ]
    checks = [
        ("min_samples", "error", "n", F.lit(min_samples), F.col("n") >= min_samples),
        ("min_features", "error", F.lit(len(features)), F.lit(min_features), F.lit(len(features) >= min_features)),
    ]
    if no_missing:
        checks.append(("no_missing", "error", "missing", F.lit(0), F.col("missing") == 0))
    if non_neg:
        checks.append(("non_negative", "warning", "negative", F.lit(0), F.col("negative") == 0))
    if part:
        checks.append(("clusters_possible", "error", F.col("n") - 1, F.lit(2), F.col("n") - 1 >= 2))
    base = df.agg(*aggs)
    if target is not None and min_classes is not None:
        cls = df.groupBy(c(target)).agg(F.count(F.lit(1)).alias("cn")).agg(
            F.count(F.lit(1)).alias("n_classes"), F.min("cn").alias("min_class")
        ).first()  # one row of two counters
        n_cls, min_cls = int(cls["n_classes"]), cls["min_class"]
        checks.append(("min_classes", "error", F.lit(n_cls), F.lit(min_classes), F.lit(n_cls >= min_classes)))
        checks.append(("min_class_count", "warning", F.lit(min_cls), F.lit(2),
                       F.lit(min_cls is not None and min_cls >= 2)))
    parts = []
    for name, sev, obs, limit, ok in checks:
        obs_col = F.col(obs) if isinstance(obs, str) else obs
        parts.append(
            base.select(
                F.lit(name).alias("check"),
                F.lit(sev).alias("severity"),
                obs_col.cast("bigint").alias("observed"),
                limit.cast("bigint").alias("limit"),
                ok.alias("ok"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def validate_params(algo: str, params: Mapping[str, float], n: int) -> list[str]:
    """Driver-side argument check; returns error messages."""
    errors = []
    if algo in ("KMeans", "K-Medoids", "AGNES", "DIANA"):
        k = int(params.get("n_clusters", 2))
        if k < 2 or k >= n:
            errors.append(f"n_clusters must satisfy 2 <= k < {n}")
    if algo == "DBSCAN":
        if float(params.get("eps", 0.5)) <= 0:
            errors.append("eps must be > 0")
        if int(params.get("min_samples", 5)) >= n:
            errors.append(f"min_samples must be < {n}")
    return errors


def binary_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, whether all values are 0/1 (or null) and whether any is negative."""
    agg = df.agg(
        *[F.coalesce(F.bool_and(c(x).isin(0, 1) | c(x).isNull()), F.lit(True)).alias(f"b{i}") for i, x in enumerate(cols)],
        *[F.coalesce(F.bool_or(c(x) < 0), F.lit(False)).alias(f"g{i}") for i, x in enumerate(cols)],
    )
    stack = ", ".join(f"'{x}', b{i}, g{i}" for i, x in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column, is_binary, has_negative)")


def seeded_order(id_col: str, seed: int = 42):
    """Deterministic pseudo-random order key shared with SQL twins."""
    return F.md5(F.concat(c(id_col).cast("string"), F.lit(str(seed))))


def sample_for_plot(df: DataFrame, id_col: str, n: int = 500, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, deterministic by seeded hash (top-n,
    planned as TakeOrderedAndProject: each task keeps n rows)."""
    return df.withColumn("__o", seeded_order(id_col, seed)).orderBy("__o", c(id_col)).limit(n).drop("__o")
