"""Normalisation and discretisation. Each scaler is fit (one aggregate, a few
scalars to the driver) and transform (a projection); fitted parameters can
be applied to another DataFrame (train statistics on test rows)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from .profile import c, numeric_columns


@dataclass
class Scaler:
    """Per-column (shift, divisor, offset): x -> (x - shift) / divisor * mult + offset."""

    kind: str
    params: dict[str, tuple[float, float, float, float]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for x in df.columns:
            if x in self.params:
                shift, div, mult, off = self.params[x]
                out.append(((c(x).cast("double") - F.lit(shift)) / F.lit(div) * F.lit(mult) + F.lit(off)).alias(x))
            else:
                out.append(c(x))
        return df.select(*out)

    def inverse(self, df: DataFrame) -> DataFrame:
        out = []
        for x in df.columns:
            if x in self.params:
                shift, div, mult, off = self.params[x]
                out.append(((c(x) - F.lit(off)) / F.lit(mult) * F.lit(div) + F.lit(shift)).alias(x))
            else:
                out.append(c(x))
        return df.select(*out)


def fit_minmax(df: DataFrame, cols: Sequence[str], lo: float = 0.0, hi: float = 1.0) -> Scaler:
    row = df.agg(*[F.min(c(x)).cast("double").alias(f"a{i}") for i, x in enumerate(cols)],
                 *[F.max(c(x)).cast("double").alias(f"b{i}") for i, x in enumerate(cols)]).first()
    p = {}
    for i, x in enumerate(cols):
        mn, mx = row[f"a{i}"], row[f"b{i}"]
        if mn is None:
            continue
        rng = mx - mn
        p[x] = (mn, rng if rng != 0 else 1.0, hi - lo, lo)
    return Scaler("minmax", p)


def scale_minmax(df: DataFrame, cols: Sequence[str] | None = None, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """(x-min)/(max-min)*(hi-lo)+lo; nulls kept; a constant column maps to lo."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return fit_minmax(df, cols, lo, hi).transform(df)


def fit_zscore(df: DataFrame, cols: Sequence[str]) -> Scaler:
    row = df.agg(*[F.avg(c(x)).alias(f"m{i}") for i, x in enumerate(cols)],
                 *[F.stddev_pop(c(x)).alias(f"s{i}") for i, x in enumerate(cols)]).first()
    p = {}
    for i, x in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is None:
            continue
        p[x] = (m, s if s else 1.0, 1.0, 0.0)
    return Scaler("zscore", p)


def scale_zscore(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Population standard deviation; sd 0 -> all zeros."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return fit_zscore(df, cols).transform(df)


def decimal_divisor(max_abs: float | None, strict: bool = False) -> float | None:
    """Literal rule: 10^(digits(int(max|x|)) - 1); strict rule: smallest 10^j
    with max|x| / 10^j < 1. None when max|x| <= 0 or null."""
    if max_abs is None or max_abs <= 0:
        return None
    if strict:
        j = 0
        while max_abs / (10.0 ** j) >= 1.0:
            j += 1
        return float(10 ** j)
    return float(10 ** (len(str(int(max_abs))) - 1))


def scale_decimal(df: DataFrame, cols: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """Divide by a power of ten chosen from max |x|."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    row = df.agg(*[F.max(F.abs(c(x))).cast("double").alias(f"m{i}") for i, x in enumerate(cols)]).first()
    p = {}
    for i, x in enumerate(cols):
        d = decimal_divisor(row[f"m{i}"], strict)
        if d is not None:
            p[x] = (0.0, d, 1.0, 0.0)
    return Scaler("decimal", p).transform(df)


def fit_robust(df: DataFrame, cols: Sequence[str]) -> Scaler:
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    p = {}
    for x in cols:
        q1, med, q3 = q[x]
        if med is None:
            continue
        iqr = q3 - q1
        p[x] = (med, iqr if iqr != 0 else 1.0, 1.0, 0.0)
    return Scaler("robust", p)


def scale_robust(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(x - median) / IQR; IQR 0 -> divide by 1."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return fit_robust(df, cols).transform(df)


def normalise(df: DataFrame, strategy: str, cols: Sequence[str] | None = None, target: str | None = None) -> DataFrame:
    """Strategy dispatch over numeric columns (target excluded by default)."""
    cols = list(cols) if cols is not None else [x for x in numeric_columns(df) if x != target]
    if strategy == "minmax":
        return scale_minmax(df, cols)
    if strategy == "zscore":
        return scale_zscore(df, cols)
    if strategy == "decimal":
        return scale_decimal(df, cols)
    if strategy == "robust":
        return scale_robust(df, cols)
    if strategy in (None, "none"):
        return df
    raise ValueError(f"unknown normalisation {strategy!r}")


# ---- discretisation ---------------------------------------------------------

def equal_width_edges(mn: float, mx: float, n: int) -> list[float]:
    """Inner edges e_1..e_{n-1} of n equal intervals; a zero range is widened
    by 0.1 % on each side first (pandas rule)."""
    if mn == mx:
        a = abs(mn) * 0.001 if mn != 0 else 0.001
        mn, mx = mn - a, mx + a
    step = (mx - mn) / n
    return [mn + i * step for i in range(1, n)]


def _count_below(x, edges: Sequence[float]):
    """Right-closed bin index = number of inner edges strictly below x."""
    if not edges:
        return F.when(x.isNotNull(), F.lit(0))
    expr = F.lit(0)
    for e in edges:
        expr = expr + F.when(x > F.lit(e), 1).otherwise(0)
    return F.when(x.isNotNull(), expr)


def bin_equal_width(df: DataFrame, col: str, n: int = 5, out: str | None = None) -> DataFrame:
    """Codes 0..n-1, right-closed equal intervals, minimum in bin 0."""
    row = df.agg(F.min(c(col)).cast("double").alias("a"), F.max(c(col)).cast("double").alias("b")).first()
    out = out or f"{col}_bin"
    if row["a"] is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    return df.withColumn(out, _count_below(c(col).cast("double"), equal_width_edges(row["a"], row["b"], n)).cast("int"))


def bin_equal_freq(df: DataFrame, col: str, n: int = 5, out: str | None = None) -> DataFrame:
    """Right-closed bins on exact linear quantiles; duplicate edges dropped."""
    probs = [i / n for i in range(n + 1)]
    q = column_quantiles(df, [col], probs)[col]
    out = out or f"{col}_bin"
    if q[0] is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    edges = sorted(set(q))
    return df.withColumn(out, _count_below(c(col).cast("double"), edges[1:-1]).cast("int"))
