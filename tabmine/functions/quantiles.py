"""Exact, linearly interpolated quantiles with bounded memory.

Spark's exact ``percentile`` keeps a value -> count map per group; for a
global quantile of a near-unique column that map ends in one reducer. Here
the exact aggregate is used only when the distinct count of the column is
bounded; otherwise each quantile is bracketed by ``percentile_approx`` and the
bracket is narrowed until it holds few rows, whose sorted values then give
the exact order statistics. Every pass is one distributed aggregate; only
scalars reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT_DISTINCT_BOUND = 2_000_000
BRACKET_ROWS_BOUND = 200_000
APPROX_ACCURACY = 10_000


def _interp(lo_val: float, hi_val: float, frac: float) -> float:
    if frac == 0.0 or lo_val == hi_val:
        return lo_val
    return lo_val + frac * (hi_val - lo_val)


def _targets(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    out = []
    for p in probs:
        h = (n - 1) * p
        r0 = int(math.floor(h))
        r1 = min(r0 + 1, n - 1) if h > r0 else r0
        out.append((r0, r1, h - r0))
    return out


def _order_statistics(df: DataFrame, col: str, n: int, ranks: Sequence[int], bound: int) -> dict[int, float]:
    """Exact values at 0-based ranks among the ``n`` non-null rows of a column.

    Each rank keeps an open bracket (lo, hi). A pass takes three approximate
    quantiles around the rank inside the bracket and counts the rows below and
    up to each: either one of them is the answer (any number of equal values
    counts as one), or the bracket narrows to the gap between two of them,
    which leaves out at least one value. Brackets of at most ``bound`` rows are
    sorted. So the loop ends for every column."""
    x = F.col(col)
    lo: dict[int, float | None] = dict.fromkeys(ranks)
    hi: dict[int, float | None] = dict.fromkeys(ranks)
    below = dict.fromkeys(ranks, 0)
    inside = dict.fromkeys(ranks, n)
    result: dict[int, float] = {}

    def bracket(r: int) -> Column:
        cond = x.isNotNull()
        if lo[r] is not None:
            cond = cond & (x > F.lit(lo[r]))
        if hi[r] is not None:
            cond = cond & (x < F.lit(hi[r]))
        return cond

    pending = sorted(lo)
    margin = 2.0 / APPROX_ACCURACY
    while pending:
        small = [r for r in pending if inside[r] <= bound]
        large = [r for r in pending if inside[r] > bound]
        aggs = [F.sort_array(F.collect_list(F.when(bracket(r), x))).alias(f"v{r}") for r in small]
        for r in large:
            p = (r - below[r]) / max(inside[r] - 1, 1)
            aggs.append(F.percentile_approx(F.when(bracket(r), x), [max(0.0, p - margin), p, min(1.0, p + margin)], APPROX_ACCURACY).alias(f"a{r}"))
        row = df.agg(*aggs).first()
        for r in small:
            result[r] = float(row[f"v{r}"][r - below[r]])
        pivots = {r: sorted(set(map(float, row[f"a{r}"]))) for r in large}
        if large:
            cnt = df.agg(
                *[F.count_if(x < F.lit(v)).alias(f"l{r}_{k}") for r in large for k, v in enumerate(pivots[r])],
                *[F.count_if(x <= F.lit(v)).alias(f"e{r}_{k}") for r in large for k, v in enumerate(pivots[r])],
            ).first()
        for r in large:
            top = below[r] + inside[r]
            for k, v in enumerate(pivots[r]):
                less, upto = cnt[f"l{r}_{k}"], cnt[f"e{r}_{k}"]
                if upto <= r:
                    lo[r], below[r] = v, upto
                elif less <= r:
                    result[r] = v
                    break
                else:
                    hi[r], top = v, less
                    break
            inside[r] = top - below[r]
        pending = [r for r in large if r not in result]
    return result


def _bracketed(df: DataFrame, col: str, n: int, probs: Sequence[float], bound: int) -> list[float]:
    """Exact interpolated quantiles of a column from its order statistics."""
    targets = _targets(n, probs)
    got = _order_statistics(df, col, n, sorted({r for a, b, _ in targets for r in (a, b)}), bound)
    return [_interp(got[a], got[b], frac) for a, b, frac in targets]


def column_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    distinct_bound: int = EXACT_DISTINCT_BOUND,
    bracket_bound: int = BRACKET_ROWS_BOUND,
) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles (pandas/numpy 'linear') per column.

    Nulls are skipped; an all-null column yields ``None`` values.
    """
    probs = [float(p) for p in probs]
    if not cols:
        return {}
    stats = df.agg(
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.approx_count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)],
    ).first()
    out: dict[str, list[float | None]] = {}
    exact_cols = []
    for i, c in enumerate(cols):
        n = int(stats[f"n{i}"])
        if n == 0:
            out[c] = [None] * len(probs)
        elif int(stats[f"d{i}"]) <= distinct_bound:
            exact_cols.append(c)
        else:
            out[c] = _bracketed(df, c, n, probs, bracket_bound)
    if exact_cols:
        row = df.agg(
            *[F.percentile(F.col(c).cast("double"), probs).alias(f"q{j}") for j, c in enumerate(exact_cols)]
        ).first()
        for j, c in enumerate(exact_cols):
            out[c] = [float(v) for v in row[f"q{j}"]]
    return out


def order_statistics(df: DataFrame, col: str, ranks: Sequence[int],
                     bracket_bound: int = BRACKET_ROWS_BOUND) -> list[float | None]:
    """Exact values at 0-based ranks of the ascending non-null column."""
    n = int(df.agg(F.count(F.col(col)).alias("n")).first()["n"])
    got = _order_statistics(df, col, n, sorted({r for r in ranks if 0 <= r < n}), bracket_bound)
    return [got.get(r) for r in ranks]


def quantile_columns(cols: Sequence[str], probs: Sequence[float]) -> list[Column]:
    """Aggregate expressions for the exact quantiles of bounded-cardinality
    columns, for use inside a grouped ``agg``."""
    return [F.percentile(F.col(c).cast("double"), list(probs)).alias(c) for c in cols]
