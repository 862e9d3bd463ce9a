"""Global running sums without a single-partition window.

Rows are range-partitioned by all order columns, so that equal keys spread
over partitions by their ties, and checkpointed with the number of their
partition. Running sums are computed inside each partition, and a carry table
with one row per partition adds the totals of all earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def placed(df: DataFrame, order: Sequence[Column], n_parts: int | None = None, name: str = "__b") -> DataFrame:
    """``df`` range-partitioned by ``order``, with its partition number (rising
    in that order) as a stored column."""
    if n_parts is None:
        n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(max(1, n_parts), *order).withColumn(name, F.spark_partition_id()))


def running_sums(df: DataFrame, key: str, value_cols: Sequence[str], descending: bool = False,
                 n_buckets: int | None = None, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Adds ``cum_<v>`` = sum of v over all rows up to and including this one
    in (key, tie_cols) order. Keys may be of any ordered type."""
    order = [F.col(key).desc() if descending else F.col(key).asc()] + [F.col(t).asc() for t in tie_cols]
    b = placed(df, order, n_buckets)
    w = Window.partitionBy("__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = b.select("*", *[F.sum(v).over(w).alias(f"__lc_{v}") for v in value_cols])
    totals = b.groupBy("__b").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    # carry table: one row per partition
    wc = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col("__b").alias("__cb"),
                          *[F.coalesce(F.sum(f"__t_{v}").over(wc), F.lit(0)).alias(f"__c_{v}") for v in value_cols])
    joined = local.join(F.broadcast(carry), F.col("__b") == F.col("__cb"), "left")
    return joined.select(
        *[F.col(x) for x in df.columns],
        *[(F.col(f"__lc_{v}") + F.col(f"__c_{v}")).alias(f"cum_{v}") for v in value_cols],
    )


def row_index(df: DataFrame, order_cols: Sequence[str], out: str = "idx") -> DataFrame:
    """Adds ``out`` = 0-based row number in the order of ``order_cols`` (of any type)."""
    one = df.withColumn("__one", F.lit(1).cast("bigint"))
    got = running_sums(one, order_cols[0], ["__one"], tie_cols=order_cols[1:])
    return got.withColumn(out, F.col("cum___one") - 1).drop("__one", "cum___one")
