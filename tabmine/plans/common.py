"""Shared inputs of the registered queries: table loaders, row ids and the
rule-derived columns used identically by each Spark query and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Row id of lineitem (its natural keys collide), same expression in SQL.
LI_ID_SQL = (
    "md5(concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar), "
    "cast(l_suppkey as varchar), cast(l_linenumber as varchar), "
    "cast(cast(round(l_extendedprice*100) as bigint) as varchar)))"
)
Q_NULL_SQL = "CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_quantity END"
PRIORITY_TOKENS_SQL = (
    "CASE WHEN o_orderkey % 7 = 0 THEN '?' WHEN o_orderkey % 11 = 0 THEN ' ' ELSE o_orderpriority END"
)
EV_NULL_SQL = "CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def li_id():
    return F.md5(
        F.concat_ws(
            "|",
            F.col("l_orderkey").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        )
    )


def lineitem(spark: SparkSession, sf: str, with_nulls: bool = False) -> DataFrame:
    df = table(spark, sf, "lineitem").withColumn("id", li_id())
    if with_nulls:
        df = df.withColumn("q_null", F.expr(Q_NULL_SQL))
    return df


def orders_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("priority", F.expr(PRIORITY_TOKENS_SQL))


def events_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("v_null", F.expr(EV_NULL_SQL))


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """vec_id, vec ARRAY<DOUBLE>, label."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("vec"), "label")


def customer_2d(spark: SparkSession, sf: str) -> DataFrame:
    """customer scaled to two features in [0, 1]: balance and nation."""
    cu = table(spark, sf, "customer")
    return cu.select(
        "c_custkey",
        ((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)).alias("x"),
        (F.col("c_nationkey").cast("double") / F.lit(24.0)).alias("y"),
    )


CUSTOMER_2D_SQL = (
    "SELECT c_custkey, (c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE AS x, "
    "c_nationkey::DOUBLE / 24.0::DOUBLE AS y FROM customer"
)
