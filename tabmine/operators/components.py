"""Connected components of an edge DataFrame by min-label propagation with
pointer jumping. Each round is a couple of joins and one aggregate; the
label table is checkpointed to the shared checkpoint folder every round so
lineage stays short and a lost executor only costs the current round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """vertices(id), edges(a, b) undirected -> (id, comp) with comp = the
    smallest id of the component. Rounds go on until no label changes; labels
    only fall, so they end."""
    lab = cut_lineage(vertices.select(F.col("id"), F.col("id").alias("comp")).distinct())
    e = edges.select("a", "b").where(F.col("a") != F.col("b"))
    e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = cut_lineage(e)
    while True:
        # propagate: each vertex takes the smallest label among its neighbours
        cand = e.join(lab.withColumnRenamed("id", "b").withColumnRenamed("comp", "lb"), "b").groupBy(
            F.col("a").alias("id")).agg(F.min("lb").alias("cand"))
        step = lab.join(cand, "id", "left").select("id", F.col("comp").alias("old"), F.least("comp", F.coalesce("cand", "comp")).alias("comp"))
        # pointer jumping: follow the label's own label
        hop = step.alias("s").join(step.select(F.col("id").alias("cid"), F.col("comp").alias("cc")),
                                   F.col("s.comp") == F.col("cid"), "left")
        new = cut_lineage(hop.select("id", "old", F.least("comp", F.coalesce("cc", "comp")).alias("comp")))
        changed = new.where(F.col("comp") != F.col("old")).limit(1).count()
        lab = new.select("id", "comp")
        if changed == 0:
            return lab
