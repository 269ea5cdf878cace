"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import staged

JUMPS = 2


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component: the smallest id that each end of an edge can reach.

    Rounds of contraction: every label takes its smallest neighbouring label,
    pointers are followed JUMPS times by self-joins, and edges are rewritten
    to the new labels. Edges within one label vanish; the rounds end when none
    is left. Labels and edges are tables in the shared folder throughout.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    left = staged(spark, ends.union(ends.select("v", "u")).distinct(), "edges")
    labels = left.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    while not left.isEmpty():
        near = left.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("from"), F.least("u", "v").alias("to"))
        near = staged(spark, near, "hooks")
        for _ in range(JUMPS):
            ahead = near.select(F.col("from").alias("to"), F.col("to").alias("next"))
            near = near.join(ahead, "to", "left").select("from", F.coalesce("next", "to").alias("to"))
        near = staged(spark, near, "hooks")
        labels = staged(spark, labels.join(near, labels["component"] == near["from"], "left").select(
            "id", F.coalesce("to", "component").alias("component")), "labels")
        u, v = near.toDF("u", "new_u"), near.toDF("v", "new_v")
        left = staged(spark, left.join(u, "u").join(v, "v").where("new_u <> new_v").select(
            F.col("new_u").alias("u"), F.col("new_v").alias("v")).distinct(), "edges")
    return labels
