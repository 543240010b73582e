"""Connected components of an edge table.

Every node starts as its own parent. In a round a node learns the smallest
parent among its neighbours, hooks its parent (and itself) below it, and then
takes its parent's parent. Labels travel along pointers that double in length,
so a long chain needs about as many rounds as the logarithm of its length.
Every step is a join or a grouped minimum; nothing node-sized is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``edges`` with columns ``u`` and ``v`` of one type -> (node, component),
    the component being its smallest node. Null ends are dropped."""
    e = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).filter("a is not null and b is not null")
    both = cut_lineage(e.union(e.select("b", "a")).distinct())
    parent = cut_lineage(both.select(F.col("a").alias("node")).distinct()
                         .withColumn("parent", F.col("node")))
    while True:
        least = (both.join(parent, F.col("a") == F.col("node"))
                 .groupBy(F.col("b").alias("node")).agg(F.min("parent").alias("least")))
        known = parent.join(least, "node")
        hooks = (known.select(F.col("parent").alias("node"), "least")
                 .union(known.select("node", "least"))
                 .groupBy("node").agg(F.min("least").alias("least")))
        hooked = cut_lineage(parent.join(hooks, "node", "left").select(
            "node", F.col("parent").alias("old"), F.least("parent", "least").alias("parent")))
        up = hooked.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        parent = cut_lineage(hooked.join(up, "parent").select(
            "node", F.col("grand").alias("parent"), (F.col("grand") != F.col("old")).alias("moved")))
        moved = parent.filter("moved").isEmpty()
        parent = parent.select("node", "parent")
        if moved:
            return parent.withColumnRenamed("parent", "component")
