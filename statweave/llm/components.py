"""Connected components of an undirected edge table.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every step is two joins and
aggregates, neither of which gathers a component in one task, and every round
is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, cut_narrow


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    return (e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, most_edges: int | None = None) -> DataFrame:
    """edges (a, b) of longs -> (node, root) for every node with an edge;
    root is the smallest node of its component.  An empty edge table gives an
    empty result; loops and repeated edges are ignored.  ``most_edges``, about
    how many edges to expect, only sizes the first checkpoint's files."""
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                      F.least("a", "b").alias("v")).distinct()
    e = cut(e) if most_edges is None else cut_narrow(e, most_edges)
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")),
                      F.sum(F.hash("v", "u").cast("long"))).first()
        if state == seen or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
        # A round never has more edges than the one before.
        e = cut_narrow(_small_star(_large_star(e)), state[0])
