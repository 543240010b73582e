"""Exact order statistics per group without holding a group in one task.

``percentile``/``median`` keep every distinct value of a group in one
aggregation buffer, so a group holding a third of all rows would be merged in
one task. Here the k-th smallest value of each group is found by range
refinement: each pass counts the group's values in ``buckets`` equal-width
buckets of the current range (partial + final aggregate, so a hot group is
spread over all map tasks), keeps the bucket holding rank k and narrows the
range to that bucket's min/max. A range of one value ends the search; a range
of at most ``small`` values is ranked directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut_lineage


def kth_values(vals: DataFrame, by: list[str], value: str, targets: DataFrame,
               buckets: int = 4096, small: int = 50_000) -> DataFrame:
    """``targets(by..., k)`` (0-based ranks) -> (by..., k, kth). Ranges
    holding at most ``small`` values are ranked directly (one bounded window
    partition each); larger ones are refined first."""
    vals = vals.select(*by, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    bounds = cut_lineage(vals.groupBy(*by).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"),
                                               F.count(F.lit(1)).alias("cnt")))
    state = targets.join(bounds, by).select(*by, "k", "lo", "hi", "cnt",
                                            F.col("k").cast("long").alias("r"))
    keys = [*by, "k"]
    big = (F.col("lo") < F.col("hi")) & (F.col("cnt") > small)
    # Every pass drops at least the values of the other buckets, the range's
    # minimum or maximum among them, so the loop ends.
    while True:
        state = cut_lineage(state)
        pend = state.filter(big)
        if pend.isEmpty():
            break
        j = vals.join(broadcast_if_small(pend), by).filter((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        b = F.least(F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
                            * F.lit(buckets)), F.lit(buckets - 1)).cast("int")
        cnt = j.groupBy(*keys, b.alias("_b")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax"))
        w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        cnt = cnt.withColumn("_cum", F.sum("_n").over(w)).join(pend.select(*keys, "r"), keys)
        w1 = Window.partitionBy(*keys).orderBy("_b")
        pick = (cnt.filter(F.col("_cum") > F.col("r"))
                   .withColumn("_rn", F.row_number().over(w1)).filter("_rn = 1")
                   .select(*keys, F.col("_bmin").alias("lo"), F.col("_bmax").alias("hi"),
                           F.col("_n").alias("cnt"),
                           (F.col("r") - (F.col("_cum") - F.col("_n"))).alias("r")))
        state = state.filter(~big).unionByName(pick)
    # rank the values left inside each open range (small by construction)
    open_ = state.filter(F.col("lo") < F.col("hi"))
    j = vals.join(broadcast_if_small(open_), by).filter((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
    w = Window.partitionBy(*keys).orderBy("_v")
    rest = (j.withColumn("_rn", F.row_number().over(w) - 1)
             .filter(F.col("_rn") == F.col("r"))
             .select(*keys, F.col("_v").alias("kth")))
    closed = state.filter(F.col("lo") >= F.col("hi")).select(*keys, F.col("lo").alias("kth"))
    return closed.unionByName(rest)


def exact_median(vals: DataFrame, by: list[str], value: str, counts: DataFrame,
                 n_col: str = "n", **kw) -> DataFrame:
    """Median per group (linear interpolation of the two middle values, as
    ``percentile(0.5)``) -> (by..., median). ``counts(by..., n)``."""
    n = F.col(n_col)
    lo_k = F.floor((n - 1) / 2).cast("long")
    hi_k = F.ceil((n - 1) / 2).cast("long")
    targets = counts.filter(n > 0).select(*by, F.explode(F.array_distinct(F.array(lo_k, hi_k))).alias("k"))
    kth = kth_values(vals, by, value, targets, **kw)
    mid = kth.groupBy(*by).agg(F.min("kth").alias("_a"), F.max("kth").alias("_b"))
    return mid.select(*by, (F.col("_a") + (F.col("_b") - F.col("_a")) * 0.5).alias("median"))
