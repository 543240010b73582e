"""Ranking, top-k and ordering.

Top-k uses ``row_number() <= k`` directly over the window so Catalyst plans a
``WindowGroupLimit`` (partial limit per map task, then final): only k rows
per partition key cross the shuffle, so a hot stat or group never ships all
its rows to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_token
from ..session import cut_lineage


def top_k(df: DataFrame, k: int, partition: list[str], value: str,
          ties: list[str], descending: bool = True, rank_col: str = "rank") -> DataFrame:
    order = F.col(value).desc() if descending else F.col(value).asc()
    w = Window.partitionBy(*partition).orderBy(order, *[F.col(t).asc() for t in ties])
    return (df.filter(F.col(value).isNotNull())
              .withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= k))


def top_bottom_k(long: DataFrame, k: int = 3, partition: list[str] = ("stat",),
                 value: str = "value", ties: list[str] = ("c_name", "c_custkey"),
                 min_values: int = 0) -> DataFrame:
    """Top k and bottom k rows per partition, ties broken by ``ties``.
    Partitions with fewer than ``min_values`` values are left out (their
    status is reported by ``top_k_status``). The sample-size check is applied
    to the k-row result, never as a join on the full frame (that would
    shuffle every row by the partition key before the partial limit)."""
    partition, ties = list(partition), list(ties)
    hi = top_k(long, k, partition, value, ties, True).withColumn("direction", F.lit("highest"))
    lo = top_k(long, k, partition, value, ties, False).withColumn("direction", F.lit("lowest"))
    out = hi.unionByName(lo)
    if min_values > k:
        ok = (long.filter(F.col(value).isNotNull()).groupBy(*partition)
                  .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_values)
                  .select(*partition))
        out = out.join(ok, on=partition, how="left_semi")
    elif min_values:
        # fewer than k values <=> fewer than k rows survive the limit
        n = F.count(F.lit(1)).over(Window.partitionBy(*partition, "direction"))
        out = out.withColumn("_n", n).filter(F.col("_n") >= min_values).drop("_n")
    return out


def top_k_status(long: DataFrame, partition: list[str], value: str = "value",
                 min_values: int = 3) -> DataFrame:
    """Per partition: value count and 'ok' / 'insufficient_data' (F8)."""
    n = long.filter(F.col(value).isNotNull()).groupBy(*partition).agg(
        F.count(F.lit(1)).alias("n_values"))
    return n.withColumn("status", F.when(F.col("n_values") >= min_values, "ok")
                        .otherwise("insufficient_data"))


def numbered(ordered: DataFrame, out: str = "pos") -> DataFrame:
    """Row numbers (from 1) of a globally sorted frame without gathering it in
    one task: rows are numbered inside their range partition and the
    partitions' sizes, one row each, give the offsets."""
    rows = cut_lineage(ordered.withColumn("_id", F.monotonically_increasing_id()))
    rows = rows.withColumn("_p", F.shiftright("_id", 33)).withColumn(
        "_k", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return rows.join(F.broadcast(offsets), "_p").withColumn(
        out, (F.col("_o") + F.col("_k") + 1).cast("long")).drop("_id", "_p", "_k", "_o")


def sort_by_first_token(df: DataFrame, name: str, ties: list[str]) -> DataFrame:
    """Global sort by the first whitespace token of ``name`` ('Unknown' when
    blank), then by the tie columns for a total order (O1, X3). A range-
    partitioned external sort, no single-partition window."""
    keyed = df.withColumn("first_token", first_token(F.col(name)))
    return keyed.orderBy("first_token", *ties)
