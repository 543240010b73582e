"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """``pd.concat`` of frames with different columns; absent -> NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def distinct_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct values of ``a`` not in ``b`` (anti join on all columns)."""
    return a.distinct().join(b, on=a.columns, how="left_anti")


def distinct_count(df: DataFrame, col: str, out: str = "n_distinct") -> DataFrame:
    """Exact count of distinct values."""
    return df.agg(F.count_distinct(F.col(col)).alias(out))


COPIES_PER_ROW = 10_000


def signed_surplus(df: DataFrame, cols: list[str], sign: str) -> DataFrame:
    """Rows whose ``sign`` column (+1 left, -1 right) does not cancel, with
    multiplicity and ``side``. One pass and one aggregate with map-side
    combine; the surplus copies of a value are spread over all tasks in ranges
    of ``COPIES_PER_ROW`` before they are written out."""
    n = df.groupBy(*cols).agg(F.sum(sign).cast("long").alias("_n")).filter("_n <> 0")
    left = F.abs("_n")
    ranges = n.select(*cols, F.when(F.col("_n") > 0, "only_left").otherwise("only_right").alias("side"),
                      left.alias("_left"),
                      F.explode(F.sequence(F.lit(0).cast("long"), F.floor((left - 1) / COPIES_PER_ROW)))
                      .alias("_range"))
    ranges = ranges.repartition(F.col("_range"), *cols)
    copies = F.least(F.lit(COPIES_PER_ROW), F.col("_left") - F.col("_range") * COPIES_PER_ROW)
    return ranges.select(*cols, "side", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("_i")
                         ).drop("_i")


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: rows of ``a`` not matched in ``b`` and vice versa, with
    multiplicity (``EXCEPT ALL`` both ways). Both empty <=> equal multisets."""
    both = a.withColumn("_sign", F.lit(1)).unionByName(b.withColumn("_sign", F.lit(-1)))
    return signed_surplus(both, a.columns, "_sign")
