"""Filters and predicates (F1-F9, U1 for the split-and-union pattern)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small


def both_present(df: DataFrame, a: str, b: str) -> DataFrame:
    """key and name both present."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())


def threshold(df: DataFrame, col: str, above: float) -> DataFrame:
    """strict numeric threshold; missing values fail the test."""
    return df.filter(F.col(col) > F.lit(above))


def valid_groups(df: DataFrame, grp: str, allow: DataFrame, min_members: int) -> DataFrame:
    """groups in the allow-list with at least ``min_members`` rows,
    largest first (ties by name). The allow-list is broadcast after a size
    check (it is normally a literal list)."""
    counts = (df.filter(F.col(grp).isNotNull()).groupBy(grp)
                .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_members))
    return (counts.join(broadcast_if_small(allow.select(grp)), on=grp, how="left_semi")
                  .orderBy(F.col("n").desc(), F.col(grp)))


def drop_all_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """drop rows where every column of ``subset`` is missing."""
    return df.na.drop(how="all", subset=subset)


def drop_any_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """drop rows where any column of ``subset`` is missing."""
    return df.na.drop(how="any", subset=subset)


def not_equal_keep_null(c: Column, value) -> Column:
    """Pandas ``!=`` is True for missing; Spark's drops NULL."""
    return ~c.eqNullSafe(F.lit(value))


def split_by_segment(df: DataFrame, seg: str, value: str) -> tuple[DataFrame, DataFrame]:
    """rows equal to ``value`` and all others (missing included)."""
    return (df.filter(F.col(seg) == F.lit(value)),
            df.filter(not_equal_keep_null(F.col(seg), value)))


def dedupe_keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """one row per key, the first in ``order`` (not ``dropDuplicates``,
    whose survivor is arbitrary). ``min_by`` over a struct of the row is a
    partial+final aggregate, so a key holding a third of all rows is reduced
    on every map task before the shuffle instead of sorted in one task."""
    rest = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]),
                    F.struct(*[F.col(o) for o in order])).alias("_row")
    return df.groupBy(*key).agg(best).select(*key, "_row.*").select(*df.columns)


def min_sample_status(df: DataFrame, by: list[str], value: str, n: int) -> DataFrame:
    """F8: count of present values per key and an ok/insufficient status."""
    c = df.groupBy(*by).agg(F.count(F.col(value)).alias("n_values"))
    return c.withColumn("status", F.when(F.col("n_values") >= n, "ok")
                        .otherwise("insufficient_data"))
