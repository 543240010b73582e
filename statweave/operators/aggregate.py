"""Aggregations: mixed per-key aggregates, group moments and means, best
group per stat and overall, cross-tabs, null profiles, unpivot and
normalisation by group size.

All are single ``groupBy`` jobs (partial + final hash aggregate) or joins of
such results; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null


# --------------------------------------------------------------------- P18 --
def unpivot_stats(df: DataFrame, ids: list[str], stats: list[str],
                  stat_col: str = "stat", value_col: str = "value",
                  drop_null: bool = True) -> DataFrame:
    """Wide -> long in one ``Expand`` (no shuffle); replaces a loop per stat.
    Values are DOUBLE; NaN is treated as missing and, by default, dropped."""
    wide = df.select(*ids, *[nan_to_null(F.col(f"`{s}`").cast("double")).alias(s)
                             for s in stats])
    long = wide.unpivot(ids, stats, stat_col, value_col)
    return long.filter(F.col(value_col).isNotNull()) if drop_null else long


# --------------------------------------------------------------- A1 - A5 --
def mixed_agg(df: DataFrame, key: str | list[str], specs: dict[str, tuple[str, str]],
              order_col: str | None = None) -> DataFrame:
    """Config-driven aggregate to key grain.

    ``specs`` maps output name -> (kind, input column) with kind one of
    ``sum`` (missing skipped, all-missing -> 0), ``mean`` (all-missing ->
    NULL), ``first`` (first non-missing in ``order_col`` order, ties by
    value), ``count``.
    Distinct concatenation is ``distinct_concat`` (it needs its own grain).
    """
    keys = [key] if isinstance(key, str) else list(key)
    exprs = []
    for out, (kind, col) in specs.items():
        c = F.col(col)
        if kind == "sum":
            e = F.coalesce(F.sum(c), F.lit(0).cast(df.schema[col].dataType))
        elif kind == "mean":
            e = F.avg(c)
        elif kind == "first":
            if order_col is None:
                raise ValueError("'first' needs an order column")
            # the value itself breaks ties in the row order, so the result
            # is deterministic even when the order column is not unique
            e = F.min_by(c, F.when(c.isNotNull(), F.struct(F.col(order_col), c)))
        elif kind == "count":
            e = F.count(c)
        else:
            raise ValueError(f"unknown aggregate kind {kind!r}")
        exprs.append(e.alias(out))
    return df.groupBy(*keys).agg(*exprs)


def distinct_concat(df: DataFrame, key: str, value: str, order_col: str,
                    sep: str = ", ", out: str = "values") -> DataFrame:
    """Distinct values per key joined by ``sep`` in order of first appearance.

    Two aggregates: (key, value) -> first position, then key -> ordered
    join. The second level only ever holds the distinct values of one key,
    which is the output itself."""
    firsts = (df.filter(F.col(value).isNotNull())
                .groupBy(key, value).agg(F.min(order_col).alias("_p")))
    return firsts.groupBy(key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col("_p"), F.col(value)))),
                        lambda s: s[value]), sep).alias(out))


# --------------------------------------------------------------- A6 - A7 --
def group_counts(df: DataFrame, grp: str, count_col: str | None = None,
                 out: str = "n") -> DataFrame:
    """Rows (or non-missing values of ``count_col``) per group; NULL groups
    are dropped, as pandas ``groupby`` does (T10)."""
    c = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    return df.filter(F.col(grp).isNotNull()).groupBy(grp).agg(c.alias(out))


# ------------------------------------------------------------ P15 / W4 --
def normalize_by_group(df: DataFrame, grp: str, count_col: str,
                       stats: list[str], out_suffix: str = "") -> DataFrame:
    """Divide extensive stats by the group's member count.

    The count is a partial+final aggregate joined back on the group key
    (broadcast after a size check; beyond it AQE plans the join), not a
    window over each group, so a hot group never lands whole in one sort."""
    from ..session import broadcast_if_small, cut_lineage
    sizes = cut_lineage(group_counts(df, grp, count_col, "_grp_n"))
    j = df.join(broadcast_if_small(sizes), on=grp, how="left")
    cols = []
    for c in df.columns:
        if c in stats:
            cols.append(F.try_divide(F.col(c), F.col("_grp_n")).alias(c + out_suffix))
        else:
            cols.append(F.col(c))
    return j.select(*cols, F.col("_grp_n").alias("group_size"))


# --------------------------------------------------------------- A8 / A9 --
def group_moments(long: DataFrame, by: list[str], value: str = "value",
                  median: str = "exact", accuracy: int = 10000,
                  materialize: bool = True) -> DataFrame:
    """Median, mean, sample std and count per group x stat.

    ``median='exact'`` finds the two middle values by range refinement
    (``operators.quantile``): exact, and no group is ever held whole in one
    task. ``'approx'`` uses ``percentile_approx``; ``'percentile'`` Spark's
    exact ``median`` (one buffer per group holding its distinct values).
    ``materialize`` writes the input once before the passes; turn it off
    when the input is already cheap to recompute (read from a checkpoint)."""
    if median == "exact":
        from .quantile import exact_median
        from ..session import cut_lineage
        vals = long.select(*by, value).filter(F.col(value).isNotNull())
        if materialize:
            vals = cut_lineage(vals)
        mom = vals.groupBy(*by).agg(F.avg(value).alias("mean"),
                                    F.stddev_samp(value).alias("std"),
                                    F.count(value).alias("n"))
        med = exact_median(vals, by, value, mom.select(*by, "n"))
        return mom.join(med, by, "left").select(*by, "median", "mean", "std", "n")
    med = (F.percentile_approx(value, 0.5, accuracy) if median == "approx" else F.median(value))
    return long.groupBy(*by).agg(
        med.alias("median"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.count(value).alias("n"))


def group_means(long: DataFrame, grp: str = "grp", stat: str = "stat",
                value: str = "value") -> DataFrame:
    return long.groupBy(grp, stat).agg(F.avg(value).alias("mean"))


# ------------------------------------------------------------------- A10 --
def best_group_per_stat(means: DataFrame, stat_list: DataFrame,
                        grp: str = "grp", stat: str = "stat",
                        mean: str = "mean") -> DataFrame:
    """Arg-max group per stat; ties go to the first group in key order;
    a stat with no means gets ('None', NULL)."""
    w = Window.partitionBy(stat).orderBy(F.col(mean).desc(), F.col(grp).asc())
    best = (means.filter(F.col(mean).isNotNull())
                 .withColumn("_rn", F.row_number().over(w))
                 .filter(F.col("_rn") == 1)
                 .select(stat, F.col(grp).alias("best_grp"), F.col(mean).alias("best_mean")))
    return (stat_list.join(best, on=stat, how="left")
                     .select(stat, F.coalesce("best_grp", F.lit("None")).alias("best_grp"),
                             "best_mean"))


# ------------------------------------------------------------------- A11 --
def group_scores(means: DataFrame, grp: str = "grp", mean: str = "mean",
                 stat: str = "stat", standardize: bool = False) -> DataFrame:
    """Unweighted mean of a group's per-stat means (missing skipped). The
    reference averages raw means, so large-unit stats dominate (T36);
    ``standardize=True`` z-scores each stat's means across groups first (a
    window over one stat's group means: #groups rows)."""
    m = F.col(mean)
    if standardize:
        w = Window.partitionBy(stat)
        sd = F.stddev_pop(mean).over(w)
        m = F.when(sd > 0, (m - F.avg(mean).over(w)) / sd).otherwise(F.when(m.isNotNull(), 0.0))
    return (means.select(grp, m.alias("_m")).groupBy(grp).agg(F.avg("_m").alias("score"))
                 .filter(F.col("score").isNotNull()))


def best_group_overall(means: DataFrame, grp: str = "grp", mean: str = "mean",
                       standardize: bool = False) -> DataFrame:
    return (group_scores(means, grp, mean, standardize=standardize)
            .orderBy(F.col("score").desc(), F.col(grp)).limit(1))


# ------------------------------------------------------------------- A12 --
def best_group_strengths(best_per_stat: DataFrame, overall: DataFrame,
                         categories: DataFrame, grp: str = "grp") -> DataFrame:
    """Per category, the stats (in category order) that the overall best
    group leads; 'None' when it leads none. ``categories`` is
    (category, stat, pos)."""
    led = (best_per_stat.join(overall.select(F.col(grp).alias("best_grp")), "best_grp")
                        .select("stat", "best_grp"))
    j = categories.join(led, on="stat", how="left")
    return j.groupBy("category").agg(
        F.coalesce(
            F.nullif(F.array_join(F.transform(
                F.array_sort(F.collect_list(
                    F.when(F.col("best_grp").isNotNull(), F.struct("pos", "stat")))),
                lambda s: s["stat"]), ", "), F.lit("")),
            F.lit("None")).alias("stats_led"))


# ------------------------------------------------------------------- A14 --
def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts of row x col with absent combinations 0; NULL keys dropped
    (T10). ``values`` is the explicit column list (no distinct pre-pass)."""
    return (df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
              .groupBy(row).pivot(col, values).count().na.fill(0))


# ------------------------------------------------------------------- A17 --
def null_profile(df: DataFrame, columns: list[str] | None = None,
                 warn_above: float = 50.0) -> DataFrame:
    """Share of missing values per column in one pass over the data."""
    cols = columns or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = agg.unpivot(["_n"], cols, "column", "n_null")
    pct = F.try_divide(F.col("n_null") * 100.0, F.col("_n"))
    return long.select("column", F.col("n_null").cast("long").alias("n_null"),
                       F.col("_n").alias("n_rows"), pct.alias("pct_null"),
                       (pct > warn_above).alias("warn"))
