"""Equal-width histograms per stat or per group x stat.

Bounds are one partial+final aggregate per key; each value's bin is a
closed-form expression (NumPy's rule, including its edge corrections and the
+-0.5 widening of a single-point range, T37), and counts are another
aggregate. Empty bins are produced from the bounds (``sequence`` +
``explode``: bins x keys rows, independent of the data volume).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut_lineage


def _edge(i: Column, lo: Column, hi: Column, nb: int) -> Column:
    step = (hi - lo) / F.lit(nb)
    return F.when(i == nb, hi).otherwise(i * step + lo)


def bin_index(v: Column, lo: Column, hi: Column, nb: int) -> Column:
    f = (v - lo) / (hi - lo) * F.lit(nb)
    i0 = F.floor(f).cast("int")
    i0 = F.when(i0 == nb, nb - 1).otherwise(i0)
    i1 = F.when(v < _edge(i0, lo, hi, nb), i0 - 1).otherwise(i0)
    return F.when((v >= _edge(i1 + 1, lo, hi, nb)) & (i1 != nb - 1), i1 + 1).otherwise(i1)


def histogram(long: DataFrame, by: list[str], value: str = "value", bins: int = 30,
              min_values: int = 5, eligible: Column | None = None) -> DataFrame:
    """Rows (by..., bin, bin_lo, bin_hi, count) for every key with at least
    ``min_values`` values; all ``bins`` bins are present."""
    vals = long.filter(F.col(value).isNotNull())
    if eligible is not None:
        vals = vals.filter(eligible)
    vals = vals.select(*by, value)
    raw = vals.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"),
                                F.count(F.lit(1)).alias("_n"))
    same = F.col("_lo") == F.col("_hi")
    bounds = raw.filter(F.col("_n") >= min_values).select(
        *by,
        F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"))
    # one row per key, written once (so the size check does not recompute
    # it) and broadcast after the check: the values are never shuffled by a
    # low-cardinality key such as the stat name
    bounds = cut_lineage(bounds)
    binned = (vals.join(broadcast_if_small(bounds), on=by, how="inner")
                  .select(*by, bin_index(F.col(value), F.col("lo"), F.col("hi"), bins).alias("bin"))
                  .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count")))
    grid = bounds.select(*by, "lo", "hi",
                         F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(binned, on=[*by, "bin"], how="left")
    return out.select(
        *by, "bin",
        _edge(F.col("bin"), F.col("lo"), F.col("hi"), bins).alias("bin_lo"),
        _edge(F.col("bin") + 1, F.col("lo"), F.col("hi"), bins).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def histogram_sql(src: str, by: list[str], bins: int = 30, min_values: int = 5,
                  where: str = "TRUE") -> str:
    """The same rule as DuckDB SQL (oracle side)."""
    k = ", ".join(by)
    jk = " AND ".join(f"v.{c} = b.{c}" for c in by)
    gk = " AND ".join(f"g.{c} = c.{c}" for c in by)
    e = lambda i: f"(CASE WHEN {i} = {bins} THEN hi ELSE {i} * ((hi - lo) / {bins}) + lo END)"
    return f"""
hv AS (SELECT {k}, value FROM {src} WHERE value IS NOT NULL AND ({where})),
hr AS (SELECT {k}, min(value) AS lo0, max(value) AS hi0, count(*) AS n FROM hv GROUP BY {k}),
hb AS (SELECT {k}, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
              CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi
       FROM hr WHERE n >= {min_values}),
h0 AS (SELECT v.*, b.lo, b.hi,
              least(CAST(floor((value - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) AS i0
       FROM hv v JOIN hb b ON {jk}),
h1 AS (SELECT *, CASE WHEN value < {e('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM h0),
h2 AS (SELECT {k}, CASE WHEN value >= {e('(i1 + 1)')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin
       FROM h1),
hc AS (SELECT {k}, bin, count(*) AS cnt FROM h2 GROUP BY {k}, bin),
hg AS (SELECT b.*, CAST(gs.bin AS INTEGER) AS bin FROM hb b,
       (SELECT unnest(range(0, {bins})) AS bin) gs),
hist AS (SELECT {", ".join("g." + c for c in by)}, g.bin,
                {e('g.bin')} AS bin_lo, {e('(g.bin + 1)')} AS bin_hi,
                CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
         FROM hg g LEFT JOIN hc c ON {gk} AND g.bin = c.bin)
"""
