"""Group reports over the entity frame (stage-2 analogue): top/bottom k per
stat, group moments and means, best group per stat and overall, strengths,
histograms, normalisation by group size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregate as agg
from ..operators import filters, rank, sketch
from ..operators.histogram import histogram, histogram_sql
from ..session import broadcast_if_small, cut_lineage
from ..sources.files import top_k_report
from ..sources.tables import read_table
from ..specs import (ENTITY_MEASURES, EXTENSIVE_STATS, GROUP_ALLOW_LIST, HISTOGRAM_BINS,
                     MIN_GROUP_MEMBERS, MIN_VALUES_HISTOGRAM, MIN_VALUES_TOP_K, STATS,
                     STRENGTH_CATEGORIES)
from .entity import CS_SQL, ID_COLS, entity_long, entity_stats, entity_stats_once
from .registry import query, rnd, round_doubles


@query("top_k_per_stat", "W1 F6 F8 P18", sql=f"""
WITH {CS_SQL},
ok AS (SELECT stat FROM csl GROUP BY stat HAVING count(*) >= {MIN_VALUES_TOP_K}),
r AS (SELECT csl.*,
        row_number() OVER (PARTITION BY stat ORDER BY value DESC, c_name, c_custkey) AS rh,
        row_number() OVER (PARTITION BY stat ORDER BY value ASC, c_name, c_custkey) AS rl
      FROM csl WHERE stat IN (SELECT stat FROM ok))
SELECT stat, 'highest' AS direction, CAST(rh AS INTEGER) AS rank, c_custkey, c_name,
       round(value, 6) AS value FROM r WHERE rh <= 3
UNION ALL
SELECT stat, 'lowest' AS direction, CAST(rl AS INTEGER) AS rank, c_custkey, c_name,
       round(value, 6) AS value FROM r WHERE rl <= 3
""")
def top_k_per_stat(spark, sf_dir):
    long = entity_long(entity_stats_once(spark, sf_dir))
    tb = rank.top_bottom_k(long, 3, ["stat"], "value", ["c_name", "c_custkey"],
                           min_values=MIN_VALUES_TOP_K)
    return tb.select("stat", "direction", F.col("rank").cast("int").alias("rank"),
                     "c_custkey", "c_name", rnd("value").alias("value"))


# ------------------------------------------------------------------------
# Stage-2 frame: extensive stats divided by group size (sizes taken before
# any filter, T12), groups kept when in the allow-list with >= 5 members,
# rows with every stat missing dropped. Reports derive from its long form.
# ------------------------------------------------------------------------
def _sql_list(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


ALLOW_SQL = _sql_list(GROUP_ALLOW_LIST)
STATS_SQL = ", ".join(STATS)


def allow_list_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, g) for i, g in enumerate(GROUP_ALLOW_LIST)],
                                 "priority int, grp string")


def stat_list_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, s) for i, s in enumerate(STATS)], "pos int, stat string")


def normalized(spark, sf_dir) -> DataFrame:
    cs = entity_stats_once(spark, sf_dir)
    return agg.normalize_by_group(cs, "grp", "c_name", EXTENSIVE_STATS)


def team_frame(spark, sf_dir) -> DataFrame:
    tn = normalized(spark, sf_dir)
    vg = filters.valid_groups(tn, "grp", allow_list_df(spark), MIN_GROUP_MEMBERS)
    # vg is a subset of the allow-list; broadcast after the size check
    kept = tn.join(broadcast_if_small(vg.select("grp")), on="grp", how="left_semi")
    return filters.drop_all_null(kept, STATS)


def team_long(spark, sf_dir) -> DataFrame:
    return agg.unpivot_stats(team_frame(spark, sf_dir), ID_COLS, STATS)


TEAM_SQL = CS_SQL + f""",
gsz AS (SELECT grp, count(c_name) AS gs FROM cs WHERE grp IS NOT NULL GROUP BY grp),
tn AS (SELECT c_custkey, c_name, cs.grp AS grp, seg,
              n_orders / gs AS n_orders, spend / gs AS spend, avg_price, acctbal,
              qty / gs AS qty, n_items / gs AS n_items, avg_disc, avg_tax, gs AS group_size
       FROM cs LEFT JOIN gsz ON cs.grp = gsz.grp),
vg AS (SELECT grp, count(*) AS n FROM tn WHERE grp IS NOT NULL GROUP BY grp
       HAVING count(*) >= {MIN_GROUP_MEMBERS} AND grp IN ({ALLOW_SQL})),
tf AS (SELECT * FROM tn WHERE grp IN (SELECT grp FROM vg)
       AND NOT ({' AND '.join(f'{s} IS NULL' for s in STATS)})),
tl AS (SELECT c_custkey, c_name, grp, seg, stat, value FROM tf
       UNPIVOT (value FOR stat IN ({STATS_SQL}))),
tm AS (SELECT grp, stat, avg(value) AS mean FROM tl GROUP BY grp, stat),
sl AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{s}')" for i, s in enumerate(STATS))}) t(pos, stat)),
bps AS (SELECT sl.stat, coalesce(b.grp, 'None') AS best_grp, b.mean AS best_mean FROM sl
        LEFT JOIN (SELECT stat, grp, mean, row_number() OVER (PARTITION BY stat ORDER BY mean DESC, grp) AS rn
                   FROM tm WHERE mean IS NOT NULL) b ON sl.stat = b.stat AND b.rn = 1),
gsc AS (SELECT grp, avg(mean) AS score FROM tm GROUP BY grp HAVING avg(mean) IS NOT NULL),
bo AS (SELECT grp, score FROM gsc ORDER BY score DESC, grp LIMIT 1)
"""


@query("normalize_by_group", "P15 J4 W4 A6", sql=f"""
WITH {TEAM_SQL}
SELECT c_custkey, c_name, grp, seg, {", ".join(f"round({s}, 6) AS {s}" for s in STATS)},
       group_size FROM tn
""")
def normalize_by_group_q(spark, sf_dir):
    return round_doubles(normalized(spark, sf_dir))


@query("unpivot_stats", "P18 F6", sql=f"""
WITH {CS_SQL} SELECT c_custkey, c_name, grp, seg, stat, round(value, 6) AS value FROM csl
""")
def unpivot_stats_q(spark, sf_dir):
    return round_doubles(entity_long(entity_stats(spark, sf_dir)))


@query("group_moments", "A8 F6", sql=f"""
WITH {TEAM_SQL}
SELECT grp, stat, round(median(value), 6) AS median, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, count(value) AS n
FROM tl GROUP BY grp, stat
""")
def group_moments_q(spark, sf_dir):
    # the long frame derives from the materialised entity frame: no second write
    return round_doubles(agg.group_moments(team_long(spark, sf_dir), ["grp", "stat"],
                                           materialize=False))


@query("quantile_sketches", "A8", sql="""
WITH s AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS n, p.prob, TRUE AS within_bound, count(*) AS merged
FROM s, (SELECT unnest(CAST([0.05, 0.5, 0.95] AS DOUBLE[])) AS prob) p GROUP BY 1, 3
""")
def quantile_sketches_q(spark, sf_dir):
    """Prices sketched by flag and status, rolled up to the flag; the exact
    ranks of the sketch's quantiles lie within its bound (three times the 99 %
    one)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_extendedprice"])
    fine = cut_lineage(sketch.build(li, ["l_returnflag", "l_linestatus"], "l_extendedprice"))
    flags = sketch.roll_up(fine, ["l_returnflag"])
    q = cut_lineage(sketch.quantiles(flags, ["l_returnflag"], [0.05, 0.5, 0.95]))
    # The quantiles are a few rows a flag.
    at = li.join(broadcast_if_small(q), "l_returnflag").groupBy("l_returnflag", "n", "prob").agg(
        F.avg((F.col("l_extendedprice") < F.col("quantile")).cast("double")).alias("below"),
        F.avg((F.col("l_extendedprice") <= F.col("quantile")).cast("double")).alias("upto"))
    e = 3 * sketch.rank_error()
    parts = fine.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("merged"))
    return at.join(parts, "l_returnflag").select(
        "l_returnflag", "n", "prob",
        ((F.col("below") <= F.col("prob") + e) & (F.col("upto") >= F.col("prob") - e)).alias("within_bound"),
        "merged")


@query("group_means", "A9", sql=f"""
WITH {TEAM_SQL} SELECT grp, stat, round(mean, 6) AS mean FROM tm
""")
def group_means_q(spark, sf_dir):
    return round_doubles(agg.group_means(team_long(spark, sf_dir)))


@query("best_group_per_stat", "A10", sql=f"""
WITH {TEAM_SQL} SELECT stat, best_grp, round(best_mean, 6) AS best_mean FROM bps
""")
def best_group_per_stat_q(spark, sf_dir):
    means = agg.group_means(team_long(spark, sf_dir))
    return round_doubles(agg.best_group_per_stat(means, stat_list_df(spark).select("stat")))


@query("best_group_overall", "A11", sql=f"""
WITH {TEAM_SQL} SELECT grp, round(score, 6) AS score FROM bo
""")
def best_group_overall_q(spark, sf_dir):
    means = agg.group_means(team_long(spark, sf_dir))
    return round_doubles(agg.best_group_overall(means))


CATS = [(c, s, i) for c, ss in STRENGTH_CATEGORIES.items() for i, s in enumerate(ss)]


@query("best_group_strengths", "A12 X11", sql=f"""
WITH {TEAM_SQL},
cat AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{s}', {i})" for c, s, i in CATS)}) t(category, stat, pos)),
led AS (SELECT bps.stat, bps.best_grp FROM bps JOIN bo ON bps.best_grp = bo.grp)
SELECT category,
       coalesce(nullif(string_agg(CASE WHEN led.best_grp IS NOT NULL THEN cat.stat END, ', '
                                  ORDER BY pos), ''), 'None') AS stats_led
FROM cat LEFT JOIN led ON cat.stat = led.stat GROUP BY category
""")
def best_group_strengths_q(spark, sf_dir):
    means = agg.group_means(team_long(spark, sf_dir))
    bps = agg.best_group_per_stat(means, stat_list_df(spark).select("stat"))
    bo = agg.best_group_overall(means)
    cats = spark.createDataFrame(CATS, "category string, stat string, pos int")
    return agg.best_group_strengths(bps, bo, cats)


def _eligible() -> "F.Column":
    cond = F.lit(True)
    for m in ENTITY_MEASURES:
        if m.segment_only:
            cond = cond & ((F.col("stat") != m.name) | (F.col("seg") == m.segment_only))
    return cond


ELIGIBLE_SQL = " AND ".join(f"(stat <> '{m.name}' OR seg = '{m.segment_only}')"
                            for m in ENTITY_MEASURES if m.segment_only) or "TRUE"


# Values are binned as they are: sums are exact, so both engines divide the
# same numbers and get the same doubles.
@query("histogram_global", "A15", sql=f"""
WITH {TEAM_SQL}, {histogram_sql('tl', ['stat'], HISTOGRAM_BINS, MIN_VALUES_HISTOGRAM)}
SELECT stat, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, count FROM hist
""")
def histogram_global_q(spark, sf_dir):
    h = histogram(team_long(spark, sf_dir), ["stat"], bins=HISTOGRAM_BINS,
                  min_values=MIN_VALUES_HISTOGRAM)
    return round_doubles(h)


@query("histogram_by_group", "A16 F8 T38", sql=f"""
WITH {TEAM_SQL}, {histogram_sql('tl', ['grp', 'stat'], HISTOGRAM_BINS, MIN_VALUES_HISTOGRAM, ELIGIBLE_SQL)}
SELECT grp, stat, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, count FROM hist
""")
def histogram_by_group_q(spark, sf_dir):
    h = histogram(team_long(spark, sf_dir), ["grp", "stat"], bins=HISTOGRAM_BINS,
                  min_values=MIN_VALUES_HISTOGRAM, eligible=_eligible())
    return round_doubles(h)


@query("top3_report_lines", "W1 F8 S8 X10", sql=f"""
WITH {TEAM_SQL},
cnt AS (SELECT sl.stat, count(tl.value) AS n FROM sl LEFT JOIN tl ON sl.stat = tl.stat GROUP BY sl.stat),
r AS (SELECT tl.*, row_number() OVER (PARTITION BY stat ORDER BY value DESC, c_name, c_custkey) AS rh,
             row_number() OVER (PARTITION BY stat ORDER BY value ASC, c_name, c_custkey) AS rl
      FROM tl WHERE stat IN (SELECT stat FROM cnt WHERE n >= 3))
SELECT stat, 'highest' AS direction, CAST(rh AS INTEGER) AS rank, c_name AS entity,
       round(value, 6) AS value, 'ok' AS status FROM r WHERE rh <= 3
UNION ALL
SELECT stat, 'lowest', CAST(rl AS INTEGER), c_name, round(value, 6), 'ok' FROM r WHERE rl <= 3
UNION ALL
SELECT stat, d.direction, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE),
       'insufficient_data' FROM cnt, (VALUES ('highest'), ('lowest')) d(direction) WHERE n < 3
""")
def top3_report_lines_q(spark, sf_dir):
    return round_doubles(top_k_report(team_long(spark, sf_dir), stat_list_df(spark), k=3,
                                      min_values=MIN_VALUES_TOP_K))
