"""Cleaning, schema and filter queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.numeric import coerce_numeric, coercion_lost, leading_int
from ..operators import aggregate as agg
from ..operators import filters, rank, schema
from ..sources.tables import read_table
from ..specs import GROUP_ALLOW_LIST, MIN_GROUP_MEMBERS
from .entity import CS_SQL, entity_stats
from .q_reports import ALLOW_SQL, allow_list_df
from ..session import broadcast_if_small
from .registry import query, rnd, round_doubles

# Raw headers as a source page would show them for lineitem's columns:
# repeated labels are resolved by occurrence; 'Flag' has no suffix list so
# its repeat is dropped (keep first).
LINEITEM_RAW_HEADERS = ["Key", "Key", "Key", "Line", "Amount", "Amount", "Rate", "Rate",
                        "Flag", "Flag", "Ship"]
LINEITEM_SUFFIXES = {"Key": ["_order", "_part", "_supp"], "Amount": ["_qty", "_price"],
                     "Rate": ["_disc", "_tax"]}


@query("dedup_headers", "P1 P3 S3", sql="""
SELECT l_orderkey AS Key_order, l_partkey AS Key_part, l_suppkey AS Key_supp,
       l_linenumber AS Line, l_quantity AS Amount_qty, l_extendedprice AS Amount_price,
       l_discount AS Rate_disc, l_tax AS Rate_tax, l_returnflag AS Flag FROM lineitem
""")
def dedup_headers_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     "l_shipdate"])
    out = schema.apply_raw_headers(li, LINEITEM_RAW_HEADERS, LINEITEM_SUFFIXES)
    return out.drop("Ship")


@query("select_rename", "P4 P14 T39", sql="""
SELECT o_orderkey AS "Order", o_custkey AS "Customer", o_totalprice AS "Total Price",
       o_orderpriority AS "Priority (text)" FROM orders
""")
def select_rename_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    wanted = ["o_orderkey", "o_custkey", "o_totalprice", "o_custkey", "o_orderpriority",
              "o_comment"]
    return schema.select_rename(o, wanted, {"o_orderkey": "Order", "o_custkey": "Customer",
                                            "o_totalprice": "Total Price",
                                            "o_orderpriority": "Priority (text)"})


@query("backfill_columns", "P6 T27", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_clerk,
       CAST(NULL AS INTEGER) AS o_shippriority, CAST(NULL AS DOUBLE) AS o_discount FROM orders
""")
def backfill_columns_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    return schema.backfill_columns(o, {"o_orderstatus": "string", "o_clerk": "string",
                                       "o_shippriority": "int", "o_discount": "double"})


@query("coerce_numeric", "P7 T5 T6", sql="""
SELECT event_id,
       try_cast(trim(json_extract_string(props, '$.k')) AS DOUBLE) AS k_num,
       CASE WHEN isnan(try_cast(trim(event_type) AS DOUBLE)) THEN NULL
            ELSE try_cast(trim(event_type) AS DOUBLE) END AS event_type_num,
       try_cast(trim(CAST(user_id AS VARCHAR)) AS DOUBLE) AS user_num
FROM events
""")
def coerce_numeric_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "props", "event_type", "user_id"])
    return e.select("event_id",
                    coerce_numeric(F.get_json_object("props", "$.k")).alias("k_num"),
                    coerce_numeric(F.col("event_type")).alias("event_type_num"),
                    coerce_numeric(F.col("user_id")).alias("user_num"))


@query("coercion_loss", "P8", sql="""
SELECT * FROM (VALUES
  ('props_k', (SELECT count(*) FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
               AND try_cast(trim(json_extract_string(props, '$.k')) AS DOUBLE) IS NULL)),
  ('event_type', (SELECT count(*) FROM events WHERE event_type IS NOT NULL
                  AND try_cast(trim(event_type) AS DOUBLE) IS NULL)),
  ('ts', (SELECT count(*) FROM events WHERE ts IS NOT NULL
          AND try_cast(trim(CAST(ts AS VARCHAR)) AS DOUBLE) IS NULL))
) t(column_name, n_lost)
""")
def coercion_loss_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["props", "event_type", "ts"])
    cols = {"props_k": F.get_json_object("props", "$.k"), "event_type": F.col("event_type"),
            "ts": F.col("ts").cast("string")}
    a = e.agg(*[F.sum(coercion_lost(c)).cast("long").alias(n) for n, c in cols.items()])
    return a.unpivot([], list(cols), "column_name", "n_lost")


@query("parse_composite", "P9 X5", sql="""
SELECT o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_num
FROM orders
""")
def parse_composite_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    return o.select("o_orderkey", leading_int(F.col("o_orderpriority")).alias("priority_num"))


@query("fill_constant", "P10", sql=f"""
WITH {CS_SQL}
SELECT c_custkey, c_name, grp, seg, n_orders, round(spend, 6) AS spend,
       round(coalesce(avg_price, 0.0), 6) AS avg_price, round(coalesce(acctbal, 0.0), 6) AS acctbal,
       round(qty, 6) AS qty, n_items, round(coalesce(avg_disc, 0.0), 6) AS avg_disc,
       round(avg_tax, 6) AS avg_tax FROM cs
""")
def fill_constant_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir)
    return round_doubles(schema.fill_constant(cs, {"avg_price": 0.0, "acctbal": 0.0,
                                                   "avg_disc": 0.0}))


@query("conditional_overwrite", "P11 T9", sql=f"""
WITH {CS_SQL}
SELECT c_custkey, seg,
       round(CASE WHEN seg = 'AUTOMOBILE' THEN acctbal ELSE 0.0 END, 6) AS acctbal,
       round(CASE WHEN seg = 'AUTOMOBILE' THEN avg_disc ELSE 0.0 END, 6) AS avg_disc,
       round(spend, 6) AS spend FROM cs
""")
def conditional_overwrite_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir).select("c_custkey", "seg", "acctbal", "avg_disc", "spend")
    out = schema.conditional_overwrite(cs, ["acctbal", "avg_disc"],
                                       F.col("seg") == F.lit("AUTOMOBILE"), 0.0)
    return round_doubles(out)


@query("derived_feature", "P12 X14", sql=f"""
WITH {CS_SQL}
SELECT c_custkey, round(spend + acctbal, 6) AS spend_plus_balance,
       CAST(n_orders + n_items AS BIGINT) AS activity FROM cs
""")
def derived_feature_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir)
    out = schema.derived_sum(schema.derived_sum(cs, "spend_plus_balance", "spend", "acctbal"),
                             "activity", "n_orders", "n_items")
    return out.select("c_custkey", rnd("spend_plus_balance").alias("spend_plus_balance"),
                      "activity")


@query("one_hot", "P16 T25", sql="""
SELECT c_custkey, c_mktsegment,
       coalesce(c_mktsegment = 'BUILDING', false) AS seg_BUILDING,
       coalesce(c_mktsegment = 'FURNITURE', false) AS seg_FURNITURE,
       coalesce(c_mktsegment = 'HOUSEHOLD', false) AS seg_HOUSEHOLD,
       coalesce(c_mktsegment = 'MACHINERY', false) AS seg_MACHINERY
FROM customer
""")
def one_hot_q(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return schema.one_hot(c, "c_mktsegment", prefix="seg")


@query("one_hot_sparse", "P16 T25", sql="""
WITH k AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_nationkey || ' ' || c_mktsegment END AS level
           FROM customer),
l AS (SELECT level, row_number() OVER (ORDER BY level) - 2 AS p FROM (SELECT DISTINCT level FROM k
      WHERE level IS NOT NULL))
SELECT c_custkey, k.level, CAST(CASE WHEN p >= 0 THEN p END AS INTEGER) AS hot,
       CAST((SELECT count(*) - 1 FROM l) AS INTEGER) AS width
FROM k LEFT JOIN l ON k.level = l.level
""")
def one_hot_sparse_q(spark, sf_dir):
    """One sparse vector column instead of one column a level; ``hot`` is the
    place of its one, read back from the vector."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"])
    k = c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.concat_ws(
        " ", F.col("c_nationkey").cast("string"), "c_mktsegment")).alias("level"))
    out, _ = schema.one_hot_sparse(k, "level")
    v = vector_to_array("onehot")
    hot = F.array_position(v, F.lit(1.0)).cast("int") - 1
    return out.select("c_custkey", "level", F.when(hot >= 0, hot).alias("hot"), F.size(v).alias("width"))


@query("threshold_filter", "F2", sql=f"""
WITH {CS_SQL} SELECT c_custkey, c_name, round(spend, 6) AS spend FROM cs WHERE spend > 2500000.0
""")
def threshold_filter_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir).select("c_custkey", "c_name", "spend")
    return round_doubles(filters.threshold(cs, "spend", 2500000.0))


@query("drop_all_null", "F5", sql=f"""
WITH {CS_SQL}
SELECT c_custkey, round(avg_price, 6) AS avg_price, round(acctbal, 6) AS acctbal,
       round(avg_disc, 6) AS avg_disc FROM cs
WHERE NOT (avg_price IS NULL AND acctbal IS NULL AND avg_disc IS NULL)
""")
def drop_all_null_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir).select("c_custkey", "avg_price", "acctbal", "avg_disc")
    return round_doubles(filters.drop_all_null(cs, ["avg_price", "acctbal", "avg_disc"]))


@query("dedupe_keep_first", "F9 T28", sql="""
SELECT p_partkey, p_name, p_brand, p_size FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1
""")
def dedupe_keep_first_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_size"])
    return filters.dedupe_keep_first(p, ["p_name"], ["p_partkey"])


@query("valid_groups", "F3 F4", sql=f"""
WITH {CS_SQL}
SELECT grp, count(*) AS n FROM cs WHERE grp IS NOT NULL GROUP BY grp
HAVING count(*) >= {MIN_GROUP_MEMBERS} AND grp IN ({ALLOW_SQL})
""")
def valid_groups_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir)
    return filters.valid_groups(cs, "grp", allow_list_df(spark), MIN_GROUP_MEMBERS)


@query("group_counts", "A6 A7 O3", sql=f"""
WITH {CS_SQL}
SELECT grp, count(c_name) AS n,
       CAST(row_number() OVER (ORDER BY count(c_name) DESC, grp) AS BIGINT) AS pos
FROM cs WHERE grp IS NOT NULL GROUP BY grp
""")
def group_counts_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir)
    return rank.numbered(agg.group_counts(cs, "grp", "c_name").orderBy(F.col("n").desc(), "grp"))


@query("invalid_groups", "U2 A18", sql=f"""
WITH {CS_SQL}
SELECT DISTINCT grp FROM cs WHERE grp IS NOT NULL
EXCEPT SELECT * FROM (VALUES {", ".join(f"('{g}')" for g in GROUP_ALLOW_LIST)}) t(grp)
""")
def invalid_groups_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir)
    present = cs.select("grp").filter(F.col("grp").isNotNull()).distinct()
    return present.join(broadcast_if_small(allow_list_df(spark).select("grp")), "grp", "left_anti")


@query("segment_split", "F7 U1 T9", sql=f"""
WITH {CS_SQL}
SELECT c_custkey, c_name, seg, round(acctbal, 6) AS acctbal, round(avg_disc, 6) AS avg_disc
FROM cs WHERE seg = 'AUTOMOBILE'
UNION ALL BY NAME
SELECT c_custkey, c_name, seg, round(spend, 6) AS spend, round(qty, 6) AS qty
FROM cs WHERE seg IS DISTINCT FROM 'AUTOMOBILE'
""")
def segment_split_q(spark, sf_dir):
    cs = entity_stats(spark, sf_dir)
    a, b = filters.split_by_segment(cs, "seg", "AUTOMOBILE")
    a = a.select("c_custkey", "c_name", "seg", "acctbal", "avg_disc")
    b = b.select("c_custkey", "c_name", "seg", "spend", "qty")
    return round_doubles(a.unionByName(b, allowMissingColumns=True))
