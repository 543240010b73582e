"""Join, aggregate and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as agg
from ..operators import joins, rank, setops
from ..sources.tables import read_table
from .registry import query, round_doubles

FLAGS = ["R", "A", "N"]


def _flag_sides(spark, sf_dir):
    """Orders as the base; the line items of each return flag as one side.
    The three sides are slices of one table, so they are reduced in one
    pass (``SplitSource``)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_returnflag", "l_linestatus"])
    li = (li.withColumn("_row", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
            .withColumnRenamed("l_orderkey", "o_orderkey"))
    parts = {}
    for f in FLAGS:
        t = f.lower()
        parts[f"li_{t}"] = (f, {f"qty_{t}": ("sum", "l_quantity"),
                                f"price_{t}": ("mean", "l_extendedprice"),
                                f"status_{t}": ("first", "l_linestatus"),
                                f"lines_{t}": ("count", "l_linenumber")})
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderstatus"])
    base = joins.Side("orders", o, {"n_base": ("count", "o_orderkey"),
                                    "status": ("first", "o_orderstatus")}, "o_orderkey")
    return base, [joins.SplitSource(li, "l_returnflag", parts, "_row")]


def _wide_sql(fanout: bool) -> str:
    if fanout:
        joins_sql = "\n".join(
            f"LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = '{f}') {f.lower()} "
            f"ON o.o_orderkey = {f.lower()}.l_orderkey" for f in FLAGS)
        cols = ",\n".join(
            f"CAST(coalesce(sum({t}.l_quantity), 0) AS DOUBLE) AS qty_{t}, "
            f"round(avg({t}.l_extendedprice), 6) AS price_{t}, "
            f"arg_min({t}.l_linestatus, ({t}.l_orderkey * 8 + {t}.l_linenumber, {t}.l_linestatus)) "
            f"FILTER (WHERE {t}.l_linestatus IS NOT NULL) AS status_{t}, "
            f"count({t}.l_linenumber) AS lines_{t}"
            for t in (f.lower() for f in FLAGS))
        return f"""
SELECT o.o_orderkey, count(o.o_orderkey) AS n_base, arg_min(o.o_orderstatus, (o.o_orderkey, o.o_orderstatus)) AS status,
{cols}
FROM orders o
{joins_sql}
GROUP BY o.o_orderkey
"""
    subs = "\n".join(
        f"""LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty_{t}, avg(l_extendedprice) AS price_{t},
       arg_min(l_linestatus, (l_orderkey * 8 + l_linenumber, l_linestatus)) FILTER (WHERE l_linestatus IS NOT NULL) AS status_{t},
       count(l_linenumber) AS lines_{t}
     FROM lineitem WHERE l_returnflag = '{f}' GROUP BY l_orderkey) {t} ON o.o_orderkey = {t}.l_orderkey"""
        for f, t in ((f, f.lower()) for f in FLAGS))
    cols = ",\n".join(
        f"coalesce({t}.qty_{t}, 0.0) AS qty_{t}, round({t}.price_{t}, 6) AS price_{t}, "
        f"{t}.status_{t} AS status_{t}, coalesce({t}.lines_{t}, 0) AS lines_{t}"
        for t in (f.lower() for f in FLAGS))
    return f"""
SELECT o.o_orderkey, o.n_base, o.status,
{cols}
FROM (SELECT o_orderkey, count(o_orderkey) AS n_base, arg_min(o_orderstatus, (o_orderkey, o_orderstatus)) AS status
      FROM orders GROUP BY o_orderkey) o
{subs}
"""


@query("wide_left_join", "J1 A1 T1", sql=_wide_sql(False))
def wide_left_join_q(spark, sf_dir):
    base, sides = _flag_sides(spark, sf_dir)
    return round_doubles(joins.wide_left_join(base, sides, "o_orderkey", mode="aggregate"))


@query("wide_left_join_fanout", "J1 T1 T2", sql=_wide_sql(True))
def wide_left_join_fanout_q(spark, sf_dir):
    base, sides = _flag_sides(spark, sf_dir)
    return round_doubles(joins.wide_left_join(base, sides, "o_orderkey", mode="fanout"))


HREF = r'<a href="([^"]*)">'
TEXT = r'<a href="[^"]*">([^<]*)</a>'


@query("positional_zip", "J2 T29", sql=f"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '{HREF}', 1) AS h,
                  regexp_extract_all(html, '{TEXT}', 1) AS t FROM pages),
y AS (SELECT page_id, h, t, unnest(range(greatest(len(h), len(t)))) AS i FROM x)
SELECT page_id, CAST(i AS INTEGER) AS pos, h[i + 1] AS href, t[i + 1] AS text,
       len(h) = len(t) AS lengths_match FROM y
""")
def positional_zip_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", ["page_id", "html"])
    arrays = p.select("page_id", F.regexp_extract_all("html", F.lit(HREF), 1).alias("href"),
                      F.regexp_extract_all("html", F.lit(TEXT), 1).alias("text"))
    return joins.positional_zip(arrays, "href", "text", keep=["page_id"])


@query("semi_join", "J3", sql="""
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000.0)
""")
def semi_join_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    s = (read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_acctbal"])
         .filter(F.col("s_acctbal") > 5000.0).select(F.col("s_suppkey").alias("l_suppkey")))
    return joins.semi_join(li, s, "l_suppkey")


@query("lookup_join", "J5", sql="""
SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def lookup_join_q(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]) \
        .withColumnRenamed("n_nationkey", "s_nationkey")
    return joins.lookup_join(s, n, "s_nationkey").select("s_suppkey", "s_name", "n_name")


# Priority list for containment matching of part names: 'old' precedes
# 'cold', so 'cold plate' resolves to 'old' (first hit wins, T13).
PART_WORDS = ["old", "gear", "cold", "red", "ring", "blue", "bolt", "hot"]


@query("containment_join", "J6 X1 X2 T13", sql=f"""
SELECT p_partkey, p_name,
       CASE {" ".join(f"WHEN contains(trim(p_name), '{w}') THEN '{w}'" for w in PART_WORDS)}
            ELSE trim(p_name) END AS matched
FROM part
""")
def containment_join_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return p.select("p_partkey", "p_name",
                    joins.first_contained(F.col("p_name"), PART_WORDS).alias("matched"))


@query("contained_passages", "J6 X2", sql="""
WITH n AS (
  SELECT trim(line) AS name, min(item_id * 1000 + i) AS priority
  FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM benchmark)
  WHERE trim(line) <> '' GROUP BY 1)
SELECT doc_id, arg_min(name, priority) AS passage, count(*) AS n_passages
FROM documents JOIN n ON contains(text, name) GROUP BY doc_id
""")
def contained_passages_q(spark, sf_dir):
    """Lines of the benchmark that a document contains: how many, and the
    first in benchmark order (J6 with a table of names that grows)."""
    lines = read_table(spark, sf_dir, "benchmark", ["item_id", "text"]).select(
        "item_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    names = (lines.select(F.trim("line").alias("name"), (F.col("item_id") * 1000 + F.col("i") + 1).alias("p"))
             .filter("name <> ''").groupBy("name").agg(F.min("p").alias("priority")))
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    hits = joins.contained_names(docs, "text", names, ["doc_id"])
    return hits.groupBy("doc_id").agg(F.min_by("name", "priority").alias("passage"),
                                      F.count(F.lit(1)).alias("n_passages"))


@query("mixed_agg", "A1 A2 A3 A4", sql="""
SELECT l_partkey,
       CAST(coalesce(sum(l_quantity), 0) AS DOUBLE) AS tot_qty,
       CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS DOUBLE) AS r_qty,
       round(avg(l_quantity), 6) AS mean_qty,
       round(avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 6) AS mean_r_qty,
       arg_min(CASE WHEN l_linestatus = 'F' THEN l_returnflag END,
               (l_orderkey * 8 + l_linenumber, CASE WHEN l_linestatus = 'F' THEN l_returnflag END))
         FILTER (WHERE l_linestatus = 'F') AS first_f_flag,
       count(*) AS n_lines
FROM lineitem GROUP BY l_partkey
""")
def mixed_agg_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag",
                     "l_linestatus"])
    li = li.select("l_partkey", "l_quantity",
                   (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_row"),
                   F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("r_q"),
                   F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("f_flag"))
    out = agg.mixed_agg(li, "l_partkey", {
        "tot_qty": ("sum", "l_quantity"), "r_qty": ("sum", "r_q"),
        "mean_qty": ("mean", "l_quantity"), "mean_r_qty": ("mean", "r_q"),
        "first_f_flag": ("first", "f_flag"), "n_lines": ("count", "_row")}, order_col="_row")
    return round_doubles(out)


@query("distinct_concat", "A5", sql="""
SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY p) AS priorities
FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS p FROM orders
      WHERE o_orderpriority IS NOT NULL GROUP BY o_custkey, o_orderpriority)
GROUP BY o_custkey
""")
def distinct_concat_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    return agg.distinct_concat(o, "o_custkey", "o_orderpriority", "o_orderkey", out="priorities")


@query("crosstab", "A14 T10", sql="""
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
       count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY l_returnflag
""")
def crosstab_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus"])
    return agg.crosstab(li, "l_returnflag", "l_linestatus", ["F", "O"])


NULL_COLS_SQL = """
SELECT l_orderkey, nullif(l_discount, 0.0) AS disc_nz,
       CASE WHEN l_returnflag = 'R' THEN l_tax END AS tax_r,
       CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS ship_open, l_quantity
FROM lineitem"""


@query("null_profile", "A17 X15", sql=f"""
WITH t AS ({NULL_COLS_SQL}),
a AS (SELECT count(*) AS n, {", ".join(f"count_if({c} IS NULL) AS {c}" for c in
      ["l_orderkey", "disc_nz", "tax_r", "ship_open", "l_quantity"])} FROM t)
SELECT column_name, CAST(n_null AS BIGINT) AS n_null, n AS n_rows,
       round(n_null * 100.0 / n, 6) AS pct_null, n_null * 100.0 / n > 50.0 AS warn
FROM a UNPIVOT (n_null FOR column_name IN (l_orderkey, disc_nz, tax_r, ship_open, l_quantity))
""")
def null_profile_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     "l_shipdate", "l_quantity"])
    t = li.select("l_orderkey", F.nullif("l_discount", F.lit(0.0)).alias("disc_nz"),
                  F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("tax_r"),
                  F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")).alias("ship_open"),
                  "l_quantity")
    return round_doubles(agg.null_profile(t).withColumnRenamed("column", "column_name"))


@query("multiset_diff", "U4", sql="""
SELECT o_orderpriority, 'only_left' AS side FROM (
  SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'F'
  EXCEPT ALL SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'O')
UNION ALL
SELECT o_orderpriority, 'only_right' AS side FROM (
  SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'O'
  EXCEPT ALL SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'F')
""")
def multiset_diff_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"])
    sides = o.filter(F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderpriority", F.when(F.col("o_orderstatus") == "F", 1).otherwise(-1).alias("sign"))
    return setops.signed_surplus(sides, ["o_orderpriority"], "sign")


@query("sort_by_first_token", "O1 X3", sql="""
SELECT p_partkey, p_name,
       coalesce(nullif(regexp_extract(p_name, '^[\\t\\n\\x0B\\f\\r ]*([^\\t\\n\\x0B\\f\\r ]+)', 1), ''),
                'Unknown') AS first_token,
       CAST(row_number() OVER (ORDER BY first_token, p_name, p_partkey) AS BIGINT) AS pos
FROM part
""")
def sort_by_first_token_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return rank.numbered(rank.sort_by_first_token(p, "p_name", ["p_name", "p_partkey"]))
