"""File round trips (S5-S9): CSV with the missing sentinel, text reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files
from ..sources.tables import read_table
from ..specs import MIN_VALUES_TOP_K
from .q_reports import TEAM_SQL, stat_list_df, team_long
from .registry import query

ORDERS_CSV_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, "
                     "o_totalprice double, o_orderpriority string")


# Columns of the file whose types are inferred: one of each kind, one without
# any value, and two that need a wider type than some of their values.
INFER_COLUMNS = {
    "o_orderkey": "o_orderkey", "o_totalprice": "o_totalprice", "o_orderpriority": "o_orderpriority",
    "day": "CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))",
    "price_or_key": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS VARCHAR(30)) "
                    "ELSE CAST(o_orderkey AS VARCHAR(30)) END",
    "key_or_word": "CASE WHEN o_orderkey = 1 THEN 'one' ELSE CAST(o_orderkey AS VARCHAR(30)) END",
    "key_or_none": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END",
    "nothing": "CAST(NULL AS VARCHAR(1))",
}


def _infer_sql() -> str:
    texts = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({e} AS VARCHAR) AS v FROM orders"
                               for c, e in INFER_COLUMNS.items())
    counts = ", ".join(
        f"count(*) FILTER (WHERE regexp_full_match(v, '{p.strip('^$')}')"
        + (" AND try_cast(v AS DATE) IS NOT NULL" if t == "date" else "") + f") AS n_{t}"
        for t, p in files.TYPE_PATTERNS.items())
    cases = " ".join(f"WHEN n_{t} = n_values THEN '{t}'" for t in files.TYPE_PATTERNS)
    return (f"WITH v AS ({texts}), c AS (SELECT \"column\", count(v) AS n_values, {counts} FROM v GROUP BY 1) "
            f"SELECT *, CASE WHEN n_values = 0 THEN 'null' {cases} ELSE 'string' END AS type FROM c")


@query("csv_infer_types", "S5", sql=_infer_sql())
def csv_infer_types_q(spark, sf_dir):
    """Types of a written CSV's columns, found over all its rows."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate", "o_orderpriority"])
    t = o.select(*[F.expr(e).alias(c) for c, e in INFER_COLUMNS.items()])
    path = files.write_csv(t, scratch_path(spark, "infer-csv"), sentinel="N/a")
    return files.infer_types(spark.read.option("header", True).option("nullValue", "N/a").csv(path))


@query("csv_roundtrip", "S5 S6 S7 T4", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderpriority FROM orders
""")
def csv_roundtrip_q(spark, sf_dir):
    """Write with NULL rendered as the 'N/a' sentinel, read back with an
    explicit schema: the sentinel returns as NULL, numbers keep their type."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    o = o.withColumn("o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    path = files.write_csv(o, scratch_path(spark, "orders-csv"), sentinel="N/a")
    return files.read_csv(spark, path, ORDERS_CSV_SCHEMA, sentinel="N/a")


@query("report_text", "S8 X10 T31", sql=f"""
WITH {TEAM_SQL},
cnt AS (SELECT sl.stat, count(tl.value) AS n FROM sl LEFT JOIN tl ON sl.stat = tl.stat GROUP BY sl.stat),
r AS (SELECT tl.*, row_number() OVER (PARTITION BY stat ORDER BY value DESC, c_name, c_custkey) AS rh,
             row_number() OVER (PARTITION BY stat ORDER BY value ASC, c_name, c_custkey) AS rl
      FROM tl WHERE stat IN (SELECT stat FROM cnt WHERE n >= {MIN_VALUES_TOP_K}))
SELECT 'Top 3 ' || d.direction || ' for ' || stat || CASE WHEN n < {MIN_VALUES_TOP_K}
       THEN ': Insufficient data' ELSE ':' END AS line
FROM cnt, (VALUES ('highest'), ('lowest')) d(direction)
UNION ALL SELECT c_name || ': ' || printf('%.2f', value) FROM r WHERE rh <= 3
UNION ALL SELECT c_name || ': ' || printf('%.2f', value) FROM r WHERE rl <= 3
""")
def report_text_q(spark, sf_dir):
    """Render the top/bottom-3 report to text lines, write one text file,
    read it back. Numbers are formatted from their raw values."""
    rep = files.top_k_report(team_long(spark, sf_dir), stat_list_df(spark), 3, MIN_VALUES_TOP_K)
    lines = files.render_top_k_lines(rep, stat_list_df(spark))
    path = files.write_text_lines(lines, scratch_path(spark, "top3-txt"),
                                  ["pos", "direction", "rank"])
    return spark.read.text(path).withColumnRenamed("value", "line")
