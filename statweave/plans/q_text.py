"""Text and page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..session import cut_lineage
from ..sources import pages as pg
from ..sources.tables import read_table, spread
from ..specs import REFERENCE_NAME_ALIASES, REFERENCE_STOP_TOKENS, MeasureSpec, TableSpec
from .entity import once
from .ingest import ingest
from .registry import query, round_doubles

WS = text.WS
WS_BODY = text.WS_BODY


@query("extract_uppercase", "X4", sql=f"""
SELECT doc_id, nullif(regexp_replace(text, '{text.UPPER_CLASS}', '', 'g'), '') AS upper_only
FROM documents
""")
def extract_uppercase_q(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return d.select("doc_id", text.extract_uppercase(F.col("text")).alias("upper_only"))


def _trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '\\A{WS}+|{WS}+\\z', '', 'g')"


@query("sanitize_name", "X9 T32", sql=f"""
SELECT doc_id,
       {_trim_sql(f"regexp_replace(replace(replace(text, '/', '_'), '%', 'percent'), '{text.SANITIZE_CLASS}', '_', 'g')")}
         AS safe_name
FROM documents
""")
def sanitize_name_q(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return d.select("doc_id", text.sanitize_name(F.col("text")).alias("safe_name"))


_ALIAS_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REFERENCE_NAME_ALIASES.items())
_STOP = ", ".join(f"'{t}'" for t in REFERENCE_STOP_TOKENS)


def normalize_sql(col: str) -> str:
    """DuckDB form of ``functions.text.normalize_name`` over ``col``."""
    inner = f"""array_to_string(
    list_filter(
      list_transform(
        list_filter(string_split_regex({_trim_sql(f"lower(strip_accents({col}))")}, '{WS}+'),
                    lambda t: t <> ''),
        lambda t: {_trim_sql("regexp_replace(t, '\\A\\.+|\\.+\\z', '', 'g')")}),
      lambda t: t NOT IN ({_STOP})), ' ')"""
    return f"(CASE {inner} {_ALIAS_CASE} ELSE {inner} END)"


@query("normalize_name", "X6 X7 X8", sql=f"""
SELECT doc_id, {normalize_sql("text")} AS normalized FROM documents
""")
def normalize_name_q(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return d.select("doc_id", text.normalize_name(F.col("text")).alias("normalized"))


ANCHOR = r'<a href="([^"]*)">([^<]*)</a>'


@query("html_link_extract", "S2 X13", sql=f"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '{ANCHOR}', 1) AS h,
                  regexp_extract_all(html, '{ANCHOR}', 2) AS t FROM pages),
y AS (SELECT page_id, h, t, unnest(range(len(h))) AS i FROM x)
SELECT page_id, CAST(i AS INTEGER) AS link_no, h[i + 1] AS href,
       nullif(regexp_extract(h[i + 1], '^/([^/?#]+)', 1), '') AS link_key,
       t[i + 1] AS link_text FROM y
""")
def html_link_extract_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", ["page_id", "html"])
    links = p.select("page_id", F.posexplode(F.arrays_zip(
        F.regexp_extract_all("html", F.lit(ANCHOR), 1).alias("href"),
        F.regexp_extract_all("html", F.lit(ANCHOR), 2).alias("text"))).alias("link_no", "a"))
    return links.select("page_id", "link_no", F.col("a.href").alias("href"),
                        F.nullif(F.regexp_extract("a.href", r"^/([^/?#]+)", 1), F.lit(""))
                        .alias("link_key"),
                        F.col("a.text").alias("link_text"))


# Statistics pages rendered from the line items: one page per 64 orders, one
# keyed row per line item, a two-level header with a repeated label.  Of three
# pages one is well formed, one omits its end tags and one has no <thead>;
# every tenth page lost its table.
PAGE_ORDERS = 64
FIRST_PAGE = 1_000_000_000
# Table rows that one task renders and parses.
TASK_ROWS = 50_000
_HEADS = ["Order", "Qty", "Cents", "Qty"]


def _render(df, first_page, url, key, order, cells, tops, heads):
    """Statistics pages (page_id, url, html): ``PAGE_ORDERS`` keys a page, one
    row per row of ``df`` in ``order``, a keyed link and ``cells``."""
    page = F.floor(F.col(key) / PAGE_ORDERS) + first_page
    kind = F.col("page_id") % 3

    def td(text, attrs=""):
        return F.concat(F.lit(f"<td{attrs}>"), text, F.when(kind == 1, "").otherwise("</td>"))
    k = F.col(key).cast("string")
    link = F.concat(F.lit('<a href="/players/o'), k, F.lit('/x">Order '), k, F.lit("</a>"))
    row = F.concat(F.lit("<tr>"), td(link, ' data-stat="player"'), *[td(F.col(c)) for c in cells],
                   F.when(kind == 1, "\n").otherwise("</tr>\n"))
    # Parsing is heavy for its bytes, by which Spark would merge these partitions.
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    rows = df.withColumn("page_id", page).withColumn("row", row).repartition(tasks, "page_id")
    body = rows.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct(*order, "row"))), lambda r: r["row"]), "").alias("body"))
    top = "<tr>" + "".join(f'<th colspan="{n}">{t}</th>' for t, n in tops) + "</tr>"
    low = "<tr>" + "".join(f"<th>{h}</th>" for h in heads) + "</tr>"
    html = F.when(F.col("page_id") % 10 == 0, F.lit("<html><p>gone</p></html>")).otherwise(F.concat(
        F.lit('<html><table id="t">'),
        F.when(kind == 2, F.lit(top + low)).otherwise(F.lit(f"<thead>{top}{low}</thead><tbody>")),
        F.col("body"), F.when(kind == 1, "").otherwise("</table></html>")))
    return body.select("page_id", F.concat(F.lit(f"http://stats.test{url}"), F.col("page_id"))
                       .alias("url"), html.alias("html"))


def _cents(c):
    return F.round(F.col(c) * 100).cast("long")


def rendered_pages(spark, sf_dir):
    """Pages of line items."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])
    li = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("qty"),
                   _cents("l_extendedprice").alias("cents"))
    li = li.select("*", *[F.col(c).cast("string").alias(t) for c, t in (
        ("qty", "t_qty"), ("cents", "t_cents"), ("l_linenumber", "t_line"))])
    return _render(li, FIRST_PAGE, "/lines/", "l_orderkey",
                   ["l_orderkey", "l_linenumber", "qty", "cents"], ["t_qty", "t_cents", "t_line"],
                   [("", 1), ("Amount", 2), ("Other", 1)], _HEADS)


def order_pages(spark, sf_dir):
    """Pages of order totals, a second source for the same keys."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]).select(
        "o_orderkey", _cents("o_totalprice").cast("string").alias("total"))
    return _render(o, 2 * FIRST_PAGE, "/totals/", "o_orderkey", ["o_orderkey", "total"], ["total"],
                   [("", 1), ("Money", 1)], ["Order", "Total"])


def stored_pages(spark, sf_dir):
    """The given pages and the rendered ones."""
    return spread(read_table(spark, sf_dir, "pages", ["page_id", "html"])).unionByName(
        rendered_pages(spark, sf_dir).drop("url"))


def page_states(spark, sf_dir):
    """The status of all stored pages, once a session. Cells are many times
    larger than their pages, so they are never stored on the way."""
    return once(spark, sf_dir, "page states", lambda: cut_lineage(
        pg.page_status(stored_pages(spark, sf_dir), with_cells=False)))


_RENDERED_SQL = f"""
li AS (SELECT {FIRST_PAGE} + l_orderkey // {PAGE_ORDERS} AS page_id, l_orderkey, l_linenumber,
              CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty,
              CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS cents FROM lineitem)"""


@query("html_table_extract", "S1 S2 S3 F1 J2", sql=f"""
WITH {_RENDERED_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY l_orderkey, l_linenumber,
                                   CAST(qty AS BIGINT), CAST(cents AS BIGINT)) - 1 AS n
      FROM li WHERE page_id % 10 <> 0)
SELECT CAST(page_id AS BIGINT) AS page_id, 0 AS table_no, CAST(n AS INTEGER) AS row_no, col_no,
       header_top, header, name,
       CASE col_no WHEN 0 THEN 'Order ' || l_orderkey WHEN 1 THEN qty WHEN 2 THEN cents
            ELSE CAST(l_linenumber AS VARCHAR) END AS value,
       'o' || l_orderkey AS entity_key, 'Order ' || l_orderkey AS entity_name
FROM r, (VALUES (0, '', 'Order', 'Order'), (1, 'Amount', 'Qty', 'Qty'),
                (2, 'Amount', 'Cents', 'Cents'), (3, 'Other', 'Qty', NULL))
        AS h(col_no, header_top, header, name)
""")
def html_table_extract_q(spark, sf_dir):
    return pg.extract_cells(stored_pages(spark, sf_dir))


@query("page_extract_status", "S4", sql=f"""
WITH {_RENDERED_SQL}
SELECT page_id, 0 AS n_tables, CAST(NULL AS INTEGER) AS table_no, 0 AS n_rows, 0 AS n_keyed_rows,
       'no_table' AS status, CAST(NULL AS VARCHAR) AS error FROM pages
UNION ALL
SELECT CAST(page_id AS BIGINT), CASE WHEN page_id % 10 = 0 THEN 0 ELSE 1 END,
       CASE WHEN page_id % 10 = 0 THEN NULL ELSE 0 END,
       CAST(CASE WHEN page_id % 10 = 0 THEN 0 ELSE count(*) END AS INTEGER),
       CAST(CASE WHEN page_id % 10 = 0 THEN 0 ELSE count(*) END AS INTEGER),
       CASE WHEN page_id % 10 = 0 THEN 'no_table' ELSE 'ok' END, NULL
FROM li GROUP BY page_id
""")
def page_extract_status_q(spark, sf_dir):
    return page_states(spark, sf_dir)


# The stage-1 pipeline over two sources of rendered pages.
INGEST_SPECS = [
    TableSpec("lines", "/lines/", ("Player", "Qty", "Cents", "Qty.1"), {"Qty.1": "Line"}, table_id="t"),
    TableSpec("totals", "/totals/", ("Player", "Total"), {}, table_id="t"),
    TableSpec("missing", "/missing/", ("Player", "Lost"), {}),
]
INGEST_MEASURES = [MeasureSpec("Qty"), MeasureSpec("Cents"), MeasureSpec("Line", agg="mean"),
                   MeasureSpec("Total"), MeasureSpec("Lost")]
INGEST_MIN = 50


def _ingested(spark, sf_dir, mode):
    return once(spark, sf_dir, f"ingested-{mode}", lambda: _ingest(spark, sf_dir, mode))


def _ingest(spark, sf_dir, mode):
    pages = spread(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])).unionByName(
        rendered_pages(spark, sf_dir)).unionByName(order_pages(spark, sf_dir))
    return ingest(pages, INGEST_SPECS, INGEST_MEASURES, {"Player": "first"}, mode, "Qty", INGEST_MIN)


def _ingest_sql(fanout: bool) -> str:
    qty, cents = ("l.qty", "l.cents")
    total = "coalesce(t.cents, 0)" + (" * l.n" if fanout else "")
    return f"""
WITH l AS (
  SELECT l_orderkey AS k, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS qty,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents, avg(l_linenumber) AS line
  FROM lineitem WHERE ({FIRST_PAGE} + l_orderkey // {PAGE_ORDERS}) % 10 <> 0 GROUP BY l_orderkey),
t AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
      WHERE ({2 * FIRST_PAGE} + o_orderkey // {PAGE_ORDERS}) % 10 <> 0)
SELECT 'o' || l.k AS entity_key, 'Order ' || l.k AS "Player", CAST({qty} AS DOUBLE) AS "Qty",
       CAST({cents} AS DOUBLE) AS "Cents", round(line, 6) AS "Line",
       CAST({total} AS DOUBLE) AS "Total", CAST(NULL AS DOUBLE) AS "Lost"
FROM l LEFT JOIN t ON l.k = t.k WHERE {qty} > {INGEST_MIN}
"""


@query("ingest_entities", "S1-S4 S11 P1-P8 J1 A1 A2 F1 F2 O1", sql=_ingest_sql(False))
def ingest_entities_q(spark, sf_dir):
    return round_doubles(_ingested(spark, sf_dir, "aggregate")[0])


@query("ingest_entities_fanout", "S1-S4 S11 J1 T1", sql=_ingest_sql(True))
def ingest_entities_fanout_q(spark, sf_dir):
    return round_doubles(_ingested(spark, sf_dir, "fanout")[0])


@query("ingest_failures", "S4 T27", sql=f"""
SELECT DISTINCT {FIRST_PAGE} + l_orderkey // {PAGE_ORDERS} AS page_id, 'lines' AS "table",
       'no_table' AS status FROM lineitem WHERE ({FIRST_PAGE} + l_orderkey // {PAGE_ORDERS}) % 10 = 0
UNION ALL
SELECT DISTINCT {2 * FIRST_PAGE} + o_orderkey // {PAGE_ORDERS}, 'totals', 'no_table'
FROM orders WHERE ({2 * FIRST_PAGE} + o_orderkey // {PAGE_ORDERS}) % 10 = 0
UNION ALL SELECT NULL, 'missing', 'no_rows'
""")
def ingest_failures_q(spark, sf_dir):
    return _ingested(spark, sf_dir, "aggregate")[1].select("page_id", "table", "status")
