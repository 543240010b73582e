"""Fuzzy matching queries (J7-J10, X12) on part names.

Targets are the distinct part names (order = first part key); the names to
place are the part names without their first character (so 'old plate' and
'cold plate' compete for 'ld plate'-like entries), normalised and
de-duplicated keeping the first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.similarity import masks_sql, ratio_bits_sql, ratio_sql
from ..functions.text import normalize_name
from ..operators import filters, match
from ..session import cut_lineage
from ..sources.tables import read_table
from ..specs import MATCH_THRESHOLD
from .entity import once
from .q_text import normalize_sql
from .registry import query


def targets(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    t = p.groupBy("p_name").agg(F.min("p_partkey").alias("rorder"))
    return t.select(F.col("p_name").alias("rid"), normalize_name(F.col("p_name")).alias("rtext"),
                    "rorder")


def lefts(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    raw = p.select(normalize_name(F.expr("substr(p_name, 2)")).alias("lid"), "p_partkey")
    first = filters.dedupe_keep_first(raw, ["lid"], ["p_partkey"])
    return first.select("lid", F.col("lid").alias("ltext"), F.col("p_partkey").alias("lprio"))


T_SQL = f"""
r AS (SELECT p_name AS rid, {normalize_sql("p_name")} AS rtext, min(p_partkey) AS rorder
      FROM part GROUP BY p_name),
l AS (SELECT {normalize_sql("substr(p_name, 2)")} AS lid, min(p_partkey) AS lprio
      FROM part GROUP BY lid)
"""


@query("fuzzy_candidates", "J7 X12 T20 T22", sql=f"""
WITH n AS (SELECT DISTINCT {normalize_sql("p_name")} AS name FROM part),
s AS (SELECT a.name AS name_a, b.name AS name_b, {ratio_sql("a.name", "b.name")} AS score
      FROM n a JOIN n b ON a.name < b.name)
SELECT * FROM s WHERE score >= {MATCH_THRESHOLD}
""")
def fuzzy_candidates_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_name"])
    names = p.select(normalize_name(F.col("p_name")).alias("lid")).distinct() \
             .withColumn("ltext", F.col("lid"))
    out = match.similarity_join(names, names, MATCH_THRESHOLD, self_join=True)
    return out.select(F.col("lid").alias("name_a"), F.col("rid").alias("name_b"), "score")


def _edges(spark, sf_dir):
    le, ta = lefts(spark, sf_dir), targets(spark, sf_dir)
    e = match.similarity_join(le.select("lid", "ltext"), ta.select("rid", "rtext"),
                              MATCH_THRESHOLD)
    return (e.join(le.select("lid", "lprio"), "lid").join(ta.select("rid", "rorder"), "rid")
             .select("lid", "rid", "score", "lprio", "rorder"))


def assigned(spark, sf_dir):
    """(lid, rid, score, round): the one-to-one match, once a session."""
    return once(spark, sf_dir, "assigned", lambda: cut_lineage(
        match.assign_one_to_one(_edges(spark, sf_dir))))


# The serial loop: lefts in priority order, each takes its best target that no
# earlier left has taken.
ASSIGN_SQL = f"""{T_SQL},
e AS (SELECT * FROM (SELECT lid, rid, lprio, rorder, {ratio_sql("lid", "rtext")} AS score
                     FROM l CROSS JOIN r) WHERE score >= {MATCH_THRESHOLD}),
o AS (SELECT lid, row_number() OVER (ORDER BY min(lprio), lid) AS i,
             list(rid ORDER BY score DESC, rorder) AS opts FROM e GROUP BY lid),
step AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS lid,
         CAST(NULL AS VARCHAR) AS rid
  UNION ALL
  SELECT o.i, list_append(s.taken, list_filter(o.opts, lambda x: NOT list_contains(s.taken, x))[1]),
         o.lid, list_filter(o.opts, lambda x: NOT list_contains(s.taken, x))[1]
  FROM step s JOIN o ON o.i = s.i + 1),
assigned AS (SELECT step.lid, step.rid, e.score FROM step JOIN e ON step.lid = e.lid AND step.rid = e.rid)"""


@query("fuzzy_assign", "J8 T21", sql=f"""
WITH RECURSIVE {ASSIGN_SQL}
SELECT lid AS left_name, rid AS target_name, score FROM assigned
""")
def fuzzy_assign_q(spark, sf_dir):
    a = assigned(spark, sf_dir)
    return a.select(F.col("lid").alias("left_name"), F.col("rid").alias("target_name"), "score")


@query("unmatched_entities", "J9 S9 U3", sql=f"""
WITH RECURSIVE {ASSIGN_SQL}
SELECT lid AS left_name, lprio FROM l WHERE lid NOT IN (SELECT lid FROM assigned)
""")
def unmatched_entities_q(spark, sf_dir):
    a = assigned(spark, sf_dir)
    le = lefts(spark, sf_dir)
    return le.join(a.select("lid"), "lid", "left_anti").select(
        F.col("lid").alias("left_name"), "lprio")


@query("near_misses", "J10 X12", sql=f"""
WITH {T_SQL},
s AS (SELECT lid, rid, rorder, {ratio_sql("lid", "rtext")} AS score FROM l CROSS JOIN r)
SELECT lid AS left_name, rid AS target_name, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lid ORDER BY score DESC, rorder, rid) AS rank FROM s)
WHERE rank <= 3
""")
def near_misses_q(spark, sf_dir):
    le, ta = lefts(spark, sf_dir), targets(spark, sf_dir)
    nm = match.near_misses(le.select("lid", "ltext"), ta, k=3)
    return nm.select(F.col("lid").alias("left_name"), F.col("rid").alias("target_name"),
                     "score", "rank")


@query("distinct_names", "U3 X6 X7 X8", sql=f"""
SELECT count(DISTINCT {normalize_sql("substr(p_name, 2)")}) AS n_distinct,
       count(DISTINCT {normalize_sql("p_name")}) AS n_targets FROM part
""")
def distinct_names_q(spark, sf_dir):
    """Distinct normalised names on each side of the match."""
    p = read_table(spark, sf_dir, "part", ["p_name"])
    n = p.select(normalize_name(F.expr("substr(p_name, 2)")).alias("l"),
                 normalize_name(F.col("p_name")).alias("r"))
    return n.agg(F.count_distinct("l").alias("n_distinct"), F.count_distinct("r").alias("n_targets"))


# ---- matching on texts that grow with the input -----------------------------
# Names: the normalised leading line of a document or benchmark item, or its
# first sentence; the first item that has a name gives it its order.
LINE, SENTENCE = "split_part(text, '\n', 1)", "split_part(split_part(text, '\n', 1), '.', 1)"


def _text_names(spark, sf_dir, table: str, key: str, part: str):
    """(name, first): distinct names of a table with their smallest key."""
    t = read_table(spark, sf_dir, table, [key, "text"]).filter("text IS NOT NULL")
    return t.select(normalize_name(F.expr(part)).alias("name"), key).groupBy("name").agg(
        F.min(key).alias("first"))


def _names_sql(part: str) -> str:
    part = part.replace("'\n'", "chr(10)")
    return f"""
l AS MATERIALIZED (SELECT {normalize_sql(part)} AS lid, min(doc_id) AS lprio FROM documents
      WHERE text IS NOT NULL GROUP BY 1),
r AS MATERIALIZED (SELECT *, {masks_sql("rid")} AS masks
      FROM (SELECT {normalize_sql(part)} AS rid, min(item_id) AS rorder FROM benchmark
            WHERE text IS NOT NULL GROUP BY 1)),
p AS MATERIALIZED (SELECT lid, lprio, rid, rorder, {ratio_bits_sql("rid", "masks", "lid")} AS score
      FROM l CROSS JOIN r)"""


@query("line_matches", "J7 X12", sql=f"""
WITH {_names_sql(LINE).replace("FROM l CROSS JOIN r", f"""FROM l JOIN r
      ON 400 * least(len(lid), len(rid)) > {2 * MATCH_THRESHOLD - 1} * (len(lid) + len(rid))""")}
SELECT lid AS line, rid AS item_line, score FROM p WHERE score >= {MATCH_THRESHOLD}
""")
def line_matches_q(spark, sf_dir):
    """Whole leading lines of documents similar to those of the benchmark."""
    lines = _text_names(spark, sf_dir, "documents", "doc_id", LINE).select(
        F.col("name").alias("lid"), F.col("name").alias("ltext"))
    items = _text_names(spark, sf_dir, "benchmark", "item_id", LINE).select(
        F.col("name").alias("rid"), F.col("name").alias("rtext"))
    return match.block_join(lines, items, MATCH_THRESHOLD).select(
        F.col("lid").alias("line"), F.col("rid").alias("item_line"), "score")


@query("unmatched_near_misses", "J8 J9 J10 X12", sql=f"""
WITH RECURSIVE {_names_sql(SENTENCE)},
{ASSIGN_SQL[ASSIGN_SQL.index("e AS ("):].replace(
    f"lid, rid, lprio, rorder, {ratio_sql('lid', 'rtext')} AS score", "lid, rid, lprio, rorder, score").replace(
    "FROM l CROSS JOIN r", "FROM p")}
SELECT lid AS left_name, rid AS target_name, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lid ORDER BY score DESC, rorder, rid) AS rank FROM p
  WHERE lid NOT IN (SELECT lid FROM assigned))
WHERE rank <= 3
""")
def unmatched_near_misses_q(spark, sf_dir):
    """Leading sentences of documents are matched one to one with those of the
    benchmark; those left over get their three nearest (J10 as the reference
    has it)."""
    le = _text_names(spark, sf_dir, "documents", "doc_id", SENTENCE).select(
        F.col("name").alias("lid"), F.col("name").alias("ltext"), F.col("first").alias("lprio"))
    ta = _text_names(spark, sf_dir, "benchmark", "item_id", SENTENCE).select(
        F.col("name").alias("rid"), F.col("name").alias("rtext"), F.col("first").alias("rorder"))
    le, ta = cut_lineage(le), cut_lineage(ta)
    edges = (match.block_join(le, ta, MATCH_THRESHOLD).select("lid", "rid", "score")
             .join(le.select("lid", "lprio"), "lid").join(ta.select("rid", "rorder"), "rid"))
    rest = le.join(match.assign_one_to_one(edges).select("lid"), "lid", "left_anti")
    return match.block_nearest(rest, ta, 3).select(
        F.col("lid").alias("left_name"), F.col("rid").alias("target_name"), "score", "rank")
