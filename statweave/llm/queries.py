"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, langid, licenses, main_text, mixing, negatives, packing, quality, search,
               simhash, toxicity, url_reputation, whitening)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


_STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))

_QUALITY_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)
), win AS (
  SELECT rid, i,
    count(*) OVER (PARTITION BY rid, w, w2, w3, w4, w5) AS n
  FROM (SELECT rid, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3,
               lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
        FROM w WINDOW o AS (PARTITION BY rid ORDER BY i))
  WHERE w5 IS NOT NULL
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM win, (SELECT unnest(range(0, 5)) AS k) WHERE win.n > 1 GROUP BY rid
), wc AS (
  SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars,
         sum(CASE WHEN lower(w) IN ({_STOPS}) THEN 1 ELSE 0 END) AS stops
  FROM w GROUP BY rid
), l AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words,
    coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(stops, 0) AS stops
  FROM d LEFT JOIN wc USING (rid) LEFT JOIN l USING (rid) LEFT JOIN covered USING (rid)
), b AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  (NOT base_failed
   AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words
   AND n_symbols::DOUBLE / n_words <= 0.1
   AND stops::DOUBLE / n_words >= 0.05
   AND n_dup_lines <= 0.5 * n_lines AND n_upper <= 0.5 * word_chars) AS kept
FROM b
"""


@query(_QUALITY_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every whole text of documents."""
    return quality.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of every document: 3-word shingles, two bits."""
    return simhash.classes(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op4_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by PPM code length."""
    return langid.identify(table(spark, sf_dir, "documents", "doc_id", "lang", "text"))


@query()
def op3_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by cube-method sampling."""
    return mixing.report(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


@query()
def op2_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in cost-balanced sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op1_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places of every document."""
    return licenses.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op8_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query()
def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or reputation verdict of every page's url."""
    return url_reputation.judge(table(spark, sf_dir, "pages", "page_id", "url"),
                                table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


@query()
def op10_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document: toxic, then severe (toxic and of low
    quality), by a classifier chain."""
    toxic = F.col("toxic") == 1
    return toxicity.classify(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"),
        {"toxic": toxic, "severe": toxic & (F.col("quality") == 0)})


@query()
def op7_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents by BM25 for every document whose id is
    divisible by 20."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    asked = docs.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    return search.top_k(docs, asked)


@query()
def op12_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op13_sturm_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    return whitening.report(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query()
def op11_one_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose id is divisible by 50."""
    return negatives.report(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))
