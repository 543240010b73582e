"""The corpus pipeline: stages over documents, each a call of one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the next stage's documents.  ``run`` chains them, writing each
stage's result as Parquet into the shared folder and reading it again, so a
lost executor never repeats more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statweave.llm import langid, mixing, packing, quality, simhash
from statweave.session import scratch_path
from statweave.sources.tables import table_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    return langid.keep(docs)


def dedupe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (3-word shingles, two
    bits)."""
    return simhash.dedupe(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.apply(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", dedupe_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Language models, fingerprints, sampling and tokenizing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
