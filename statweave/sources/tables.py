"""Readers for the parquet tables the engine runs on.

Reads are lazy and column-pruned: callers name the columns they need so the
parquet scan's ``ReadSchema`` holds only those.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region nation customer supplier part orders lineitem events "
               "documents embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view (for ``spark.sql`` users)."""
    for name in TABLE_NAMES:
        p = table_path(sf_dir, name)
        if os.path.exists(p):
            spark.read.parquet(p).createOrReplaceTempView(name)


def spread(df: DataFrame) -> DataFrame:
    """Spread a CPU-heavy, row-local stage over all cores when the scan gives
    fewer partitions than the cluster's parallelism (a single large parquet
    row group, say). With many input files (the normal case at scale) the
    scan already has more partitions than cores and no shuffle is added."""
    try:
        par = df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (remote session): leave the plan as is
        return df
    return df.repartition(par) if n < par else df
