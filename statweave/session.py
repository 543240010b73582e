"""Spark session and shared-storage helpers.

Everything in the library is a DataFrame -> DataFrame function; this module
only builds a session with the settings the operators assume (AQE on, UTC
session time zone, Arrow on, UI off) and resolves the shared folder used to
cut lineage and to stage file sinks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "statweave",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("STATWEAVE_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster the setting must be given; only a local-mode session (tests,
    the bench) gets a fresh scratch folder of its own when it is unset.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="statweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for a staged result."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_bytes: int = 16 << 20) -> DataFrame:
    """Broadcast hint only behind a size check in bytes: fixed-width columns
    count 16 bytes, strings and binaries their length. At most
    ``max_bytes / 16`` rows are measured (an early-stopping limit). Beyond the
    bound the frame is returned as is and the join is planned by AQE from
    measured sizes (sort-merge with skew splitting)."""
    from pyspark.sql import functions as F
    width = F.lit(16)
    for f in df.schema.fields:
        width = width + (F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + 16
                         if f.dataType.typeName() in ("string", "binary") else F.lit(16))
    size = df.limit(max_bytes // 16 + 1).agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
