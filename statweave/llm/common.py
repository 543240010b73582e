"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.tables import table_path

# ASCII white space: space and the control characters 9 to 13.
WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The whole table, only the named columns (extra ones never get in)."""
    return spark.read.parquet(table_path(sf_dir, name)).select(*columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Spark has no let-expression; a one-element ``transform`` binds the value
    to a lambda variable, so a large array is never computed twice."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``."""
    return cut_lineage(df)


ROWS_PER_FILE = 20_000


def cut_narrow(df: DataFrame, most_rows: int) -> DataFrame:
    """Checkpoint of narrow rows, at most ``most_rows`` of them, in no more
    files than they fill: where a shuffle has far more partitions than the
    rows need, nearly empty checkpoint files would cost more than the rows."""
    return cut(df.coalesce(max(1, -(-most_rows // ROWS_PER_FILE))))


def rows_of(df: DataFrame, keep: str = "_row") -> DataFrame:
    """The whole row as one struct, so that working columns beside it cannot
    clash with whatever columns the input has."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(keep))


BROADCAST_BYTES = 16 << 20


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a written table whose measured size is at most
    ``max_bytes``; a larger one is left to a shuffle join, which AQE splits
    where it is skewed."""
    width = F.lit(16)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        width = width + (F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + 8
                         if kind == "string" else F.lit(16))
    size = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
