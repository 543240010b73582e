"""Query registry behind ``__spark_entry__.queries()`` / ``oracle_sql()``.

A query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators; its oracle is an independent DuckDB SQL string over the
same tables (``None`` for operators SQL cannot express: iterative matching,
ML fits, Python page parsing)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rnd  # noqa: F401  (re-exported for the query modules)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
OPS: dict[str, str] = {}

# Doubles are compared after rounding to this many places on both sides:
# sums in a different order differ in the last bits.
DIGITS = 6


def query(name: str, ops: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        OPS[name] = ops
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE column, keeping names and order."""
    return df.select(*[
        rnd(F.col(f"`{f.name}`"), digits).alias(f.name)
        if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def load_all() -> None:
    """Import every query module so its ``@query`` decorators run."""
    from . import (q_io, q_joins, q_match, q_ml, q_reports, q_schema,  # noqa: F401
                   q_text)
