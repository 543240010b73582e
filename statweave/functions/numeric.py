"""Numeric column functions: coercion with bad values nulled, NaN handling,
composite parsing, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import MISSING_SENTINEL


def nan_to_null(c: Column) -> Column:
    """pandas treats NaN as missing; Spark orders NaN above everything (T5)."""
    return F.when(~F.isnan(c), c)


def coerce_numeric(c: Column, to: str = "double") -> Column:
    """``pd.to_numeric(errors='coerce')``: unparsable -> NULL, 'nan' -> NULL.
    Uses ``try_cast`` because ANSI mode makes plain ``cast`` raise (T6)."""
    t = F.trim(c.cast("string"))
    v = t.try_cast(to)
    return nan_to_null(v) if to in ("double", "float") else v


def coercion_lost(c: Column, to: str = "double") -> Column:
    """1 when a present value was lost by coercion, else 0."""
    return F.when(c.isNotNull() & coerce_numeric(c, to).isNull(), 1).otherwise(0)


def leading_int(c: Column, sep: str = "-") -> Column:
    """Leading integer of a composite such as ``'25-123'``; ``'25.0'`` is 25
    (P9, X5)."""
    lead = F.split_part(c.cast("string"), F.lit(sep), F.lit(1))
    return F.coalesce(lead.try_cast("int"), nan_to_null(lead.try_cast("double")).try_cast("int"))


def format_2dp(c: Column) -> Column:
    """Two-decimal text, the missing sentinel when NULL (X10). The pattern
    form rounds the binary value, ties to even, as C and Python do."""
    text = F.call_function("format_number", c.cast("double"), F.lit("0.00"))
    return F.coalesce(text, F.lit(MISSING_SENTINEL))


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Round the binary value: scale, round half away from zero, unscale.
    (Spark's ``round`` rounds the shortest decimal string instead, which
    differs from SQL engines on values such as 0.0578125.)"""
    c = F.col(c) if isinstance(c, str) else c
    p = float(10 ** digits)
    # keep the sign of zero as C's round() does (-0.4e-6 -> -0.0)
    return (F.when(c < 0, -(F.round(-c * F.lit(p), 0) / F.lit(p)))
             .when(c == 0, c)
             .otherwise(F.round(c * F.lit(p), 0) / F.lit(p)))
