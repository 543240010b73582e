"""Projection and schema operators.

Header handling (P1-P5, P17) is metadata: names are computed on the driver
from the schema and applied in a single ``select``, so the data is touched
once, inside one codegen stage.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut_lineage
from .rank import numbered


# ------------------------------------------------------------- P1 / P3 --
def dedup_header_names(headers: list[str], suffixes: dict[str, list[str]],
                       unlisted: str = "keep_first") -> list[tuple[int, str]]:
    """Resolve repeated raw headers by occurrence number.

    The k-th occurrence of a header with a suffix list gets ``header +
    suffixes[k]``. Repeats beyond the list, and repeats of unlisted headers,
    are dropped (``unlisted='keep_first'``, pandas' ``duplicated(keep='first')``),
    numbered ``_2, _3, ...`` (``unlisted='number'``) or mangled ``.1, .2``
    as pandas' HTML reader names them (``unlisted='mangle'``). Returns (position,
    name) pairs of the kept columns, in order."""
    seen: Counter = Counter()
    out, taken = [], set()
    for pos, h in enumerate(headers):
        k = seen[h]
        seen[h] += 1
        sfx = suffixes.get(h)
        if sfx and k < len(sfx):
            name = h + sfx[k]
        elif k == 0:
            name = h
        elif unlisted == "number":
            name = f"{h}_{k + 1}"
        elif unlisted == "mangle":          # pandas read_html style: 'Gls', 'Gls.1'
            name = f"{h}.{k}"
        else:
            continue
        if name in taken:           # a suffixed name equal to a plain header
            continue
        taken.add(name)
        out.append((pos, name))
    return out


def apply_raw_headers(df: DataFrame, headers: list[str],
                      suffixes: dict[str, list[str]], unlisted: str = "keep_first") -> DataFrame:
    """Positional columns of ``df`` carry ``headers`` (which may repeat);
    return the de-duplicated, renamed projection (Spark cannot address two
    columns of one name, so positions are chosen before the select)."""
    if len(headers) != len(df.columns):
        raise ValueError(f"{len(headers)} headers for {len(df.columns)} columns")
    cols = df.columns
    return df.select(*[F.col(f"`{cols[p]}`").alias(n)
                       for p, n in dedup_header_names(headers, suffixes, unlisted)])


# ------------------------------------------------------------ P4 / P14 --
def select_rename(df: DataFrame, wanted: list[str], rename: dict[str, str] | None = None,
                  strict: bool = False) -> DataFrame:
    """Select wanted columns in order (list de-duplicated, missing ones
    skipped unless ``strict``), then rename to final names."""
    seen, keep = set(), []
    for c in wanted:
        if c in seen:
            continue
        seen.add(c)
        if c in df.columns:
            keep.append(c)
        elif strict:
            raise KeyError(c)
    rename = rename or {}
    return df.select(*[F.col(f"`{c}`").alias(rename.get(c, c)) for c in keep])


def find_column(df: DataFrame, contains: str) -> str:
    """P5: first column whose name contains ``contains``."""
    for c in df.columns:
        if contains in c:
            return c
    raise KeyError(f"no column containing {contains!r} in {df.columns}")


def split_available(df: DataFrame, requested: list[str]) -> tuple[list[str], list[str]]:
    """Requested columns present in ``df`` and those missing."""
    have = set(df.columns)
    return [c for c in requested if c in have], [c for c in requested if c not in have]


# ------------------------------------------------------------------ P6 --
def backfill_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add each missing column as a typed NULL (T27: a failed source still
    yields its columns)."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


# --------------------------------------------------------- P10 - P12 --
def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def conditional_overwrite(df: DataFrame, cols: list[str], keep_when: Column,
                          value=0) -> DataFrame:
    """Set ``cols`` to ``value`` where ``keep_when`` is not true (a NULL
    condition overwrites too, matching pandas' mask on ``!=``, T9)."""
    return df.withColumns({c: F.when(keep_when.eqNullSafe(F.lit(True)), F.col(c))
                           .otherwise(F.lit(value).cast(df.schema[c].dataType))
                           for c in cols})


def derived_sum(df: DataFrame, out: str, *cols: str) -> DataFrame:
    """Row-wise sum, NULL if any input is NULL (pandas ``a + b``)."""
    e = F.col(cols[0])
    for c in cols[1:]:
        e = e + F.col(c)
    return df.withColumn(out, e)


# ------------------------------------------------------------------ P16 --
def category_levels(df: DataFrame, col: str) -> list[str]:
    """Levels of a categorical column, alphabetical. Fitted with
    ``StringIndexer`` (one aggregate; only the level list reaches the
    driver)."""
    from pyspark.ml.feature import StringIndexer
    model = StringIndexer(inputCol=col, outputCol="_idx", stringOrderType="alphabetAsc",
                          handleInvalid="skip").fit(df.select(col).filter(F.col(col).isNotNull()))
    return list(model.labels)


def one_hot(df: DataFrame, col: str, prefix: str | None = None, drop_first: bool = True,
            levels: list[str] | None = None) -> DataFrame:
    """``get_dummies(drop_first=True)``: one BOOLEAN column ``<prefix>_<level>``
    per level in alphabetical order, the alphabetically first level left out
    (T25); a missing value is False everywhere."""
    prefix = prefix or col
    lv = sorted(levels) if levels is not None else category_levels(df, col)
    kept = lv[1:] if drop_first else lv
    return df.withColumns({f"{prefix}_{v}": F.coalesce(F.col(col) == F.lit(v), F.lit(False))
                           for v in kept})


def one_hot_sparse(df: DataFrame, col: str, out: str = "onehot") -> tuple[DataFrame, DataFrame]:
    """P16 for any number of levels: ``df`` with one sparse vector column, and
    the level table (level, position). The schema does not grow and no level
    list reaches the driver: levels are numbered by a sort and joined back.
    The alphabetically first level is the reference level (all zeros), as a
    missing value is (T25); ``position`` is the place in the vector, null for
    the reference level."""
    levels = df.select(F.col(col).alias("level")).filter("level IS NOT NULL").distinct()
    placed = cut_lineage(numbered(levels.orderBy("level"), "_n").select(
        "level", (F.col("_n") - 2).cast("int").alias("_p")))
    n = placed.count()
    # The encoder drops its last category: the reference level and nulls.
    last = float(max(n - 1, 1))
    at = F.when(F.col("_p") >= 0, F.col("_p").cast("double")).otherwise(F.lit(last))
    places = placed.withColumnRenamed("level", "_level")
    joined = df.join(broadcast_if_small(places), F.col(col) == F.col("_level"), "left").drop("_level") \
        .withColumn("_at", at).drop("_p")
    one = df.sparkSession.createDataFrame([(last,)], "_at double")
    encoder = OneHotEncoder(inputCol="_at", outputCol=out, dropLast=True).fit(one)
    return encoder.transform(joined).drop("_at"), placed.select(
        "level", F.when(F.col("_p") >= 0, F.col("_p")).alias("position"))
