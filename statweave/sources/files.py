"""File sources and sinks (S5-S9): CSV with an explicit schema, Parquet, and
text reports rendered as projections of small report DataFrames.

Sinks write distributed part files; only the small-report sinks coalesce to
one part (their size is bounded by #stats x k lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.numeric import format_2dp
from ..operators.rank import top_bottom_k
from ..specs import MISSING_SENTINEL


def write_csv(df: DataFrame, path: str, sentinel: str | None = None,
              bom: bool = False, single_file: bool = False) -> str:
    """S6/S7. ``sentinel`` renders NULL as e.g. 'N/a' (T4) only here, at the
    sink. ``bom`` prefixes the header with a UTF-8 byte-order mark (only for
    one-part report files, where the header is the first line)."""
    out = df
    if bom:
        first = out.columns[0]
        out = out.withColumnRenamed(first, "﻿" + first)
        single_file = True
    if single_file:
        out = out.coalesce(1)
    w = out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
    if sentinel is not None:
        w = w.option("nullValue", sentinel)
    w.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             sentinel: str | None = MISSING_SENTINEL) -> DataFrame:
    """Header CSV with an explicit schema (no inference); the sentinel
    string reads back as NULL."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema)
    if sentinel is not None:
        r = r.option("nullValue", sentinel)
    return r.csv(path)


# ---- S5: type inference -------------------------------------------------------
# Text forms of each type, from narrow to wide; a column has the first type
# whose form all its values have. A long is also a double.
TYPE_PATTERNS = {
    "long": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}


def infer_types(texts: DataFrame) -> DataFrame:
    """(column, n_values, n_long, n_double, n_date, type) of a frame of string
    columns: one aggregate over all rows, no sampling. ``type`` is null (no
    value), long, double, date or string."""
    def count(c: str, kind: str):
        hit = F.col(f"`{c}`").rlike(TYPE_PATTERNS[kind])
        if kind == "date":
            hit = hit & F.expr(f"try_cast(`{c}` AS DATE)").isNotNull()
        return F.count_if(hit).alias(f"n_{kind}")

    counts = texts.agg(*[
        F.struct(F.lit(c).alias("column"), F.count(f"`{c}`").alias("n_values"),
                 *[count(c, kind) for kind in TYPE_PATTERNS]).alias(f"_{i}")
        for i, c in enumerate(texts.columns)])
    rows = counts.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(texts.columns))])).alias("r")) \
        .select("r.*")
    kind = F.when(F.col("n_values") == 0, F.lit("null"))
    for t in TYPE_PATTERNS:
        kind = kind.when(F.col(f"n_{t}") == F.col("n_values"), F.lit(t))
    return rows.withColumn("type", kind.otherwise(F.lit("string")))


def read_csv_inferred(spark: SparkSession, path: str,
                      sentinel: str | None = MISSING_SENTINEL) -> DataFrame:
    """S5 with inference: one pass over the file as text finds every column's
    type over all rows, a second one reads it typed. A column without any
    value is read as string."""
    reader = spark.read.option("header", True)
    if sentinel is not None:
        reader = reader.option("nullValue", sentinel)
    texts = reader.csv(path)
    names = {"long": "bigint", "double": "double", "date": "date"}
    types = {r.column: names.get(r.type, "string") for r in infer_types(texts).collect()}  # one row a column
    return read_csv(spark, path, ", ".join(f"`{c}` {types[c]}" for c in texts.columns), sentinel)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


# ------------------------------------------------------------- S8 / S9 --
def top_k_report(long: DataFrame, stat_list: DataFrame, k: int = 3,
                 min_values: int = 3, name: str = "c_name",
                 ties: tuple[str, ...] = ("c_name", "c_custkey")) -> DataFrame:
    """Top/bottom k per stat plus an 'insufficient_data' pair of rows for
    stats with fewer than ``min_values`` values (F8). Numbers stay numbers;
    text is produced by ``render_top_k_lines`` at the sink."""
    counts = (stat_list.select("stat")
              .join(long.groupBy("stat").agg(F.count("value").alias("n")), "stat", "left")
              .select("stat", F.coalesce("n", F.lit(0)).alias("n")))
    short = (counts.filter(F.col("n") < min_values)
             .select("stat", F.explode(F.array(F.lit("highest"), F.lit("lowest"))).alias("direction"))
             .select("stat", "direction", F.lit(None).cast("int").alias("rank"),
                     F.lit(None).cast("string").alias("entity"),
                     F.lit(None).cast("double").alias("value"),
                     F.lit("insufficient_data").alias("status")))
    ok = top_bottom_k(long, k, ["stat"], "value", list(ties), min_values=min_values)
    ok = ok.select("stat", "direction", F.col("rank").cast("int").alias("rank"),
                   F.col(name).alias("entity"), "value",
                   F.lit("ok").alias("status"))
    return ok.unionByName(short)


def render_top_k_lines(report: DataFrame, stat_order: DataFrame) -> DataFrame:
    """(pos, direction, rank, line) text lines of the top-k report: a heading
    per stat and direction (rank 0), then '<entity>: <value %.2f>'. One pass:
    each report row expands to its own lines."""
    head = F.concat(F.lit("Top 3 "), F.col("direction"), F.lit(" for "), F.col("stat"),
                    F.when(F.col("status") == "ok", F.lit(":"))
                     .otherwise(F.lit(": Insufficient data")))
    body = F.concat(F.col("entity"), F.lit(": "), format_2dp(F.col("value")))
    head_s = F.struct(F.lit(0).alias("rank"), head.alias("line"))
    body_s = F.struct(F.col("rank").alias("rank"), body.alias("line"))
    lines = (F.when(F.col("rank").isNull(), F.array(head_s))
              .when(F.col("rank") == 1, F.array(head_s, body_s))
              .otherwise(F.array(body_s)))
    j = report.join(stat_order, "stat")
    return j.select("pos", "direction", F.explode(lines).alias("l")) \
            .select("pos", "direction", "l.rank", "l.line")


def write_text_lines(lines: DataFrame, path: str, order: list[str]) -> str:
    """One-part text file, lines in ``order`` (a bounded report)."""
    lines.orderBy(*order).select("line").coalesce(1).write.mode("overwrite").text(path)
    return path


def write_markdown_report(row: DataFrame, path: str, title: str) -> str:
    """A one-row frame as a Markdown table of (measure, value) under a
    heading, one file in line order. Doubles have two decimals, missing
    values the sentinel."""
    measures = [F.struct(F.lit(i + 4).alias("no"), F.concat(
        F.lit(f"| {f.name} | "),
        format_2dp(F.col(f.name)) if f.dataType.typeName() == "double"
        else F.coalesce(F.col(f.name).cast("string"), F.lit(MISSING_SENTINEL)),
        F.lit(" |")).alias("value")) for i, f in enumerate(row.schema.fields)]
    head = [F.struct(F.lit(i).alias("no"), F.lit(x).alias("value"))
            for i, x in enumerate([f"# {title}", "", "| measure | value |", "| --- | --- |"])]
    lines = row.select(F.explode(F.array(*head, *measures)).alias("l")).select("l.*")
    lines.coalesce(1).sortWithinPartitions("no").select("value").write.mode("overwrite").text(path)
    return path
