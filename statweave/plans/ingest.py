"""Stage-1 analogue: statistics tables from stored pages -> one typed row per
entity (S1-S4, S11, P1-P10, J1, A1-A5, F2, O1).

Per ``TableSpec``: the pages whose URL holds ``spec.source`` are parsed
(``sources.pages``), the wanted headers pivoted to a wide frame and renamed,
measures coerced to numbers. The tables are then joined at entity grain
(pre-aggregated by default, or the reference's fan-out semantics), missing
measures are back-filled as typed NULLs, the minimum-sample filter and the
first-token sort follow. Failures (pages without a usable table, specs with no
page) come back as a DataFrame, not as an exception.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import coerce_numeric, leading_int
from ..functions.text import first_token
from ..operators import aggregate as agg
from ..operators import joins, schema
from ..session import cut_lineage
from ..sources import pages as pg
from ..specs import MeasureSpec, TableSpec

KEY = "entity_key"


def _table(cells: DataFrame, spec: TableSpec, measures: dict, descriptors: dict, is_base: bool):
    """The wide, typed frame of one spec from its pages' cells."""
    raw = [c for c in spec.columns if spec.rename.get(c, c) != "Player"]
    wide = pg.cells_to_wide(cells, raw, spec.rename)
    typed = {}
    for c in wide.columns:
        if c in measures:
            typed[c] = coerce_numeric(F.col(f"`{c}`"))
        elif c == "Age":
            typed[c] = leading_int(F.col("Age"))
    wide = wide.withColumns(typed).withColumn("Player", F.col("entity_name")) \
               .withColumn("_ord", F.struct("page_id", "row_no"))
    specs = {}
    for c in wide.columns:
        if c in measures:
            specs[c] = (measures[c].agg, c)
        elif is_base and descriptors.get(c) == "first":   # descriptors come from the base table
            specs[c] = ("first", c)
    return wide, specs


def ingest(pages: DataFrame, specs: list[TableSpec], measures: list[MeasureSpec],
           descriptors: dict[str, str], mode: str = "aggregate",
           min_col: str | None = None, min_above: float | None = None):
    """-> (entity rows, failures). ``pages(page_id, url, html)``. A page belongs
    to the first spec whose ``source`` its URL holds. One pass finds the status
    of every page; the cells, many times larger, are taken in a second one and
    go straight into their aggregates, so none is stored."""
    mdict = {m.name: m for m in measures}
    tables = []
    spark = pages.sparkSession
    number = F.lit(None).cast("int")
    for k, spec in reversed(list(enumerate(specs))):
        number = F.when(F.col("url").contains(spec.source), F.lit(k)).otherwise(number)
    ids = F.element_at(F.array(*[F.lit(s.table_id).cast("string") for s in specs]), number + 1)
    tagged = pages.select("page_id", "html", number.alias("spec"), ids.alias("table_id")).filter(
        "spec is not null")
    how = {"unlisted": "mangle", "carry": "spec"}
    states = cut_lineage(pg.page_status(tagged, with_cells=False, **how))
    names = F.array(*[F.lit(s.name) for s in specs])
    statuses = [states.withColumn("table", F.element_at(names, F.col("spec") + 1))
                .drop("spec")]
    keyed = {r["spec"] for r in states.filter("n_keyed_rows > 0").select("spec").distinct().collect()}
    for k, spec in enumerate(specs):
        if k not in keyed:              # a failed source: its columns are back-filled (T27)
            statuses.append(spark.createDataFrame(
                [(None, None, None, 0, 0, "no_rows", f"no keyed rows for {spec.name}", spec.name)],
                pg.STATUS_SCHEMA + ", table string"))
            continue
        cells = pg.extract_cells(tagged.filter(F.col("spec") == k), **how)
        tables.append((spec.name, *_table(cells, spec, mdict, descriptors, not tables)))
    if not tables:
        raise ValueError("no source table delivered rows")
    base_name, base_df, base_specs = tables[0]
    base = joins.Side(base_name, base_df, base_specs, "_ord")
    sides = [joins.Side(n, d, s, "_ord") for n, d, s in tables[1:]]
    out = joins.wide_left_join(base, sides, KEY, mode)
    for col, kind in descriptors.items():
        if kind == "concat" and col in base_df.columns:
            cat = agg.distinct_concat(base_df, KEY, col, "_ord", out=col)
            out = out.join(cat, KEY, "left")
    out = schema.backfill_columns(out, {m.name: "double" for m in measures})
    if min_col is not None and min_above is not None:
        out = out.filter(F.col(f"`{min_col}`") > F.lit(min_above))
    ordered = [KEY, *[c for c in descriptors if c in out.columns], *[m.name for m in measures]]
    out = out.select(*[F.col(f"`{c}`") for c in ordered])
    out = out.orderBy(first_token(F.col("Player")), F.col("Player"), F.col(KEY))
    failures = statuses[0]
    for s in statuses[1:]:
        failures = failures.unionByName(s)
    failures = failures.filter(F.col("status") != "ok")
    return out, failures
