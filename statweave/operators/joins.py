"""Joins (J1-J6, J9).

J1 joins many sources at key grain. The default pre-aggregates every side to
one row per key before joining, so the join never multiplies rows. The
reference's behaviour, a raw N-way join on a non-unique key followed by the
aggregate (T1), is available as ``mode='fanout'``; it is computed exactly
from the same per-key aggregates (sums and counts are scaled by the product
of the other sides' row counts) instead of materialising the product.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trim_ws
from ..session import broadcast_if_small, cut_lineage
from .aggregate import mixed_agg


@dataclass
class Side:
    """One source of a wide join: its rows, the aggregate per output column
    ``{out: (kind, column)}`` and the column giving its row order."""
    name: str
    df: DataFrame
    specs: dict
    order_col: str | None = None


@dataclass
class SplitSource:
    """Several sides that are slices of one source (rows where ``split_col``
    equals each value). They are reduced in a single pass with conditional
    aggregates (one scan, one shuffle) instead of one filtered scan each.
    ``parts`` maps side name -> (value, specs)."""
    df: DataFrame
    split_col: str
    parts: dict
    order_col: str | None = None

    def sides(self) -> list[Side]:
        return [Side(n, self.df, specs, self.order_col) for n, (_, specs) in self.parts.items()]

    def reduce(self, key: str) -> DataFrame:
        cols, specs = {}, {}
        for name, (value, sp) in self.parts.items():
            cond = F.col(self.split_col) == F.lit(value)
            cols[f"_one_{name}"] = F.when(cond, F.lit(1))
            specs[f"_n_{name}"] = ("count", f"_one_{name}")
            for out, (kind, col) in sp.items():
                cols[f"_c_{out}"] = F.when(cond, F.col(col))
                specs[out] = (kind, f"_c_{out}")
        return mixed_agg(self.df.withColumns(cols), key, specs, self.order_col)


def wide_left_join(base: Side, sides: list, key: str, mode: str = "aggregate") -> DataFrame:
    """Left-join ``sides`` to ``base`` on ``key``; one output row per base key.

    ``mode='aggregate'``: each table is reduced to key grain (partial+final
    hash aggregate) and the reduced tables are joined; the joins are then
    one-row-per-key on both sides and co-partitioned on ``key``.
    ``mode='fanout'``: results equal aggregating the raw left-join product."""
    if mode not in ("aggregate", "fanout"):
        raise ValueError(mode)
    tables, reduced = [base], []
    for t in [base, *sides]:
        if isinstance(t, SplitSource):
            tables.extend(t.sides())
            reduced.append(t.reduce(key))
            continue
        if t is not base:
            tables.append(t)
        specs = dict(t.specs)
        specs[f"_n_{t.name}"] = ("count", "_one")
        df = t.df.withColumn("_one", F.lit(1))
        reduced.append(mixed_agg(df, key, specs, t.order_col))
    j = reduced[0]
    for r in reduced[1:]:
        j = j.join(r, on=key, how="left")

    def mult_for(t: Side) -> Column:
        m = F.lit(1).cast("long")
        for u in tables:
            if u.name != t.name:
                m = m * F.greatest(F.coalesce(F.col(f"_n_{u.name}"), F.lit(0)), F.lit(1))
        return m

    cols = [F.col(key)]
    for t in tables:
        for out, (kind, _) in t.specs.items():
            c = F.col(f"`{out}`")
            if kind in ("sum", "count"):
                if t is not base:      # a side with no rows contributes 0 (pandas sum)
                    c = F.coalesce(c, F.lit(0))
                if mode == "fanout":
                    c = c * mult_for(t)
            cols.append(c.alias(out))
    return j.select(*cols)


# ------------------------------------------------------------------ J2 --
def positional_zip(df: DataFrame, left: str, right: str, pos: str = "pos",
                   keep: list[str] | None = None) -> DataFrame:
    """Pair two array columns element by element (``arrays_zip`` +
    ``posexplode``) and flag rows whose arrays differ in length (the
    reference raises; here the mismatch is data)."""
    keep = keep or []
    z = df.select(*keep, F.posexplode(F.arrays_zip(F.col(left).alias(left),
                                                   F.col(right).alias(right))).alias(pos, "_z"),
                  (F.size(left) == F.size(right)).alias("lengths_match"))
    return z.select(*keep, pos, F.col(f"_z.{left}").alias(left), F.col(f"_z.{right}").alias(right),
                    "lengths_match")


# ----------------------------------------------------------- J3 / J5 / J9 --
def semi_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on=on, how="left_semi")


def anti_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on=on, how="left_anti")


def lookup_join(df: DataFrame, lookup: DataFrame, on) -> DataFrame:
    """Map lookup with unmatched rows dropped = inner join (J5). Spark/AQE
    broadcasts the lookup when its measured size is under the threshold."""
    return df.join(lookup, on=on, how="inner")


# ------------------------------------------------------------------ J6 --
def first_contained(text: Column, candidates: list[str]) -> Column:
    """The first candidate (list order = priority) that is a substring of the
    trimmed text; the trimmed text itself when none is (J6, T13). For a
    fixed, code-sized list this is one expression, no join."""
    t = trim_ws(text)
    hit = F.coalesce(*[F.when(t.contains(F.lit(c)), F.lit(c)) for c in candidates]) \
        if candidates else F.lit(None).cast("string")
    return F.coalesce(hit, t)


GRAM = 4


def _grams(text: Column, n: int) -> Column:
    """Distinct substrings of ``n`` characters: a look-ahead matches at every
    place without using any of it up. (Where a place lies inside a character
    of two code units, one more string comes out, alike in texts and names.)"""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def contained_names(df: DataFrame, text: str, names: DataFrame, key: list[str]) -> DataFrame:
    """All (key, priority, name) with ``name`` a substring of ``text``; ``key``
    identifies the rows of ``df``.

    Texts and names are cut at spaces. Where a name of three words or more
    stands, each word but its first and last is a whole word of the text: an
    equi-join on the one that is rarest in all texts meets every such pair. Of
    a shorter name the longest word lies inside a word of the text; those
    words are looked up among the distinct words of all texts
    (``_names_by_grams``), far fewer characters than the texts have.
    ``contains`` then checks the pairs that were met. Empty names are in every
    text; a null name or text matches nothing."""
    t = df.select(*key, F.col(text).alias("_t")).filter(F.col("_t").isNotNull())
    names = names.select("priority", "name").filter(F.col("name").isNotNull())
    words = names.filter("name <> ''").withColumn("_w", F.split("name", " "))
    short = words.filter(F.size("_w") < 3).select("priority", "name", F.array_max(F.transform(
        "_w", lambda w: F.struct(F.length(w), w.alias("w")))).getField("w").alias("_part"))
    inner = words.filter(F.size("_w") >= 3).select("priority", "name", F.explode(F.array_distinct(
        F.slice("_w", 2, F.size("_w") - 2))).alias("_g"))
    found = cut_lineage(t.select(F.explode(F.split("_t", " ")).alias("_g"))
                        .groupBy("_g").agg(F.count(F.lit(1)).alias("_n")))
    # A name with a word that no text has is in no text.
    rare = (inner.join(found, "_g", "left").groupBy("priority", "name")
            .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("_a"))
            .filter("_a.n > 0").select("priority", "name", F.col("_a._g").alias("_g")))
    parts = short.select("_part").distinct().select(F.lit(0).alias("priority"), F.col("_part").alias("name"))
    inside = _names_by_grams(found.select(F.col("_g").alias("_word")), "_word", parts, ["_word"]).select(
        F.col("_word").alias("_g"), F.col("name").alias("_part"))
    rare = cut_lineage(rare.unionByName(short.distinct().join(inside, "_part").drop("_part")))
    anchors = broadcast_if_small(rare)
    in_text = t.withColumn("_row", F.monotonically_increasing_id()).select(
        "_row", *key, "_t", F.explode(F.array_distinct(F.split("_t", " "))).alias("_g"))
    once = ["_row", "priority", "name"]  # several words of a text may hold a short name
    if anchors is rare:  # shuffled by word: the texts stay where they are until then
        met = in_text.drop("_t").join(rare, "_g").dropDuplicates(once).select(
            *key, "priority", "name").join(t, key).filter(F.col("_t").contains(F.col("name")))
    else:
        met = in_text.join(anchors, "_g").filter(F.col("_t").contains(F.col("name"))).select(
            "_row", *key, "priority", "name").dropDuplicates(once)
    met = met.select(*key, "priority", "name")
    empty = names.filter("name = ''").agg(F.min("priority")).first()[0]
    if empty is None:
        return met
    return met.unionByName(t.select(*key, F.lit(empty).alias("priority"), F.lit("").alias("name")))


def _names_by_grams(df: DataFrame, text: str, names: DataFrame, key: list[str]) -> DataFrame:
    """``contained_names`` without regard to words.

    A theta join has no key to join on, so every name gets one: of its
    substrings of ``GRAM`` characters the one that fewest texts have. A text
    that contains the name has that substring, so an equi-join on it meets
    every such pair, and ``contains`` then checks the few that it brings.
    Names shorter than ``GRAM`` are equal to a substring of their own length.
    Empty names are in every text; a null name or text matches nothing."""
    t = df.select(*key, F.col(text).alias("_t")).filter(F.col("_t").isNotNull())
    names = names.select("priority", "name").filter(F.col("name").isNotNull())
    sizes = [r[0] for r in names.select(F.least(F.length("name"), F.lit(GRAM)).alias("n"))
             .distinct().collect()]
    out = []
    for n in sorted(sizes):
        if n == 0:
            empty = names.filter(F.col("name") == "").agg(F.min("priority")).first()[0]
            out.append(t.select(*key, F.lit(empty).alias("priority"), F.lit("").alias("name")))
            continue
        grams = t.select(*key, "_t", F.explode(_grams(F.col("_t"), n)).alias("_g"))
        if n < GRAM:
            short = names.filter(F.length("name") == n)
            out.append(grams.join(broadcast_if_small(short), F.col("_g") == F.col("name"))
                       .select(*key, "priority", "name"))
            continue
        long = names.filter(F.length("name") >= n)
        of = cut_lineage(long.withColumn("_g", F.explode(_grams(F.col("name"), n))))
        # Number of texts that have each substring of a name.
        wanted = broadcast_if_small(of.select("_g").distinct())
        found = cut_lineage(t.select(F.explode(_grams(F.col("_t"), n)).alias("_g"))
                            .join(wanted, "_g").groupBy("_g").agg(F.count(F.lit(1)).alias("_texts")))
        # A name with a substring that no text has is in no text.
        rare = cut_lineage(of.join(found, "_g", "left").groupBy("priority", "name")
                .agg(F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("n"), "_g")).alias("_a"))
                .filter("_a.n > 0").select("priority", "name", F.col("_a._g").alias("_g")))
        anchors = broadcast_if_small(rare)
        if anchors is rare:  # shuffled by substring: the texts stay where they are until then
            met = grams.drop("_t").join(rare, "_g").select(*key, "priority", "name").join(t, key)
        else:
            met = grams.join(anchors, "_g")
        out.append(met.filter(F.col("_t").contains(F.col("name"))).select(*key, "priority", "name"))
    if not out:
        return t.select(*key, F.lit(None).cast(names.schema["priority"].dataType).alias("priority"),
                        F.lit(None).cast("string").alias("name")).filter(F.lit(False))
    hits = out[0]
    for o in out[1:]:
        hits = hits.unionByName(o)
    return hits


def first_contained_join(df: DataFrame, text: str, candidates: DataFrame,
                         key: list[str], out: str = "match") -> DataFrame:
    """J6 for a candidate table (priority, name) of any size: the name of
    lowest priority number that the trimmed text contains, else the trimmed
    text itself. ``key`` identifies the rows of ``df``."""
    t = df.select(*key, trim_ws(F.col(text)).alias("_t"))
    best = contained_names(t, "_t", candidates, key).groupBy(*key).agg(
        F.min_by("name", "priority").alias("_hit"))
    return (t.join(best, on=key, how="left")
             .select(*key, F.coalesce("_hit", "_t").alias(out)))
