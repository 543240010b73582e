"""SimHash near-duplicates by pigeonhole blocks.

A 64-bit fingerprint is split into five blocks.  Two fingerprints that differ
in at most two bits agree in at least three blocks, so every close pair meets
in one of the ten joins on three blocks (about 38 bits, which keeps chance
meetings rare), and the Hamming distance is then verified.  Copies never meet
at all: the joins run on distinct fingerprints.

A bucket of more than ``HOT`` fingerprints is not paired.  Its members are
linked exactly in another way: two fingerprints are within two bits if and
only if their radius-1 balls share a point, so each member is keyed by itself
and its 64 one-bit neighbours, and the (at most 65) members under one key are
linked to the smallest.  That is linear in the bucket and loses no component.

Defined cases: null or blank texts have fingerprint 0 and link like any
other; texts of fewer words than the shingle are one shingle; a null doc_id
is ignored as a component's smallest id (null if it has no other).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, cut_narrow, rows_of
from .components import components

BLOCKS = (13, 13, 13, 13, 12)
HOT = 64


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(shared: int = 3) -> list[int]:
    """Masks that keep ``shared`` of the blocks."""
    parts, low = [], 0
    for width in BLOCKS:
        parts.append(((1 << width) - 1) << low)
        low += width
    return [_signed(sum(c)) for c in combinations(parts, shared)]


def fingerprint(text: bytes, shingle: int = 3, chunk: int = 1 << 16) -> int:
    """64-bit SimHash of the A-Z-lower-cased words between ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if n == 1:
        return digest(join(words), 42)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, chunk):
        part = [words[at + k:min(at + chunk, n) + k] for k in range(shingle)]
        h = np.fromiter((digest(join(w), 42) for w in zip(*part)), np.uint64, len(part[0]))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(((2 * counts > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, th, fp): the fingerprint of every whole text; ``th`` is the
    hash of the row, which tells rows with one doc_id apart."""
    schema = "doc_id long, th long, fp long"
    out = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.zeros(b.num_rows, np.uint64)
            text = b.column(2).cast(pa.binary())
            for at in range(0, b.num_rows, 256):
                for k, t in enumerate(text.slice(at, 256).to_pylist(), at):
                    fps[k] = fingerprint(t, shingle)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps.view(np.int64))], schema=out)

    rows = rows_of(docs).select(F.col("_row.doc_id").cast("long").alias("doc_id"),
                                row_hash(F.col("_row")).alias("th"),
                                F.coalesce("_row.text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


def row_hash(row: Column) -> Column:
    return F.xxhash64(row)


def links(fps: DataFrame, max_bits: int = 2, hot: int = HOT,
          most_rows: int | None = None) -> DataFrame:
    """Distinct fingerprints (fp; at most ``most_rows``, if known) -> edges
    (a, b) that connect exactly what lies within ``max_bits`` (at most 2) of
    each other."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the blocks are laid out for at most two differing bits")
    keyed = fps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks()])).alias("mask", "key"))
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(sizes, ["mask", "key"])
    met = cut(met) if most_rows is None else cut_narrow(met, 10 * most_rows)
    few = met.filter(F.col("n") <= hot)
    a = few.select("mask", "key", F.col("fp").alias("a"))
    b = few.select("mask", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = a.join(b, ["mask", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")
    many = met.filter(F.col("n") > hot).select("fp").distinct()
    return pairs.unionByName(ball_links(many, max_bits)).distinct()


def ball_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """The exact way for crowded buckets: link through shared ball points
    (two bits) or through the value with one bit cleared (one bit)."""
    bits = [_signed(1 << i) for i in range(64)]
    if max_bits == 2:
        points = F.transform(F.lit([0, *bits]), lambda m: F.struct(
            F.lit(0).alias("i"), F.col("fp").bitwiseXOR(m).alias("p")))
    else:
        points = F.transform(F.lit(bits if max_bits else [0]), lambda m, i: F.struct(
            i.alias("i"), F.col("fp").bitwiseAND(F.bitwise_not(m)).alias("p")))
    ball = fps.select("fp", F.explode(points).alias("point"))
    groups = ball.groupBy("point").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter(
        "a <> b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, th, fp, root, component_id) for every row of docs; root is the
    smallest fingerprint of the component."""
    d = cut(fingerprints(docs, shingle))
    fps = d.groupBy("fp").agg(F.min("doc_id").alias("low"))
    n = d.count()
    fps = cut_narrow(fps, n)
    comp = components(links(fps.select("fp"), max_bits, most_rows=n), 10 * n)
    group = fps.join(comp, fps.fp == comp.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low")
    low = group.groupBy("root").agg(F.min("low").alias("component_id"))
    names = group.join(low, "root").select("fp", "root", "component_id")
    return d.join(names, "fp")


def classes(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs, shingle, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def dedupe(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each near-duplicate class, with the columns of the input:
    the row with the smallest doc_id (then row hash); of identical rows one."""
    d = near_duplicates(docs, shingle, max_bits)
    # Rows of a class are told apart by (doc_id, th); how often the kept one
    # occurs says whether identical rows must be thinned out.
    same = d.groupBy("root", "doc_id", "th").agg(F.count("*").alias("n"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "th")
    best = cut_narrow(same.groupBy("root").agg(
        F.min_by(F.struct("doc_id", "th", "n"), first).alias("k")).select(
        F.col("k.doc_id").alias("_kept"), F.col("k.th").alias("_hash"), "k.n"), d.count())
    rows = rows_of(docs).select("_row", F.col("_row.doc_id").cast("long").alias("_id"),
                                row_hash(F.col("_row")).alias("th"))

    def chosen(which: str) -> DataFrame:
        k = best.filter(which)
        return rows.join(k, (F.col("th") == F.col("_hash")) & F.col("_id").eqNullSafe(F.col("_kept")),
                         "left_semi").select("_row.*")
    once = chosen("n = 1")
    if best.filter("n > 1").isEmpty():
        return once
    return once.unionByName(chosen("n > 1").distinct())
