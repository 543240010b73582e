"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target number of words; the ratio of target to size is
split into whole copies, which every document gets, and a fraction, which is
the inclusion probability of one more copy.  The cube method (Deville and
Tille, 2004) rounds those probabilities to 0 or 1 so that the words and the
documents of each source stay balanced: among three documents it moves the
probabilities along the null space of the two constraints until one of them is
0 or 1.  The flight runs in blocks of a source; the few documents that a
block leaves over go on to the next level, in blocks again, until one block
a source is left; its last ``LANDING`` documents are the landing problem, and
of all their roundings the best balanced one is taken.

A block is chosen by a hash of the row and worked in order of the row's keys
with a seeded generator, so reruns agree whatever the partitions.  Identical
rows are counted first and split by number, so a key that repeats fills no
block.

Defined cases: a null text has size 0; a null source is a source of its own,
the last; sources without words have target 0; a null doc_id is carried; an
empty table gives no rows; each of repeated rows gets its own decision.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_checked, cut, cut_narrow, rows_of
from .quality import words

WEIGHTS = (1.0, 2.0, 3.0)
MAX_TIMES = 3.0
BLOCK = 4096
# Units that the last step of a source rounds at once.
LANDING = 14
# Documents above this share of a last block's words are rounded first.
LARGE = 0.02
CHUNK = 1024
SEED = 20240
EPS = 1e-9

UNIT = "doc_id long, source string, size long, th long, c long, i long, whole long, pi double"
UNIT_NAMES = [c.split(" ")[0] for c in UNIT.split(", ")]


def totals(units: DataFrame) -> DataFrame:
    """units (source, size, m identical rows) -> one row per source:
    source, source_size, n_docs."""
    return units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                       F.sum("m").alias("n_docs"))


def targets(sources: DataFrame, weights=WEIGHTS, max_times: float = MAX_TIMES) -> DataFrame:
    """source, source_size, n_docs -> the same with ``target``.

    Targets share the sum of sizes by weight, weights repeating over the
    sources in code point order, null last; none is above ``max_times`` its
    source's size and the excess is shared again.  The fixed point is one
    level per unit of weight: sources by rising cap per weight are capped
    until the level that the others reach lies below the next cap.  One row per
    source is all these windows see."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.lit(list(weights)), ((F.row_number().over(order) - 1) % len(weights) + 1)
                     .cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", max_times * F.col("source_size"))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(every)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("w").over(after)).withColumn("k", F.row_number().over(by_cap))
    free = F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct("k", "level"))
    s = s.withColumn("line", F.min(free).over(every)["level"])
    return s.select("source", "source_size", "n_docs", F.coalesce(F.least(
        F.col("cap"), F.col("w") * F.col("line")), F.lit(0.0)).alias("target"))


def land_all(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round every entry of a source's last block.  Large documents, which
    small ones cannot make up for one by one, are rounded first; what that
    misses is spread evenly over the probabilities of the others."""
    pi = pi.copy()
    open_ = (pi > EPS) & (pi < 1 - EPS)
    large = open_ & (size > LARGE * size[open_].sum()) if open_.any() else open_
    rest = open_ & ~large
    for part in (large, rest) if rest.any() else (large,):
        before = float(pi[part] @ size[part])
        pi[part] = flight(size[part], pi[part], rng, LANDING - 2, land=True)
        if part is large and rest.any() and size[rest].sum():
            missed = before - float(pi[part] @ size[part])
            pi[rest] = np.clip(pi[rest] + missed / size[rest].sum(), 0, 1)
    return np.round(pi)


def flight(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator,
           keep: int = 0, land: bool = False) -> np.ndarray:
    """Round ``pi`` while sums of pi and of pi * size hold.  The last ``keep``
    entries take no part, and of the others at most two stay fractional; with
    ``land`` all these are landed together."""
    pi = pi.copy()
    draws = rng.random(2 * len(pi) + 4)
    used, pool = 0, []

    def move(units: list[int], u: tuple) -> list[int]:
        nonlocal used
        up, down = np.inf, np.inf
        for k, x in zip(units, u):
            if x > 0:
                up, down = min(up, (1 - pi[k]) / x), min(down, pi[k] / x)
            elif x < 0:
                up, down = min(up, -pi[k] / x), min(down, -(1 - pi[k]) / x)
        step = up if draws[used] * (up + down) < down else -down
        used += 1
        rest = []
        for k, x in zip(units, u):
            v = pi[k] + step * x
            pi[k] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v
            if 0 < pi[k] < 1:
                rest.append(k)
        return rest

    open_ = []
    for k in range(len(pi)):
        if EPS < pi[k] < 1 - EPS:
            open_.append(k)
        else:
            pi[k] = round(pi[k])
    for k in open_[:max(len(open_) - keep, 0)]:
        pool.append(k)
        if len(pool) == 3:
            a, b, c = (float(size[j]) for j in pool)
            u = (b - c, c - a, a - b)
            pool = move(pool, u if any(u) else (1.0, -1.0, 0.0))
    if land:
        pool += open_[max(len(open_) - keep, 0):]
        if pool:
            pi[pool] = landing(size[pool], pi[pool])
    return pi


def landing(size: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """Of all 0/1 roundings of at most ``LANDING`` units, the one whose words
    and (with little weight) documents come nearest to the expected ones."""
    q = len(pi)
    picks = (np.arange(1 << q)[:, None] >> np.arange(q)) & 1
    words_off = np.abs(picks @ size - pi @ size)
    docs_off = np.abs(picks.sum(axis=1) - pi.sum())
    return picks[np.argmin(words_off + 0.05 * size.mean() * docs_off)].astype(float)


def _fly(land: bool, level: int, seed: int, keep: int) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        keys = [(k, "ascending") for k in ("doc_id", "th", "c", "i")]
        name = block.column("source")[0].as_py()
        rng = np.random.default_rng([seed, level, block.column("block")[0].as_py(),
                                     *(name or "").encode()])
        # Ordered by key, then shuffled by seed: neighbours must not be alike.
        at = pc.sort_indices(block, keys, null_placement="at_start").to_numpy()
        block = block.take(pa.array(at[rng.permutation(len(at))]))
        size, pi = block.column("size").to_numpy(), block.column("pi").to_numpy()
        pi = land_all(size, pi, rng) if land else flight(size, pi, rng, keep)
        return block.select(UNIT_NAMES[:-1]).append_column("pi", pa.array(pi))
    return run


def decide(units: DataFrame, ratio: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """units (doc_id, source, size, th, m) and per source (source, n_docs, r)
    -> one row per document: doc_id, source, size, th, c, i, copies."""
    # m identical rows: chunks of them are dealt out, then counted off.
    u = units.select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("m") - 1) / CHUNK))).alias("c"))
    whole = F.floor("r").cast("long")
    ratio = broadcast_checked(ratio)
    u = u.join(ratio, u.source.eqNullSafe(ratio.source)).select(
        u.doc_id, u.source, "size", "th", "c", "m", whole.alias("whole"),
        (F.col("r") - F.floor("r")).alias("pi"), F.ceil(F.col("n_docs") / block).alias("n_blocks"))
    blocks = F.pmod(F.xxhash64("doc_id", "th", "c"), F.col("n_blocks"))
    u = u.select("*", blocks.alias("block")).repartition("source", "block")
    one = F.explode(F.sequence(F.lit(0).cast("long"), F.least(
        F.lit(CHUNK), F.col("m") - F.col("c") * CHUNK) - 1))
    u = u.select("doc_id", "source", "size", "th", "c", one.alias("i"), "whole", "pi", "block",
                 "n_blocks")
    # Each block leaves over enough for a good landing, and few enough for
    # every level to be much smaller than the one before.
    keep = min(LANDING, block // 4) - 2
    done, level = [], 0
    while True:
        last = u.agg(F.max("n_blocks")).first()[0]
        land = last is None or last <= 1
        flown = cut(u.drop("n_blocks").groupBy("source", "block").applyInArrow(
            _fly(land, level, seed, keep), UNIT))
        whole_now = (F.col("pi") == 0) | (F.col("pi") == 1)
        done.append(flown.filter(whole_now))
        if land:
            break
        left = cut_narrow(flown.filter(~whole_now), flown.filter(~whole_now).count())
        n = left.groupBy("source").agg(F.ceil(F.count("*") / block).alias("n_blocks"))
        n = broadcast_checked(cut(n.coalesce(1)))
        u = left.join(n, left.source.eqNullSafe(n.source)).drop(n.source)
        u = u.withColumn("block", F.pmod(F.xxhash64("doc_id", "th", "c", "i", F.lit(level)),
                                         F.col("n_blocks")))
        level += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "source", "size", "th", "c", "i",
                      (F.col("whole") + F.col("pi").cast("long")).alias("copies"))


def units_of(docs: DataFrame) -> DataFrame:
    """Distinct rows with their count: doc_id, source, size, th, m."""
    row = F.col("_row")
    rows = rows_of(docs).select(
        row["doc_id"].cast("long").alias("doc_id"), row["source"].alias("source"),
        F.size(words(row["text"])).cast("long").alias("size"), F.xxhash64(row).alias("th"))
    return rows.groupBy("doc_id", "source", "size", "th").agg(F.count("*").alias("m"))


def mix(docs: DataFrame, weights=WEIGHTS, max_times: float = MAX_TIMES,
        block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(decisions, targets): one row per document with its copies, and one
    row per source."""
    units = cut(units_of(docs))
    goal = cut(targets(totals(units), weights, max_times))
    ratio = goal.select("source", "n_docs", F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"),
                                          F.lit(float(max_times)))).otherwise(0.0).alias("r"))
    return decide(units, ratio, block, seed), goal


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    decisions, goal = mix(docs)
    goal = broadcast_checked(goal)
    return decisions.join(goal, decisions.source.eqNullSafe(goal.source)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


COPIES_PER_ROW = 1_000


def apply(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document as often as it is taken."""
    decisions, _ = mix(docs)
    # Identical rows are interchangeable: what counts is their copies in all.
    # Rows are told apart by id and hash: hashes alone collide at 10^10 rows.
    taken = cut_narrow(decisions.groupBy(F.col("doc_id").alias("_taken"), F.col("th").alias("_hash")).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("n")).filter("copies > 0"),
        decisions.count())
    rows = rows_of(docs).select("_row", F.col("_row.doc_id").alias("_id"), F.xxhash64("_row").alias("th"))
    same = (F.col("th") == F.col("_hash")) & F.col("_id").eqNullSafe(F.col("_taken"))

    def copied(r: DataFrame) -> DataFrame:
        return r.select(F.explode(F.array_repeat("_row", F.col("copies").cast("int"))).alias("_row")
                        ).select("_row.*")
    out = copied(rows.join(taken.filter("n = 1"), same))
    if taken.filter("n > 1").isEmpty():
        return out
    again = rows.join(taken.filter("n > 1"), same, "left_semi").distinct()
    # The copies of all such rows together are spread over the tasks in ranges.
    ranges = again.join(taken, same).select("_row", "th", "copies", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES_PER_ROW))).alias("range"))
    some = F.least(F.lit(COPIES_PER_ROW).cast("long"), F.col("copies") - F.col("range") * COPIES_PER_ROW)
    return out.unionByName(ranges.repartition("th", "range").select(
        "_row", F.explode(F.sequence(F.lit(1).cast("long"), some)).alias("i")).select("_row.*"))
