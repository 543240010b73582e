"""Fuzzy similarity join, one-to-one assignment, near misses.

Similarity join (J7). A pair can reach ``score >= theta`` only if
``400 * LCS > (2*theta - 1) * (la + lb)`` (half-even rounding of the ratio).
Lossless filters follow:

* length: ``400 * min(la, lb) > (2*theta - 1) * (la + lb)``;
* token overlap: an LCS of length ``l`` shares at least ``l`` characters and,
  with padded bigrams, at least ``l + 1 - d`` bigrams (``d = la + lb - 2l``
  indels, each breaking at most one bigram of the LCS in either string);
* position: with tokens in a global order, rarest first, the first token that
  two strings share leaves at most the tokens after it to share. If the
  overlap must be ``tau``, that token stands at least ``tau`` from either end;
* parts: tokens fall into ``PARTS`` classes by hash. Two strings share at most
  the smaller of their counts in each class.

So strings meet by an equi-join on tokens, the length, position and part bounds
are conditions of that join, and frequent tokens (the skewed keys) rarely get
that far; those that do are dealt over several tasks. Bigrams are used for
``theta >= 68`` (their bound stays positive), characters below. Survivors are
scored exactly (``functions.similarity``).

On prose these bounds rule out next to nothing, and each pair meets at most of
its tokens. ``block_join`` and ``block_nearest`` therefore pair blocks of
strings of fitting length and score one string against a whole block at once
(``PackedTexts``): exact, a few microseconds a pair, blocks of bounded size.

Assignment (J8) is serial dictatorship by left priority: a left takes its best
remaining target (score desc, target order). Components of the edge graph are
independent, so those of bounded size are solved in one pass, many to a task.
A component beyond the bound first commits every edge where the left's best
target has that left as its lowest-priority-number neighbour (the globally first
left among them), and is taken apart into components again.

Near misses (J10) take candidates by falling upper bound and stop where the
third score beats the next bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import PackedTexts, lcs_bits, position_masks, ratio
from ..functions.text import let
from ..session import broadcast_if_small, cut_lineage
from .components import connected_components

BIGRAM_MIN_THETA = 68
PAD_START, PAD_END = "\u0002", "\u0003"
PARTS = 32
# Rows of one token that are joined in one piece; more are dealt out.
HOT_TOKEN = 5_000


def _int(theta) -> Column:
    return theta if isinstance(theta, Column) else F.lit(theta)


def _l_min(s: Column, theta) -> Column:
    """Smallest LCS length giving score >= theta for total length s."""
    return (F.floor((_int(theta) * 2 - 1) * s / F.lit(400.0)) + 1).cast("int")


def _tau(s: Column, theta, kind: str) -> Column:
    """Tokens that a pair of total length s must share, at least one."""
    lm = _l_min(s, theta)
    return F.greatest((F.lit(3) * lm + 1 - s) if kind == "bigram" else lm, F.lit(1))


def length_ok(la: Column, lb: Column, theta) -> Column:
    return F.lit(400) * F.least(la, lb) > (_int(theta) * 2 - 1) * (la + lb)


def _shortest_partner(la: Column, theta) -> Column:
    k, m = _int(theta) * 2 - 1, F.lit(401) - _int(theta) * 2
    return (F.floor(la * k / m.cast("double")) + 1).cast("int")


def _tau_floor(la: Column, theta, kind: str) -> Column:
    """A lower bound of ``_tau`` over all partners: both kinds grow with the
    partner's length but for rounding."""
    s = la + _shortest_partner(la, theta)
    if kind == "char":
        return F.greatest(_l_min(s, theta), F.lit(1))
    k = _int(theta) * 2 - 1
    return F.greatest(F.ceil(s * (F.lit(3.0) * k / 400.0 - 1.0) + 1.0 - 1e-6).cast("int"), F.lit(1))


def _grams(text: Column, kind: str) -> Column:
    if kind == "char":
        return F.filter(F.split(text, ""), lambda c: c != F.lit(""))
    padded = F.concat(F.array(F.lit(PAD_START)), F.filter(F.split(text, ""), lambda c: c != F.lit("")),
                      F.array(F.lit(PAD_END)))
    return let(padded, lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p) - 1),
        lambda i: F.concat(F.element_at(p, i), F.element_at(p, i + 1))))


def _part_counts(grams: Column) -> Column:
    """How many grams fall into each hash class."""
    return let(F.transform(grams, lambda g: F.pmod(F.hash(g), F.lit(PARTS))), lambda h: F.transform(
        F.sequence(F.lit(0), F.lit(PARTS - 1)),
        lambda b: F.size(h) - F.size(F.array_remove(h, b))))


def shared_at_most(a: Column, b: Column) -> Column:
    """Upper bound of the grams that two strings share, from their classes."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x)


def _spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: the work on a string or pair is far larger than
    its bytes, by which Spark would pack them into few tasks."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism,
                              int(spark.conf.get("spark.sql.shuffle.partitions"))))


def tokens(df: DataFrame, id_col: str, text: str, kind: str, *more: str) -> DataFrame:
    """(id, len, n_tok, parts, token) with duplicate tokens numbered, so
    multiset overlap is set overlap; ``more`` columns are kept."""
    base = cut_lineage(
        _spread(df).select(F.col(id_col).alias("id"), F.col(text).alias("_t"), *more)
        .withColumn("_g", _grams(F.col("_t"), kind))
        .select("id", F.length("_t").alias("len"), F.size("_g").alias("n_tok"),
                _part_counts(F.col("_g")).alias("parts"), *more, "_g"))
    # Counted by a shuffle, not in the string: a long one has many grams.
    numbers = (base.select("id", F.explode("_g").alias("_x")).groupBy("id", "_x").agg(F.count(F.lit(1)).alias("n"))
               .select("id", "_x", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_i"))
               .select("id", F.concat("_x", F.lit("\u0001"), F.col("_i").cast("string")).alias("token")))
    return base.drop("_g").join(numbers, "id").select("id", "len", "n_tok", "parts", *more, "token")


def _index(toks: DataFrame, freq: DataFrame, theta, kind: str) -> DataFrame:
    """The tokens of each string that can be the first shared one, with their
    place in the global order (rarest first)."""
    w = Window.partitionBy("id").orderBy(F.col("df").asc(), F.col("token").asc())
    placed = toks.join(freq, "token").withColumn("pos", F.row_number().over(w))
    return placed.filter(F.col("n_tok") - F.col("pos") + 1 >= _tau_floor(F.col("len"), theta, kind))


def _meet(left: DataFrame, right: DataFrame, theta, kind: str) -> DataFrame:
    """Distinct (lid, rid) that share a token and pass every bound. A token
    with many right rows is dealt into several pieces, each left row going to
    all of them."""
    pieces = F.ceil(F.col("df") / F.lit(HOT_TOKEN)).cast("int")
    lp = left.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).alias("a")
    rp = right.withColumn("piece", F.pmod(F.xxhash64("id"), pieces).cast("int")).alias("b")
    s = F.col("a.len") + F.col("b.len")
    tau = _tau(s, theta, kind)
    return (lp.join(rp, (F.col("a.token") == F.col("b.token")) & (F.col("a.piece") == F.col("b.piece"))
                    & length_ok(F.col("a.len"), F.col("b.len"), theta)
                    & (F.col("a.n_tok") - F.col("a.pos") + 1 >= tau)
                    & (F.col("b.n_tok") - F.col("b.pos") + 1 >= tau)
                    & (shared_at_most(F.col("a.parts"), F.col("b.parts")) >= tau))
              .select(F.col("a.id").alias("_lid"), F.col("b.id").alias("_rid")))


def _in_reach(df: DataFrame, text: str, other: DataFrame, other_text: str, theta: int) -> DataFrame:
    """Strings whose length some string of ``other`` can match at all."""
    m = other.agg(F.min(F.length(other_text)).alias("lo"), F.max(F.length(other_text)).alias("hi")).first()
    if m["lo"] is None:
        return df.filter(F.lit(False))
    n, k, top = F.length(text), 2 * theta - 1, 401 - 2 * theta
    return df.filter((n * top >= m["lo"] * k) & (n * k <= m["hi"] * top))


def similarity_candidates(left: DataFrame, right: DataFrame, theta: int,
                          lid: str = "lid", ltext: str = "ltext",
                          rid: str = "rid", rtext: str = "rtext",
                          self_join: bool = False) -> DataFrame:
    """(lid, rid) of all pairs that the filters cannot rule out."""
    kind = "bigram" if theta >= BIGRAM_MIN_THETA else "char"
    if not self_join:
        left, right = (_in_reach(left, ltext, right, rtext, theta),
                       _in_reach(right, rtext, left, ltext, theta))
    lt = cut_lineage(tokens(left, lid, ltext, kind))
    rt = lt if self_join else cut_lineage(tokens(right, rid, rtext, kind))
    freq = ((lt if self_join else lt.select("token").unionByName(rt.select("token")))
            .groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    lp = _index(lt, freq, theta, kind)
    rp = lp if self_join else _index(rt, freq, theta, kind)
    pairs = _meet(lp, rp, theta, kind)
    if self_join:
        pairs = pairs.filter(F.col("_lid") < F.col("_rid"))
    return pairs.distinct().select(F.col("_lid").alias(lid), F.col("_rid").alias(rid))


def _scored(pairs: DataFrame, left: DataFrame, right: DataFrame, lid: str = "lid",
            ltext: str = "ltext", rid: str = "rid", rtext: str = "rtext") -> DataFrame:
    """``pairs`` with both texts and the exact score; position masks are made
    once a string, and those of the shorter one are used."""
    ltxt = left.select(F.col(lid), F.col(ltext), position_masks(F.col(ltext)).alias("_lm"))
    rtxt = right.select(F.col(rid), F.col(rtext), position_masks(F.col(rtext)).alias("_rm"))
    la, lb = F.length(ltext), F.length(rtext)
    score = ratio(F.col(ltext), F.col(rtext),
                  F.when(la <= lb, lcs_bits(F.col("_lm"), la, F.col(rtext)))
                  .otherwise(lcs_bits(F.col("_rm"), lb, F.col(ltext))))
    return (_spread(pairs.join(ltxt, lid).join(rtxt, rid)).withColumn("score", score).drop("_lm", "_rm"))


def similarity_join(left: DataFrame, right: DataFrame, theta: int,
                    lid: str = "lid", ltext: str = "ltext",
                    rid: str = "rid", rtext: str = "rtext",
                    self_join: bool = False) -> DataFrame:
    """All pairs with ``ratio(ltext, rtext) >= theta`` -> (lid, rid, ltext,
    rtext, score). ``self_join``: left is right, pairs with lid < rid."""
    pairs = similarity_candidates(left, right, theta, lid, ltext, rid, rtext, self_join)
    if self_join:
        right = left.select(F.col(lid).alias(rid), F.col(ltext).alias(rtext))
    return (_scored(pairs, left, right, lid, ltext, rid, rtext)
            .filter(F.col("score") >= theta).select(lid, rid, ltext, rtext, "score"))


# Strings of a block, and pairs of blocks that a task scores.
BLOCK, TASK_BLOCKS = 128, 64


def _blocks(df: DataFrame, side: str, by_length: bool, *more: str) -> tuple[DataFrame, int]:
    """The strings of one side in blocks of about ``BLOCK``, each of like
    length if ``by_length`` -> (piece, rows, shortest, longest), pieces."""
    n = F.length(f"{side}text")
    size = F.floor(F.log2(n + 1) * 2) if by_length else F.lit(0)
    pieces = max(1, -(-df.count() // BLOCK))
    return cut_lineage(
        df.select(F.struct(f"{side}id", f"{side}text", *more).alias("_row"), n.alias("_n"),
                  size.alias("_size"), F.pmod(F.xxhash64(f"{side}id"), F.lit(pieces)).alias(f"{side}piece"))
        .groupBy("_size", f"{side}piece").agg(F.collect_list("_row").alias(f"{side}rows"),
                                              F.min("_n").alias(f"{side}lo"), F.max("_n").alias(f"{side}hi"))
        .drop("_size")), pieces


def _block_pairs(left: DataFrame, right: DataFrame, theta: int | None, *more: str) -> DataFrame:
    """(lrows, rrows): blocks of both sides, with ``theta`` only those whose
    lengths come near enough somewhere. A left block looks up every piece of
    the right side by its number."""
    (lb, _), (rb, pieces) = _blocks(left, "l", theta is not None), _blocks(right, "r", theta is not None, *more)
    pairs = lb.count() * rb.count()
    tasks = max(left.sparkSession.sparkContext.defaultParallelism, -(-pairs // TASK_BLOCKS))
    la = F.least("lhi", F.greatest("llo", "rlo"))
    near = F.lit(True) if theta is None else length_ok(la, F.least("rhi", F.greatest("rlo", la)), theta)
    lb = lb.repartition(tasks).withColumn("_at", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))))
    return lb.join(broadcast_if_small(rb), (F.col("_at") == F.col("rpiece")) & near).select("lrows", "rrows")


def _packed(batches: Iterator[pa.RecordBatch]):
    """Per pair of blocks: left rows, right rows and the packed right texts."""
    for b in batches:
        last, packed = None, None
        for at in range(b.num_rows):
            lefts, rights = b.column(0)[at].as_py(), b.column(1)[at].as_py()
            texts = [r["rtext"] for r in rights]
            if texts != last:
                last, packed = texts, PackedTexts(texts)
            yield lefts, rights, packed


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)],
                                      schema=schema)


def block_join(left: DataFrame, right: DataFrame, theta: int) -> DataFrame:
    """The pairs of ``similarity_join`` of left(lid, ltext) and
    right(rid, rtext), string ids, by blocks -> (lid, rid, ltext, rtext, score)."""
    names = ["lid", "rid", "ltext", "rtext"]
    schema = pa.schema([*((c, pa.string()) for c in names), ("score", pa.int32())])

    def score(batches):
        for lefts, rights, packed in _packed(batches):
            rows = []
            for x in lefts:
                n = len(x["ltext"])
                fits = 400 * np.minimum(packed.lengths, n) > (2 * theta - 1) * (packed.lengths + n)
                if fits.any():
                    got = packed.ratio(x["ltext"])
                    rows += [(x["lid"], rights[j]["rid"], x["ltext"], rights[j]["rtext"], int(got[j]))
                             for j in np.flatnonzero(fits & (got >= theta))]
            yield _rows(rows, schema)

    pairs = _block_pairs(left.filter("ltext is not null").select("lid", "ltext"),
                         right.filter("rtext is not null").select("rid", "rtext"), theta)
    return pairs.mapInArrow(score, "lid string, rid string, ltext string, rtext string, score int")


def block_nearest(left: DataFrame, right: DataFrame, k: int = 3) -> DataFrame:
    """``near_misses`` by blocks: all pairs are scored, and a task keeps the
    best ``k`` of a left in each block.

    left(lid, ltext), right(rid, rtext, rorder) -> (lid, rid, score, rank)."""
    schema = pa.schema([("lid", pa.string()), ("rid", pa.string()), ("score", pa.int32()),
                        ("rorder", pa.int64())])

    def score(batches):
        for lefts, rights, packed in _packed(batches):
            tie = np.empty(len(rights), np.int64)
            tie[sorted(range(len(rights)), key=lambda j: (rights[j]["rorder"], rights[j]["rid"]))] = \
                np.arange(len(rights))
            rows = []
            for x in lefts:
                got = packed.ratio(x["ltext"])
                rows += [(x["lid"], rights[j]["rid"], int(got[j]), rights[j]["rorder"])
                         for j in np.lexsort((tie, -got))[:k]]
            yield _rows(rows, schema)

    pairs = _block_pairs(left.select("lid", "ltext"),
                         right.select("rid", "rtext", F.col("rorder").cast("long").alias("rorder")), None, "rorder")
    scored = pairs.mapInArrow(score, "lid string, rid string, score int, rorder long")
    return _ranked(scored, k).select("lid", "rid", "score", F.col("rank").cast("int").alias("rank"))


# ------------------------------------------------------------------ J8 --
# Edges that one task solves in memory.
TASK_EDGES = 5_000_000


def _solve(edges: DataFrame, bucket: Column, rnd: int) -> DataFrame:
    """The serial choice within each bucket of whole components."""
    kept = edges.select("lid", "rid", "score", "lprio", "rorder", bucket.alias("_bucket"))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:3]),
                        "round int"])

    def choose(groups: Iterator[pa.Table]) -> pa.Table:
        t = groups.sort_by([("lprio", "ascending"), ("lid", "ascending"), ("score", "descending"),
                            ("rorder", "ascending"), ("rid", "ascending")])
        left, right = (t[c].combine_chunks().dictionary_encode().indices.to_pylist() for c in ("lid", "rid"))
        taken, rows, done = set(), [], None
        for i, (a, b) in enumerate(zip(left, right)):
            if a != done and b not in taken:
                taken.add(b)
                rows.append(i)
                done = a
        out = t.take(pa.array(rows, pa.int64())).select(["lid", "rid", "score"])
        return out.append_column("round", pa.array([rnd] * len(rows), pa.int32()))

    return kept.groupBy("_bucket").applyInArrow(choose, schema)


def _dominant(edges: DataFrame, rnd: int) -> DataFrame:
    """Edges whose left is at once its best target's first chooser."""
    best = edges.groupBy("lid").agg(F.min_by(
        F.struct("rid", "score", "lprio"),
        F.struct((-F.col("score")).alias("ns"), F.col("rorder"))).alias("b")) \
        .select("lid", "b.rid", "b.score", "b.lprio")
    # a target's first chooser: lowest priority number, then left id
    first = edges.groupBy("rid").agg(F.min(F.struct("lprio", "lid")).alias("_mp"))
    return (best.join(first, "rid")
                .filter((F.col("lprio") == F.col("_mp.lprio")) & (F.col("lid") == F.col("_mp.lid")))
                .select("lid", "rid", "score", F.lit(rnd).alias("round")))


def assign_one_to_one(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """Serial dictatorship over ``edges(lid, rid, score, lprio, rorder)``:
    returns (lid, rid, score, round). Lower ``lprio`` chooses first; a
    left prefers higher score, then lower ``rorder``. ``round`` numbers the
    pass that settled a pair; components of at most ``task_edges`` edges need
    one pass."""
    remaining = cut_lineage(edges.select("lid", "rid", "score", "lprio", "rorder"))
    settled, rnd = [], 0
    while (n := remaining.count()):
        if n <= task_edges:
            settled.append(cut_lineage(_solve(remaining, F.lit(0), rnd)))
            break
        ends = remaining.select(F.struct(F.lit("l").alias("side"), F.col("lid").cast("string").alias("id")).alias("u"),
                                F.struct(F.lit("r").alias("side"), F.col("rid").cast("string").alias("id")).alias("v"))
        component = connected_components(ends).filter("node.side = 'l'").select(
            F.col("node.id").alias("_id"), "component")
        whole = remaining.join(component, F.col("lid").cast("string") == F.col("_id")).drop("_id")
        sizes = whole.groupBy("component").agg(F.count(F.lit(1)).alias("_edges"))
        whole = cut_lineage(whole.join(sizes, "component"))
        small = whole.filter(F.col("_edges") <= task_edges)
        tasks = max(1, -(-2 * small.count() // task_edges))
        settled.append(cut_lineage(_solve(
            small, F.pmod(F.xxhash64("component"), F.lit(tasks)), rnd)))
        remaining = whole.filter(F.col("_edges") > task_edges).select(
            "lid", "rid", "score", "lprio", "rorder")
        commit = cut_lineage(_dominant(remaining, rnd))
        settled.append(commit)
        remaining = cut_lineage(
            remaining.join(commit.select("lid"), "lid", "left_anti")
                     .join(commit.select("rid"), "rid", "left_anti"))
        rnd += 1
    if not settled:
        return edges.select("lid", "rid", "score", F.lit(0).alias("round"))
    out = settled[0]
    for c in settled[1:]:
        out = out.unionByName(c)
    return out


# ----------------------------------------------------------------- J10 --
# A left's rarest bigrams look for its first candidates; so many of them with
# most shared bigrams, times k, are scored to get a bound.
SEED_BIGRAMS, SEEDS = 8, 4
# Candidates scored in the first wave; each later one takes four times as many.
FIRST_WAVE = 8


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("lid").orderBy(F.col("score").desc(), F.col("rorder").asc(), F.col("rid").asc())
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _thirds(best: DataFrame, lefts: DataFrame, k: int) -> DataFrame:
    """Every left with its ``k``-th score so far, 0 if it has fewer."""
    return lefts.select("lid").join(
        best.filter(F.col("rank") == k).select("lid", F.col("score").alias("least")), "lid", "left") \
        .select("lid", F.coalesce("least", F.lit(0)).alias("least"))


def near_misses(left: DataFrame, right: DataFrame, k: int = 3,
                counts: dict | None = None) -> DataFrame:
    """Top ``k`` targets per left by (score desc, rorder asc) over *all*
    targets, without scoring all pairs. Targets that share most of a left's
    rarest bigrams give it a first ``k``-th score. From then on a pair is a
    candidate only if the length, position and part bounds of
    ``similarity_join``, taken at that score of its left, let it reach the
    score; candidates are scored by falling upper bound, in waves, until the
    next bound is below the ``k``-th score. Lefts still short of ``k``
    take score-0 targets in target order.

    left(lid, ltext), right(rid, rtext, rorder) -> (lid, rid, score, rank).
    ``counts`` receives the number of pairs, of candidates and of scored pairs."""
    left = cut_lineage(left.select("lid", "ltext"))
    right = cut_lineage(right.select("rid", "rtext", "rorder"))
    order = right.select("rid", "rorder")

    def index(kind: str):
        lt, rt = (cut_lineage(tokens(*x, kind)) for x in ((left, "lid", "ltext"), (right, "rid", "rtext")))
        freq = lt.select("token").unionByName(rt.select("token")).groupBy("token").agg(
            F.count(F.lit(1)).alias("df"))
        w = Window.partitionBy("id").orderBy(F.col("df").asc(), F.col("token").asc())
        return [cut_lineage(x.join(freq, "token").withColumn("pos", F.row_number().over(w)))
                for x in (lt, rt)]

    lb, rb = index("bigram")
    lc, rc = index("char")

    # First candidates: most shared among the left's rarest bigrams.
    met = (lb.filter(F.col("pos") <= SEED_BIGRAMS).select(F.col("id").alias("lid"), "token")
           .join(rb.select(F.col("id").alias("rid"), "token"), "token")
           .groupBy("lid", "rid").agg(F.count(F.lit(1)).alias("met")))
    w = Window.partitionBy("lid").orderBy(F.col("met").desc(), F.col("rid").asc())
    seeds = met.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= SEEDS * k)
    known = cut_lineage(_scored(seeds.select("lid", "rid"), left, right)
                        .join(order, "rid").select("lid", "rid", "score", "rorder"))
    best = cut_lineage(_ranked(known, k))
    least = cut_lineage(_thirds(best, left, k))

    # Candidates at each left's own bound.
    def candidates(kind: str, li: DataFrame, ri: DataFrame, lefts: DataFrame) -> DataFrame:
        at = F.greatest(F.col("least"), F.lit(1))
        li = li.join(lefts, F.col("id") == F.col("lid")).drop("lid").withColumn("theta", at)
        li = li.filter(F.col("n_tok") - F.col("pos") + 1 >= _tau_floor(F.col("len"), F.col("theta"), kind))
        return _meet(li, ri, F.col("a.theta"), kind).distinct()

    pairs = candidates("bigram", lb, rb, least.filter(F.col("least") >= BIGRAM_MIN_THETA)).union(
        candidates("char", lc, rc, least.filter(F.col("least") < BIGRAM_MIN_THETA)))
    parts = {(side, kind): df.select(F.col("id").alias(f"_{side}id"), F.col("len").alias(f"{side}len"),
                                     F.col("parts").alias(f"{side}{kind}")).distinct()
             for side, kind, df in (("l", "b", lb), ("r", "b", rb), ("l", "c", lc), ("r", "c", rc))}
    total = F.col("llen") + F.col("rlen")
    lcs_most = F.least(shared_at_most(F.col("lc"), F.col("rc")),
                       F.floor((shared_at_most(F.col("lb"), F.col("rb")) + total - 1) / 3).cast("int"))
    bounded = (pairs.join(parts["l", "b"], "_lid").join(parts["l", "c"].drop("llen"), "_lid")
               .join(parts["r", "b"], "_rid").join(parts["r", "c"].drop("rlen"), "_rid")
               .select(F.col("_lid").alias("lid"), F.col("_rid").alias("rid"),
                       F.bround(F.lit(200.0) * lcs_most / total, 0).cast("int").alias("bound")))
    pending = cut_lineage(bounded.join(known.select("lid", "rid"), ["lid", "rid"], "left_anti")
                          .join(least, "lid").filter(F.col("bound") >= F.col("least")).drop("least"))
    if counts is not None:
        counts["pairs"] = left.count() * right.count()
        counts["candidates"] = pending.count() + known.count()
        counts["scored"] = known.count()
    wave = FIRST_WAVE
    while not pending.isEmpty():
        by = Window.partitionBy("lid").orderBy(F.col("bound").desc(), F.col("rid").asc())
        numbered = cut_lineage(pending.withColumn("_n", F.row_number().over(by)))
        now = numbered.filter(F.col("_n") <= wave)
        if counts is not None:
            counts["scored"] += now.count()
        scored = (_scored(now.select("lid", "rid"), left, right).join(order, "rid")
                  .select("lid", "rid", "score", "rorder"))
        best = cut_lineage(_ranked(best.drop("rank").unionByName(scored), k))
        pending = cut_lineage(numbered.filter(F.col("_n") > wave).join(_thirds(best, left, k), "lid")
                              .filter(F.col("bound") >= F.col("least")).select("lid", "rid", "bound"))
        wave *= 4

    # Lefts with fewer than k: every target not found scores 0 -> first by
    # order; the first 2 * k targets hold enough of them.
    firsts = [r.rid for r in right.orderBy("rorder", "rid").select("rid").limit(2 * k).collect()]
    short = left.select("lid").join(best.filter(F.col("rank") == k).select("lid"), "lid", "left_anti")
    fill = (short.select("lid", F.explode(F.lit(firsts) if firsts else F.array().cast("array<string>"))
                         .alias("rid"))
            .join(best.select("lid", "rid"), ["lid", "rid"], "left_anti")
            .join(order, "rid").select("lid", "rid", F.lit(0).alias("score"), "rorder"))
    return _ranked(best.drop("rank").unionByName(fill), k).select(
        "lid", "rid", "score", F.col("rank").cast("int").alias("rank"))
