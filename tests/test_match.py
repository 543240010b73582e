"""Similarity join, assignment and near misses against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statweave.functions.similarity import lcs_length, ratio
from statweave.operators import components, match


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j in range(1, len(b) + 1):
            cur.append(prev[j - 1] + 1 if ch == b[j - 1] else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def py_ratio(a, b):
    if a == b:
        return 100
    if not a or not b:
        return 0
    return round(200 * lcs(a, b) / (len(a) + len(b)))   # Python round = half even


def serial_assign(edges):
    """The serial loop: edges (lid, rid, score, lprio, rorder)."""
    by_left = {}
    for lid, rid, score, lprio, rorder in edges:
        by_left.setdefault((lprio, lid), []).append((-score, rorder, rid, score))
    taken, out = set(), []
    for (lprio, lid) in sorted(by_left):
        for _, _, rid, score in sorted(by_left[(lprio, lid)]):
            if rid not in taken:
                taken.add(rid)
                out.append((lid, rid, score))
                break
    return out


def _names(seed, n, alphabet="abcde ", lo=3, hi=12):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        out.add("".join(rng.choice(alphabet) for _ in range(rng.randint(lo, hi))))
    return sorted(out)


def test_ratio_matches_python(spark):
    names = _names(1, 40)
    pairs = [(a, b) for a in names[:20] for b in names[20:]] + [("kitten", "sitting"), ("", "x"),
                                                                ("abc", "abc")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [py_ratio(a, b) for a, b in pairs]


def test_lcs_bits_long_and_foreign(spark):
    """Bit-parallel words against the table, 0 to 300 characters."""
    rng = random.Random(9)
    alphabets = ["ab", "abcdefgh ", "\u00e9\u00df\u6f22\U0001f600x", "".join(map(chr, range(97, 123)))]
    pairs = [("", ""), ("", "a"), ("a", ""), ("a" * 300, "a" * 299), ("ab" * 31, "ba" * 31),
             ("x" * 62, "x" * 62), ("x" * 63, "x" * 124), ("ab" * 100 + "c", "c" + "ba" * 100)]
    for _ in range(120):
        a = rng.choice(alphabets)
        n, m = rng.choice([5, 61, 62, 63, 124, 125, 186, 300]), rng.choice([1, 30, 62, 63, 200, 300])
        pairs.append(("".join(rng.choice(a) for _ in range(n)), "".join(rng.choice(a) for _ in range(m))))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [py_ratio(a, b) for a, b in pairs]
    small = spark.createDataFrame([p for p in pairs if len(p[0]) < 64 and len(p[1]) < 64], "a string, b string")
    dp = lcs_length(F.col("a"), F.col("b"))
    assert small.filter(ratio(F.col("a"), F.col("b")) != ratio(F.col("a"), F.col("b"), dp)).isEmpty()


def test_ratio_half_even(spark):
    """Exactly 74.5 rounds to 74, so it is not a match at 75."""
    a, b = "a" * 149 + "b" * 51, "a" * 149 + "c" * 51
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(ratio(F.col("a"), F.col("b"))).first()[0] == 74


@pytest.mark.parametrize("theta", [75, 60, 30])
def test_similarity_join_lossless(spark, theta):
    left = _names(2, 40)
    right = _names(3, 40)
    ldf = spark.createDataFrame([(x, x) for x in left], "lid string, ltext string")
    rdf = spark.createDataFrame([(x, x) for x in right], "rid string, rtext string")
    got = {(r.lid, r.rid, r.score) for r in match.similarity_join(ldf, rdf, theta).collect()}
    exp = {(a, b, py_ratio(a, b)) for a in left for b in right if py_ratio(a, b) >= theta}
    assert got == exp


def test_similarity_self_join(spark):
    names = _names(4, 50, alphabet="ab cd", lo=2, hi=9)
    df = spark.createDataFrame([(x, x) for x in names], "lid string, ltext string")
    got = {(r.lid, r.rid) for r in match.similarity_join(df, df, 75, self_join=True).collect()}
    exp = {(a, b) for a in names for b in names if a < b and py_ratio(a, b) >= 75}
    assert got == exp


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(75, 100)),
                min_size=1, max_size=25))
def test_assignment_equals_serial(spark, raw):
    """The round-based assignment equals the serial loop."""
    seen, edges = set(), []
    for l, r, s in raw:
        if (l, r) not in seen:
            seen.add((l, r))
            edges.append((f"L{l}", f"R{r}", s, l, r))
    df = spark.createDataFrame(edges, "lid string, rid string, score int, lprio int, rorder int")
    got = {(r.lid, r.rid, r.score) for r in match.assign_one_to_one(df).collect()}
    assert got == set(serial_assign(edges))
    # Components beyond the bound go through rounds.
    got = {(r.lid, r.rid, r.score) for r in match.assign_one_to_one(df, task_edges=4).collect()}
    assert got == set(serial_assign(edges))


def test_near_misses_brute_force(spark):
    left = _names(5, 12)
    right = _names(6, 30)
    ldf = spark.createDataFrame([(x, x) for x in left], "lid string, ltext string")
    rdf = spark.createDataFrame([(x, x, i) for i, x in enumerate(right)],
                                "rid string, rtext string, rorder int")
    got = {(r.lid, r.rid, r.score, r.rank) for r in match.near_misses(ldf, rdf, 3).collect()}
    exp = set()
    for a in left:
        sc = sorted(((-py_ratio(a, b), i, b) for i, b in enumerate(right)))[:3]
        exp |= {(a, b, -s, k + 1) for k, (s, i, b) in enumerate(sc)}
    assert got == exp


def test_near_misses_counts_and_ties(spark):
    """Fewer pairs are scored than there are; texts without a common
    character, empty texts and equal scores follow the target order."""
    left = _names(7, 25) + ["", "zzz", "abc"]
    right = _names(8, 120) + ["", "abc", "cba", "xyz"]
    ldf = spark.createDataFrame([(x, x) for x in left], "lid string, ltext string")
    rdf = spark.createDataFrame([(f"r{i}", x, i) for i, x in enumerate(right)],
                                "rid string, rtext string, rorder int")
    counts = {}
    got = {(r.lid, r.rid, r.score, r.rank) for r in match.near_misses(ldf, rdf, 3, counts).collect()}
    exp = set()
    for a in left:
        sc = sorted(((-py_ratio(a, b), i) for i, b in enumerate(right)))[:3]
        exp |= {(a, f"r{i}", -s, k + 1) for k, (s, i) in enumerate(sc)}
    assert got == exp
    assert counts["pairs"] == len(left) * len(right)
    assert counts["scored"] <= counts["candidates"] < counts["pairs"]


def test_near_misses_empty_sides(spark):
    some = spark.createDataFrame([("a", "a")], "lid string, ltext string")
    none = spark.createDataFrame([], "rid string, rtext string, rorder int")
    assert match.near_misses(some, none).collect() == []
    right = spark.createDataFrame([("q", "q", 0)], "rid string, rtext string, rorder int")
    assert [tuple(r) for r in match.near_misses(some, right).collect()] == [("a", "q", 0, 1)]
    assert match.near_misses(some.limit(0), right).collect() == []


def test_complete_graph_and_chain(spark):
    """2,000 x 2,000 edges, and a chain in which every choice waits for
    the one before it."""
    n = 2000
    full = spark.range(n).select(F.col("id").alias("l")).join(
        spark.range(n).select(F.col("id").alias("r")), F.lit(True)).select(
        F.format_string("L%05d", "l").alias("lid"), F.format_string("R%05d", "r").alias("rid"),
        (F.lit(75) + (F.col("l") * 7 + F.col("r") * 13) % 25).cast("int").alias("score"),
        F.col("l").alias("lprio"), F.col("r").alias("rorder"))
    got = {(r.lid, r.rid, r.score, r.round) for r in match.assign_one_to_one(full).collect()}
    edges = [(f"L{a:05d}", f"R{b:05d}", 75 + (a * 7 + b * 13) % 25, a, b)
             for a in range(n) for b in range(n)]
    assert got == {(*e, 0) for e in serial_assign(edges)}
    # left k likes target k - 1 best, which left k - 1 has taken in turn
    chain = [(f"L{k:05d}", f"R{k - d:05d}", 90 if d else 80, k, k - d)
             for k in range(10_000) for d in (0, 1) if k - d >= 0]
    df = spark.createDataFrame(chain, "lid string, rid string, score int, lprio int, rorder int")
    got = {(r.lid, r.rid, r.score) for r in match.assign_one_to_one(df).collect()}
    assert got == set(serial_assign(chain))


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(500)] + [(1000, 1001), (1002, 1001), (2000, 2000), (None, 5)]
    edges += [(3000, 3000 + k) for k in range(1, 200)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    exp = {k: 0 for k in range(501)} | {1000: 1000, 1001: 1000, 1002: 1000, 2000: 2000}
    assert got == exp | {3000 + k: 3000 for k in range(200)}
    assert components.connected_components(df.limit(0)).collect() == []
