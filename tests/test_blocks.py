"""Similar prose by blocks equals the token join and brute force."""

import random

import numpy as np
import pytest

from statweave.functions.similarity import PackedTexts
from statweave.operators import match


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = row
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
    return row[-1]


def _score(a, b):
    if a == b:
        return 100
    return int(np.rint(200.0 * _lcs(a, b) / (len(a) + len(b)))) if a and b else 0


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "é\U0001f600", "of", "the"]
    right = sorted({" ".join(rnd.choices(words, k=rnd.randint(1, 12))) for _ in range(24)} | {""})
    left = {"", "zzz"}
    for t in right:
        left.add("".join(c for c in t if rnd.random() > 0.2))
        left.add(" ".join(rnd.choices(words, k=rnd.randint(1, 12))))
    left = sorted(left)
    return left, right, (spark.createDataFrame([(t, t) for t in left], "lid string, ltext string"),
                         spark.createDataFrame([(t, t, i % 7) for i, t in enumerate(right)],
                                               "rid string, rtext string, rorder long"))


def test_packed_texts(sides):
    left, right, _ = sides
    packed = PackedTexts(right)
    for t in left[::5]:
        assert packed.lcs(t).tolist() == [_lcs(t, r) for r in right]
        assert packed.ratio(t).tolist() == [_score(t, r) for r in right]


def test_block_join(sides, monkeypatch):
    monkeypatch.setattr(match, "BLOCK", 8)
    left, right, (le, ri) = sides
    got = {(r.lid, r.rid, r.score) for r in match.block_join(le, ri, 75).collect()}
    assert got == {(a, b, _score(a, b)) for a in left for b in right if (a or b) and _score(a, b) >= 75}


def test_block_nearest(sides, monkeypatch):
    monkeypatch.setattr(match, "BLOCK", 8)
    left, right, (le, ri) = sides
    got = {(r.lid, r["rank"]): (r.rid, r.score) for r in match.block_nearest(le, ri, 3).collect()}
    for a in left:
        best = sorted((-_score(a, b), i % 7, b) for i, b in enumerate(right))[:3]
        assert [got[a, n + 1] for n in range(3)] == [(b, -s) for s, _, b in best]


def test_queries_on_prose_take_no_token_join(spark, monkeypatch):
    """Every pair of the given lines met at most of its tokens."""
    import __spark_entry__ as E

    def refuse(*a, **k):
        raise AssertionError("token join on prose")
    monkeypatch.setattr(match, "similarity_candidates", refuse)
    for name in ("line_matches", "unmatched_near_misses"):
        E.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()


def test_kmeans_sweep_caches_no_frame(spark, monkeypatch):
    """on a cached frame every iteration decodes all rows again; the
    numbers are those of the cached frame."""
    from pyspark.sql import functions as F
    from statweave.operators import ml
    df = ml.assemble(spark.range(300).select(*[
        (F.rand(i) + 5 * (F.col("id") % 3 == i).cast("int")).alias(f"x{i}") for i in range(3)]), ["x0", "x1", "x2"])
    kept = df.select("features").cache()
    kept.count()
    want = ml.kmeans_sweep(kept, range(2, 5)).orderBy("k").collect()
    kept.unpersist()

    def refuse(self):
        raise AssertionError("cached")
    monkeypatch.setattr(type(df), "cache", refuse)
    got = ml.kmeans_sweep(df, range(2, 5)).orderBy("k").collect()
    for a, b in zip(got, want):
        assert (a.k, a.best) == (b.k, b.best)
        assert a.inertia == pytest.approx(b.inertia, rel=1e-6)
        assert a.silhouette_sq == pytest.approx(b.silhouette_sq, abs=1e-6)
