"""The parts of the methods, and quality on the given tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statweave.llm import (components, langid, licenses, main_text, mixing, quality, simhash,
                           toxicity, url_reputation)
from statweave.llm.common import table
from statweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_template_regions():
    a = licenses.compile_template("x", "copyright [[c]] <<3>> all rights reserved")

    def n(t):
        return a.match(licenses.words(t), 0)
    assert n(b"Copyright (c) 2020 Foo Bar. All rights reserved.") == 8
    assert n(b"copyright all rights reserved") == 4
    assert n(b"copyright a b c d all rights reserved") is None
    assert n(b"copyright c a b c all rights reserved") == 8
    assert n(b"copyright a all right reserved") is None
    with pytest.raises(ValueError):
        licenses.compile_template("x", "[[open")


def test_ppm_code_lengths_are_exact():
    """Direct tables, windows and binary search give the recursive code
    length; unseen bytes cost their escapes and eight bits."""
    text = "abracadabra abracadabra"
    counts = {}
    data = (langid.PAD + text).encode()
    for k in range(langid.ORDER + 1):
        for i in range(langid.ORDER, len(data)):
            g = int.from_bytes(data[i - k:i + 1], "big")
            counts[k, g] = counts.get((k, g), 0) + 1
    m = langid.Model.from_counts([("x", k, g, n) for (k, g), n in counts.items()])

    def cost(ctx, s):
        if ctx is None:
            return 8.0
        k = len(ctx)
        seen = {g & 255: n for (o, g), n in counts.items()
                if o == k and g >> 8 == int.from_bytes(ctx, "big")}
        lower = ctx[1:] if k else None
        if not seen:
            return cost(lower, s)
        whole = sum(seen.values()) + len(seen)
        if s in seen:
            return -np.log2(seen[s] / whole)
        return -np.log2(len(seen) / whole) + cost(lower, s)
    tests = ["abra", "", "zzz\u00e9", text, "cadabrac"]
    want = []
    for t in tests:
        b = (langid.PAD + t).encode()
        want.append(sum(cost(b[i - 3:i], b[i]) for i in range(3, len(b))))
    bits, size = m.code_lengths(pa.array(tests))
    assert np.allclose(bits[:, 0], want, rtol=1e-5) and list(size) == [len(t.encode()) for t in tests]
    old, langid.WINDOW = langid.WINDOW, 5
    try:
        assert np.allclose(m.code_lengths(pa.array(tests))[0][:, 0], want, rtol=1e-5)
    finally:
        langid.WINDOW = old


def test_language_held_out_accuracy(spark):
    got = QUERIES["op4_ppm_language"](spark, SF).join(
        table(spark, SF, "documents", "doc_id", "lang"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_toxicity_quality(spark):
    got = QUERIES["op10_classifier_chain"](spark, SF).withColumnRenamed("toxic", "flag").join(
        table(spark, SF, "labels", "doc_id", "toxic"), "doc_id")
    r = got.agg(F.avg(F.when(F.col("flag"), F.col("toxic"))), F.avg(
        F.when(F.col("toxic") == 1, F.col("flag").cast("int")))).first()
    assert r[0] > 0.9 and r[1] > 0.8


def test_flight_keeps_totals():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 2000, 3000)
    pi = np.full(3000, 0.37)
    out = mixing.flight(size, pi, rng)
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2
    assert abs(out.sum() - pi.sum()) < 1e-6 and abs(out @ size - pi @ size) < 1e-3
    landed = mixing.flight(size, pi, rng, keep=12, land=True)
    assert set(np.unique(landed)) <= {0.0, 1.0} and abs(landed @ size - pi @ size) < 50


def test_mixing_levels_agree_with_targets(spark):
    """Small blocks force several levels of flight."""
    docs = table(spark, "/root/testdata/sf0.1", "documents", "doc_id", "source", "text")
    decisions, goal = mixing.mix(docs, block=64)
    got = decisions.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"),
                                          F.sum("size").alias("size")).join(goal, "source").collect()
    assert len(got) == goal.count()
    for r in got:
        assert abs(r["taken"] - r["target"]) < 0.005 * r["target"] and r["size"] == r["source_size"]


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_crowded_buckets_link_exactly(spark, bits):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    fps = {base}
    while len(fps) < 300:
        x = int(rng.choice(sorted(fps)))
        for b in rng.integers(0, 14, int(rng.integers(1, 5))):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 100)}
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    group = {x: x for x in fps}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits and find(a) != find(b):
                group[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in components.components(simhash.links(df, bits, hot=16)).collect()}
    assert {x: got.get(x, x) for x in fps} == {x: find(x) for x in fps}


def test_components_long_chain(spark):
    e = spark.range(0, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(e).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}


def test_dedupe_and_mix_keep_columns(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    for f in (simhash.dedupe, mixing.apply, quality.keep, langid.keep):
        assert f(docs).columns == docs.columns
    classes = simhash.near_duplicates(docs).select("root").distinct().count()
    assert simhash.dedupe(docs).count() == classes


def test_suffix_array_across_shards(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [("h", i, [f"own{i} words only{i}", text]) for i in range(6)] + [("g", 9, [text])]
    pages = spark.createDataFrame(rows, "host string, uid long, blocks array<string>")
    runs = main_text.repeated_runs(pages, shard_pages=1).collect()
    assert len(runs) == 3 and {r["host"] for r in runs} == {"h"}
    assert main_text.unique_blocks([f"own1 words only1", text], [3, 4, 5]) == ["own1 words only1"]


def test_suffix_ranks_are_the_sorted_suffixes():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 3, 200)
    rank = main_text.suffix_ranks(ids, 8)
    keys = [tuple(ids[i:i + 8]) for i in range(200)]
    order = np.argsort(rank, kind="stable")
    assert [keys[i] for i in order] == sorted(keys)


def test_reputation_shrinks_and_blocks(spark):
    pages = [(i, f"http://{h}/{1000 * k + i}", None) for k, h in enumerate(
        ["bad.site.org", "good.site.org", "new.org"]) for i in range(60)]
    labels = [(i, 0, 1) for i in range(60)] + [(1000 + i, 1, 0) for i in range(60)]
    got = url_reputation.judge(
        spark.createDataFrame(pages, "page_id long, url string, html string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    verdict = {(r["host"], r["verdict"]) for r in got.collect()}
    assert verdict == {("bad.site.org", "block"), ("good.site.org", "allow"), ("new.org", "allow")}
    kept = url_reputation.keep(
        spark.createDataFrame(pages, "page_id long, url string, html string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.count() == 120


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(2)
    n = 400
    y = (rng.random(n) < 0.3).astype(float)
    x = toxicity.Rows(np.zeros(n, int), y + 0.1, np.arange(n), n, 2)
    w, c, b = toxicity.fit_logistic(x, np.zeros((n, 0)), y)
    assert w[0] > 0.5 and w[1] == 0
    _, c, _ = toxicity.fit_logistic(toxicity.Rows(np.zeros(0, int), np.zeros(0), np.zeros(0, int), n, 2),
                                    y[:, None], y)
    assert c[0] > 0
    assert 0.4 < toxicity.best_threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0])) < 0.6


def test_contradicting_label_rows(spark):
    """A document with several label rows is toxic if any of them says so."""
    from pyspark.sql import functions as F

    from statweave.llm import toxicity
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    rows = [(0, 0), (0, 1), (1, 1), (1, 0), (2, 0), (2, 0), (3, None), (3, 1), (4, None)]
    for order in (rows, rows[::-1]):
        labels = spark.createDataFrame(order, "doc_id long, toxic int").repartition(3)
        got = toxicity.training_sample(docs, labels, {"toxic": F.col("toxic") == 1}).collect()
        assert sorted((r.doc_id, r.toxic) for r in got) == [(0, 1), (1, 1), (2, 0), (3, 1)]


def test_search_floors(spark):
    """A query starts every shard from the k-th best score of one shard, and
    the shards' results are those of a search over all documents in one."""
    from statweave.llm import search
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, int(rng.integers(1, 60))) if x < 400))
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    asked = docs.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    batch = search.Batch([i for i, _ in rows], [t.encode() for _, t in rows])
    found = np.array([(batch.terms[:, None] == np.fromiter(search._terms(t.encode()), np.int64)).any(1)
                      for _, t in rows]).sum(0)
    batch.idf = np.log1p((600 - found + 0.5) / (found + 0.5))
    batch.mean_length = float(np.mean([len(t.split()) for _, t in rows]))
    whole = search.ShardIndex(search._shard([i for i, _ in rows], [search._bag(t.encode()) for _, t in rows]), batch)
    # Only the first documents: no posting of another one is left.
    part = search.ShardIndex(search._shard([i for i, _ in rows], [search._bag(t.encode()) for _, t in rows]), batch, 100)
    assert len(part.ids) == 100 and part.post_doc.max() < 100 and (np.diff(part.post_start) > 0).all()
    want = {}
    for q in range(0, 600, 20):
        terms = batch.at[batch.starts[q]:batch.starts[q + 1]]
        best, again = [], []
        every = whole.search(terms, 10, best)
        few = whole.search(terms, 10, again, best[0][0] if len(best) == 10 else 0.0)
        assert sorted(best) == sorted(again) and few <= every
        want[q] = [(r + 1, int(-d), s) for r, (s, d) in enumerate(sorted(best, reverse=True))]
    for shard_docs in (70, 1000):
        index = search.build_index(docs, shard_docs)
        least = search.floors(index, spark.sparkContext.broadcast(batch), 600, 10)
        assert all(least[q] <= want[q][-1][2] + 1e-9 for q in want if len(want[q]) == 10)
        assert (least > 0).any()
    got = {}
    for r in search.top_k(docs, asked).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert {q: [x[:2] for x in v] for q, v in got.items()} == {q: [x[:2] for x in v] for q, v in want.items() if v}
    assert all(np.allclose([x[2] for x in got[q]], [x[2] for x in want[q]], atol=2e-6) for q in got)
