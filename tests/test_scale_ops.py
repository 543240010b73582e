"""Type inference, quantile sketches, sparse one-hot, sampled silhouette."""

import datetime

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from statweave.operators import ml, schema, sketch
from statweave.sources import files

TEXTS = [("1", "1", "x", "2024-02-29", "1e3", None, "2024-01-01"),
         ("-7", "2.5", "1", "2023-12-31", ".5", None, "2024-02-30"),
         (None, "+3", "2", None, "7.", None, "2024-01-02")]


def test_infer_types(spark, tmp_path):
    df = spark.createDataFrame(TEXTS, "a string, b string, c string, d string, e string, f string, g string")
    got = {r.column: r.type for r in files.infer_types(df).collect()}
    # 2024-02-30 is no day, so its column stays text
    assert got == {"a": "long", "b": "double", "c": "string", "d": "date", "e": "double",
                   "f": "null", "g": "string"}
    assert {r.type for r in files.infer_types(df.limit(0)).collect()} == {"null"}
    path = files.write_csv(df, str(tmp_path / "t"), sentinel="N/a")
    back = files.read_csv_inferred(spark, path)
    assert [t for _, t in back.dtypes] == ["bigint", "double", "string", "date", "double", "string", "string"]
    rows = sorted(back.collect(), key=lambda r: r.b)
    assert [r.a for r in rows] == [1, -7, None] and rows[0].d == datetime.date(2024, 2, 29)
    assert [r.e for r in rows] == [1000.0, 0.5, 7.0] and rows[2].d is None


def test_sketches_merge(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if x < 0 else "b", int(i % 7), float(x)) for i, x in enumerate(rng.normal(size=30_000))]
    rows += [("a", 0, float("nan")), ("b", 1, None), ("c", 0, None)]
    df = spark.createDataFrame(rows, "g string, day int, x double").repartition(5)
    fine = sketch.build(df, ["g", "day"], "x")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = sketch.quantiles(sketch.roll_up(fine, ["g"]), ["g"], probs).collect()
    assert {r.g for r in got} == {"a", "b"} and len(got) == 10
    for r in got:
        xs = np.sort([x for g, _, x in rows if g == r.g and x is not None and x == x])
        assert r.n == len(xs)
        low, high = np.searchsorted(xs, r.quantile, "left") / len(xs), np.searchsorted(xs, r.quantile, "right") / len(xs)
        assert low - 3 * sketch.rank_error() <= r.prob <= high + 3 * sketch.rank_error()
    assert sketch.quantiles(sketch.roll_up(fine.limit(0), ["g"]), ["g"], probs).collect() == []


def test_sparse_one_hot(spark):
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey", "c_mktsegment")
    dense = schema.one_hot(c, "c_mktsegment", prefix="seg")
    names = [n for n in dense.columns if n.startswith("seg_")]
    out, levels = schema.one_hot_sparse(c, "c_mktsegment")
    got = {r.c_custkey: r.v for r in out.select("c_custkey", vector_to_array("onehot").alias("v")).collect()}
    for r in dense.collect():
        assert got[r.c_custkey] == [float(r[n]) for n in names]
    at = {r.level: r.position for r in levels.collect()}
    assert sorted((p, f"seg_{v}") for v, p in at.items() if p is not None) == list(enumerate(names))


@pytest.mark.parametrize("values, width", [([None, None], 1), (["x", None], 1), (["b", "a", None, "b"], 1)])
def test_sparse_one_hot_few_levels(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "level string")
    out = schema.one_hot_sparse(df, "level")[0].select("level", vector_to_array("onehot").alias("v")).collect()
    assert len(out) == len(values)
    assert all(r.v == [1.0 if r.level == "b" else 0.0] * width for r in out)


def test_sparse_one_hot_many_levels(spark):
    df = spark.range(100_000).select(F.format_string("k%06d", "id").alias("k"), "id")
    out, levels = schema.one_hot_sparse(df, "k")
    assert out.columns == ["k", "id", "onehot"] and levels.count() == 100_000
    r = out.filter("id = 77777").first().onehot
    assert r.size == 99_999 and list(r.indices) == [77_776]
    assert out.filter("id = 0").first().onehot.numNonzeros() == 0


def euclidean_silhouette(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        own = (c == c[i]).sum()
        if own == 1:
            out.append(0.0)
            continue
        a = d[i][c == c[i]].sum() / (own - 1)
        b = min(d[i][c == k].mean() for k in set(c) - {c[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_sampled_silhouette(spark):
    rng = np.random.default_rng(4)
    c = np.repeat([0, 1, 2, 3], [150, 90, 60, 1])
    x = rng.normal(size=(301, 3)) + 1.5 * c[:, None]
    rows = [(i, x[i].tolist(), int(c[i])) for i in range(301)]
    df = spark.createDataFrame(rows, "id int, a array<double>, cluster int").withColumn(
        "features", array_to_vector("a"))
    exact = euclidean_silhouette(x, c)
    whole = ml.sampled_silhouette(df, "id", per_cluster=1000).first()
    assert whole.silhouette == pytest.approx(exact, rel=1e-9)
    assert whole.std_error == 0 and whole.n_sampled == 301
    part = ml.sampled_silhouette(df, "id", per_cluster=30).first()
    assert part.n_sampled == 91 and 0 < part.std_error < 0.1
    assert abs(part.silhouette - exact) < 3 * part.std_error
    assert ml.sampled_silhouette(df.filter("cluster = 0"), "id").first().silhouette is None
    assert ml.sampled_silhouette(df.limit(0), "id").first().n_sampled == 0
