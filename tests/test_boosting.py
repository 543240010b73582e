"""Fits in one task grow Spark's trees, without Spark's jobs."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from statweave.operators import boosting, ml

P = ml.GbtParams(12, 4, 0.2, 0.8)


def _rows(n: int = 300) -> list[tuple]:
    """Numbers of few and of many values, sparse and constant columns."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        x, kind = rng.normal(size=2), int(rng.integers(0, 6))
        y = 50 * x[0] - 9 * x[1] ** 2 + 7 * kind + rng.normal()
        rows.append((i, float(x[0]), float(round(x[1], 1)), float(kind == 0), float(kind == 4), 1.0, float(y)))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    df = spark.createDataFrame(_rows(), "id int, a double, b double, c double, d double, e double, y double")
    v = VectorAssembler(inputCols=["a", "b", "c", "d", "e"], outputCol="features").transform(df)
    v = v.select("id", "features", "y").coalesce(1).sortWithinPartitions("id").cache()
    return v.filter("id % 5 < 3"), v.filter("id % 5 = 3"), v.filter("id % 5 = 4")


@pytest.mark.parametrize("depth, rate", [(2, 1.0), (4, 0.8), (7, 0.8)])
def test_same_trees_as_spark(frames, depth, rate):
    train, valid, test = frames
    spark_model = ml._gbt(ml.GbtParams(12, depth, 0.2, rate), 12, "y").fit(train)
    fit = boosting.fit_many([boosting.Fold(train, valid, test)], "y",
                            [boosting.Job(0, depth, 0.2, rate, 12, 99)])[0]
    assert fit.losses == pytest.approx(spark_model.evaluateEachIteration(valid, "squared"), rel=1e-9)
    assert fit.maes == pytest.approx(spark_model.evaluateEachIteration(test, "absolute"), rel=1e-9)
    best = boosting.stop_at(fit.losses, 99)[0]
    own = boosting.to_model(fit.nodes, ml._gbt(P, best, "y"))
    shown = ml.cut_model(spark_model, best)
    assert own.toDebugString.split("\n")[1:] == shown.toDebugString.split("\n")[1:]
    assert own.featureImportances.toArray() == pytest.approx(shown.featureImportances.toArray(), rel=1e-9)


def test_partitions(spark, frames):
    """Rows are drawn by partition, an empty one included."""
    train, valid, _ = frames
    many = train.repartitionById(4, F.when(F.col("id") < 40, 0).when(F.col("id") < 150, 2).otherwise(3)).cache()
    assert [len(p) for p in many.rdd.glom().collect()].count(0) == 1
    want = ml._gbt(P, 12, "y").fit(many).evaluateEachIteration(valid, "squared")
    got = boosting.fit_many([boosting.Fold(many, valid)], "y", [boosting.Job(0, 4, 0.2, 0.8, 12, 99)])[0]
    assert got.losses == pytest.approx(want, rel=1e-9)


def test_search_without_a_job_for_each_level(spark):
    """A search of many trees: Spark's fits would run thousands of jobs."""
    rows = [(*r[:5], r[6], r[0] % 5) for r in _rows(200)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y double, fold int").coalesce(1)
    grid = [ml.GbtParams(n, d, 0.01, s) for n in (100, 200) for d in (3, 5) for s in (0.8, 1.0)]
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    got = ml.staged_grid(df, ["a", "b", "c", "d"], "y", grid, 5).collect()
    assert len(got) == 8 and jobs() - before < 60
    assert all(math.isfinite(r.cv_mae) and r.best_trees > 1 for r in got)


def test_model_without_a_job_for_each_level(spark, frames):
    train, valid, _ = frames
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    model, losses, best = ml.early_stopped(train, valid, "y", ml.GbtParams(100, 5, 0.05, 0.8))
    assert jobs() - before < 40 and len(model.trees) == best <= len(losses)


def test_spark_fits_what_a_task_does_not_hold(frames, monkeypatch):
    train, valid, _ = frames
    _, here, best = ml.early_stopped(train, valid, "y", P)
    monkeypatch.setattr(boosting, "TASK_VALUES", 10)
    _, there, of_spark = ml.early_stopped(train, valid, "y", P)
    assert best == of_spark and here == pytest.approx(there, rel=1e-9)


def test_split_points():
    some = np.arange(5.0)
    assert boosting.split_points(some, np.ones(5, int), 5).tolist() == [0.5, 1.5, 2.5, 3.5]
    assert len(boosting.split_points(np.zeros(1), np.ones(1, int), 9)) == 0
    many = boosting.split_points(np.arange(1000.0), np.ones(1000, int), 1000)
    assert len(many) == 31 and np.abs(np.diff(many) - 1000 / 32).max() <= 1


def test_labels_that_are_no_numbers(spark, frames):
    train, valid, _ = frames
    bad = train.withColumn("y", F.when(F.col("id") > 0, F.col("y")))
    with pytest.raises(Exception, match="must be numbers"):
        ml.early_stopped(bad, valid, "y", P)
