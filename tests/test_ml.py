"""Invariants for the ML queries (rows-only in the driver's gate)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from statweave.operators import ml

WHOLE_GRID = ml.reference_grid
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def q():
    """The queries, with a search over six points instead of 54 (the whole one
    takes minutes; its points are checked below)."""
    ml.reference_grid = lambda: [ml.GbtParams(n, d, 0.1, 0.8) for n in (100, 200, 300) for d in (3, 5)]
    yield E.queries()
    ml.reference_grid = WHOLE_GRID


def test_reference_grid():
    grid = WHOLE_GRID()
    assert len(set(grid)) == 54 and {p.max_iter for p in grid} == {100, 200, 300}


def test_stop_at():
    stop_at = ml.stop_at
    assert stop_at([5, 4, 3, 2]) == (4, False)
    assert stop_at([5, 4, 4, 4, 4], patience=3) == (2, True)      # an equal loss is no gain
    assert stop_at([5, 4, 6, 6, 3, 9, 9, 9, 1], patience=3) == (5, True)  # the 1 comes too late
    assert stop_at([5, 4, 6, 6], patience=3) == (2, False)
    assert stop_at([7], patience=1) == (1, False)


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        x = rng.normal(size=3)
        rows.append((i, *map(float, x), float(3 * x[0] - x[1] ** 2 + rng.normal()), i % 5))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, fold int").coalesce(1)


def test_early_stop_equals_shorter_fit(noisy):
    """The cut model is the fit of that many trees, and its loss is the
    smallest of the run."""
    d = ml.scaled_folds(noisy, ["a", "b", "c"], "y", 5)[0]
    p = ml.GbtParams(60, 3, 0.3, 0.8)
    model, losses, best = ml.early_stopped(d["train"], d["valid"], "y", p, patience=5)
    assert len(model.trees) == best and losses[best - 1] == min(losses)
    assert len(losses) == 60 or len(losses) == best + 5
    again = ml._gbt(p, best, "y").fit(d["train"])
    got = model.transform(d["test"]).select("prediction").collect()
    assert got == again.transform(d["test"]).select("prediction").collect()
    mse = d["valid"].select("y", "features")
    mse = model.transform(mse).selectExpr("avg((y - prediction) * (y - prediction)) AS m").first().m
    assert mse == pytest.approx(losses[best - 1], rel=1e-9)


def test_staged_grid_equals_separate_fits(noisy):
    """Points that differ in the number of trees share a fit, and each has
    the error of a fit of its own."""
    grid = [ml.GbtParams(n, d, 0.2, 1.0) for n in (3, 12, 30) for d in (2, 4)]
    got = {(r.max_iter, r.max_depth): r for r in ml.staged_grid(noisy, ["a", "b", "c"], "y", grid, 5, 4).collect()}
    assert len(got) == 6 and sorted(r["rank"] for r in got.values()) == list(range(1, 7))
    folds = ml.scaled_folds(noisy, ["a", "b", "c"], "y", 5)
    for p in (grid[0], grid[3], grid[4]):
        maes = []
        for d in folds:
            model, _, _ = ml.early_stopped(d["train"], d["valid"], "y", p, patience=4)
            maes.append(model.transform(d["test"]).selectExpr("avg(abs(y - prediction)) AS m").first().m)
        r = got[(p.max_iter, p.max_depth)]
        assert r.cv_mae == pytest.approx(np.mean(maes), rel=1e-9)
        assert r.cv_std == pytest.approx(np.std(maes), rel=1e-6)
    best = min(got.values(), key=lambda r: r["rank"])
    assert best.cv_mae == min(r.cv_mae for r in got.values())


def test_kmeans_partition(spark, q):
    from statweave.plans.q_ml import clustered
    out, model = clustered(spark, SF)
    n = out.count()
    sizes = {r.cluster: r["count"] for r in out.groupBy("cluster").count().collect()}
    assert sum(sizes.values()) == n and len(sizes) <= 4
    centres = np.array([c for c in model.clusterCenters()])
    pts = out.select("features", "cluster").collect()
    for r in pts:
        d = ((centres - r.features.toArray()) ** 2).sum(axis=1)
        assert d[r.cluster] <= d.min() + 1e-9            # each point is nearest its own centre


def test_kmeans_sweep(spark, q):
    rows = q["kmeans_sweep"](spark, SF).orderBy("k").collect()
    assert [r.k for r in rows] == list(range(2, 11))
    assert sum(r.best for r in rows) == 1
    assert all(-1.0 <= r.silhouette_sq <= 1.0 for r in rows)
    assert rows[-1].inertia < rows[0].inertia          # more centres, less inertia overall


def test_cluster_profile_recomputed(spark, q):
    prof = {r.cluster: r for r in q["cluster_profile"](spark, SF).collect()}
    asg = q["kmeans_assign"](spark, SF)
    assert sum(r.n for r in prof.values()) == asg.count()
    ct = q["cluster_crosstab"](spark, SF)
    segs = [c for c in ct.columns if c != "cluster"]
    assert sum(sum(r[c] for c in segs) for r in ct.collect()) == asg.count()
    ex = q["cluster_exemplars"](spark, SF).collect()
    assert len(ex) == len(prof)


def test_pca(spark, q):
    rows = q["pca_project"](spark, SF).collect()
    r1, r2 = rows[0].ratio1, rows[0].ratio2
    assert 0 < r2 <= r1 <= 1 and r1 + r2 <= 1 + 1e-9
    pc1 = np.array([r.pc1 for r in rows])
    pc2 = np.array([r.pc2 for r in rows])
    assert abs(np.corrcoef(pc1, pc2)[0, 1]) < 1e-6 or np.var(pc2) == 0   # uncorrelated scores
    assert np.var(pc1) >= np.var(pc2)
    e = q["embedding_pca"](spark, SF).first()
    assert 0 < e.ratio2 <= e.ratio1 <= 1


def test_split_and_models(spark, q):
    split = q["train_test_split"](spark, SF)
    n = split.count()
    assert split.filter("is_test").count() == math.ceil(0.2 * n)
    pred = q["gbt_predict"](spark, SF)
    assert pred.count() == n and pred.filter(F.col("prediction").isNull()).count() == 0
    met = {r.slice: r for r in q["model_metrics"](spark, SF).collect()}
    te = pred.filter("is_test").toPandas()
    assert met["test"].n == len(te)
    assert met["test"].mae == pytest.approx((te.spend - te.prediction).abs().mean(), rel=1e-4)
    imp = q["feature_importance"](spark, SF).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0, abs=1e-6)
    assert [r.rank for r in imp] == list(range(1, len(imp) + 1))


def test_cv_and_grid(spark, q):
    """The best point of the search is the one that the later steps use."""
    cv = q["cv_mae"](spark, SF).collect()
    assert sorted(r.fold for r in cv) == [0, 1, 2, 3, 4] and all(r.mae >= 0 for r in cv)
    grid = q["gbt_grid"](spark, SF).orderBy("rank").collect()
    assert len(grid) == 6 and grid[0].cv_mae == min(r.cv_mae for r in grid)
    report = q["valuation_report"](spark, SF).first()
    assert (report.max_iter, report.max_depth, report.grid_mae) == (
        grid[0].max_iter, grid[0].max_depth, grid[0].cv_mae)
    pred = q["gbt_predict"](spark, SF).toPandas()
    err = (pred.spend - pred.prediction).abs()
    assert report.mae_test == pytest.approx(err[pred.is_test].mean(), rel=1e-4)
    assert report.mae_train == pytest.approx(err[~pred.is_test].mean(), rel=1e-4)
    assert report.n_test == pred.is_test.sum()
    assert report.cv_mean == pytest.approx(np.mean([r.mae for r in cv]), rel=1e-6)
    assert report.cv_std == pytest.approx(np.std([r.mae for r in cv]), rel=1e-4)
    assert report.n_matched == q["fuzzy_assign"](spark, SF).count()
    assert report.n_unmatched == q["unmatched_entities"](spark, SF).count()
    curve = q["gbt_early_stop"](spark, SF).collect()
    best = [r for r in curve if r.best]
    assert len(best) == 1 and best[0].iteration == report.trees
    assert best[0].loss == min(r.loss for r in curve)


def test_report_text(spark, q):
    lines = [r.line for r in q["valuation_report_text"](spark, SF).collect()]
    assert lines[:4] == ["# Value estimation", "", "| measure | value |", "| --- | --- |"]
    report = q["valuation_report"](spark, SF).first()
    assert f"| n_test | {report.n_test} |" in lines and f"| mae_test | {report.mae_test:.2f} |" in lines
    assert len(lines) == 4 + len(report)


def test_assignment_one_to_one(spark, q):
    a = q["fuzzy_assign"](spark, SF)
    assert a.count() == a.select("target_name").distinct().count() == a.select("left_name").distinct().count()
    assert a.filter("score < 75").count() == 0
