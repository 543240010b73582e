"""Statistical and ML operators (M1-M19) on Spark ML.

Fitting follows Spark ML's estimator/model split: a fit runs distributed
jobs and brings only model-sized results to the driver (per-column moments,
centres, components, trees); transforms are column expressions or
``Model.transform``. Nothing row-sized is collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import boosting
from .rank import numbered

# Fits that run at the same time; each is a chain of small jobs.
FITS_AT_ONCE = 8


# -------------------------------------------------------------------- M1 --
def impute(df: DataFrame, mean_cols: list[str], zero_cols: list[str]) -> DataFrame:
    """Mean imputation for ``mean_cols`` (Spark ML ``Imputer``), 0 for
    ``zero_cols`` (T19)."""
    out = df
    if mean_cols:
        cast = out.withColumns({c: F.col(c).cast("double") for c in mean_cols})
        model = Imputer(strategy="mean", inputCols=mean_cols, outputCols=mean_cols).fit(cast)
        out = model.transform(cast)
    if zero_cols:
        out = out.na.fill({c: 0 for c in zero_cols})
    return out


# -------------------------------------------------------------------- M2 --
def zscore(df: DataFrame, cols: list[str], population: bool = True) -> DataFrame:
    """(x - mean) / std per column; zero variance -> 0; missing stays missing.
    ``population=True`` divides by the population std as the reference's
    scaler does (T14); one aggregate pass yields the moments."""
    sd = F.stddev_pop if population else F.stddev_samp
    m = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
               *[sd(c).alias(f"s_{c}") for c in cols]).first()
    exprs = {}
    for c in cols:
        mu, s = m[f"m_{c}"], m[f"s_{c}"]
        if mu is None:
            exprs[c] = F.lit(None).cast("double")
        elif not s:
            exprs[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            exprs[c] = (F.col(c) - F.lit(mu)) / F.lit(s)
    return df.withColumns(exprs)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def array_features(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """ARRAY<FLOAT> column (e.g. embeddings) -> ML vector."""
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


# ---------------------------------------------------------- M3 - M5, M7 --
def kmeans_fit(df: DataFrame, k: int, seed: int = 42, features: str = "features",
               max_iter: int = 300, tol: float = 1e-4):
    """Lloyd's iterations until the centres move less than ``tol``."""
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster",
                  maxIter=max_iter, tol=tol).fit(df)


def kmeans_assign(df: DataFrame, k: int, seed: int = 42, features: str = "features"):
    model = kmeans_fit(df, k, seed, features)
    return model.transform(df), model


def kmeans_sweep(df: DataFrame, ks=range(2, 11), seed: int = 42,
                 features: str = "features", parallelism: int = FITS_AT_ONCE) -> DataFrame:
    """(k, inertia, silhouette_sq) per K (M4, M5). Silhouette is Spark's linear
    squared-Euclidean form (T16). Only these numbers reach the driver;
    ``best`` marks the arg-max silhouette. Fits are chains of jobs that wait on
    the driver, so several run at once. The frame is not cached here: each fit
    then keeps its own vectors ready, where from a cached frame it would decode
    every row again in every iteration."""
    data = df.select(features)
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="cluster",
                             distanceMeasure="squaredEuclidean")

    def fit(k: int) -> tuple[int, float, float]:
        model = kmeans_fit(data, k, seed, features)
        return int(k), float(model.summary.trainingCost), float(ev.evaluate(model.transform(data)))

    with ThreadPoolExecutor(parallelism) as pool:  # the largest K takes longest
        rows = sorted(pool.map(fit, sorted(ks, reverse=True)))
    best = max(rows, key=lambda r: r[2])[0] if rows else None
    spark = df.sparkSession
    out = spark.createDataFrame(rows, "k int, inertia double, silhouette_sq double")
    return out.withColumn("best", F.col("k") == F.lit(best))


def sampled_silhouette(df: DataFrame, key: str, features: str = "features", cluster: str = "cluster",
                       per_cluster: int = 200, seed: int = 42) -> DataFrame:
    """Euclidean silhouette (the opt-in mode of T16): up to ``per_cluster``
    points of every cluster, in seeded order of ``key``, against all points.
    A task adds up the distances of the sample to each cluster's points in its
    batches, so the work is sample times rows and one row a sampled point and
    cluster comes back.

    -> (silhouette, std_error, n_sampled): mean over clusters weighted by size,
    and its standard error from the spread within clusters (0 where every
    point was sampled). One row; null with fewer than two clusters."""
    rows = df.select(F.col(key).alias("_k"), vector_to_array(features).alias("_x"),
                     F.col(cluster).cast("int").alias("_c"))
    w = Window.partitionBy("_c").orderBy(shuffle_key("_k", seed), "_k")
    sample = (rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_cluster)
              .select("_c", "_x").collect())  # at most per_cluster rows a cluster
    spark = df.sparkSession
    schema = "silhouette double, std_error double, n_sampled int"
    sizes = {r["_c"]: r["n"] for r in rows.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return spark.createDataFrame([(None, None, len(sample))], schema)
    points = np.array([r["_x"] for r in sample])
    own = np.array([r["_c"] for r in sample])

    def distances(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            x = np.array(b.column(0).flatten()).reshape(b.num_rows, points.shape[1])
            c = b.column(1).to_numpy()
            for at in range(0, len(x), 1024):
                part, of = x[at:at + 1024], c[at:at + 1024]
                far = np.sqrt(((points[:, None, :] - part[None, :, :]) ** 2).sum(axis=2))
                for k in np.unique(of):
                    total[int(k)] = total.get(int(k), 0.0) + far[:, of == k].sum(axis=1)
        for k, sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(points), dtype=np.int32)), pa.array(np.full(len(points), k, np.int32)),
                 pa.array(sums)], names=["i", "c", "far"])

    got = rows.select("_x", "_c").mapInArrow(distances, "i int, c int, far double") \
        .groupBy("i", "c").agg(F.sum("far").alias("far")).collect()
    sums = {(r["i"], r["c"]): r["far"] for r in got}
    value = np.zeros(len(points))
    for i, c in enumerate(own):
        if sizes[c] > 1:
            a = sums[i, c] / (sizes[c] - 1)
            b = min(sums[i, k] / n for k, n in sizes.items() if k != c)
            value[i] = (b - a) / max(a, b) if max(a, b) else 0.0
    n, mean, var = sum(sizes.values()), 0.0, 0.0
    for c, size in sizes.items():
        of = value[own == c]
        mean += size / n * of.mean()
        if 1 < len(of) < size:
            var += (size / n) ** 2 * of.var(ddof=1) / len(of) * (1 - len(of) / size)
    return spark.createDataFrame([(float(mean), float(math.sqrt(var)), len(sample))], schema)


# -------------------------------------------------------------------- M6 --
def pca_project(df: DataFrame, k: int = 2, features: str = "features"):
    """PCA scores with a deterministic sign (largest-|loading| entry of each
    component made positive) and the explained-variance ratios."""
    model = PCA(k=k, inputCol=features, outputCol="_pca").fit(df)
    comps = model.pc.toArray()          # d x k, model-sized
    signs = []
    for j in range(k):
        col = comps[:, j]
        i = int(abs(col).argmax())
        signs.append(-1.0 if col[i] < 0 else 1.0)
    arr = vector_to_array(F.col("_pca"))
    out = model.transform(df).withColumns(
        {f"pc{j + 1}": arr[j] * F.lit(signs[j]) for j in range(k)}).drop("_pca")
    ratios = [float(x) for x in model.explainedVariance.toArray()]
    return out, ratios


# -------------------------------------------------------------------- M8 --
def shuffle_key(id_col: str, seed: int):
    """A seeded pseudo-random order that every SQL engine can compute."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def exact_split(df: DataFrame, id_col: str, fraction: float = 0.2, seed: int = 42,
                out: str = "is_test") -> DataFrame:
    """Exact, reproducible split: the ``ceil(fraction * n)`` rows with the
    smallest ``(md5(id:seed), id)`` are the test rows (sklearn's exact test
    size, T26). The k-th smallest key is found without a global sort: counts
    per four-digit hash prefix (<= 65,536 small rows) locate the prefix, and
    only that bucket is ordered."""
    keyed = df.withColumn("_h", shuffle_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, 4))
    n = keyed.count()
    k = math.ceil(fraction * n)
    if k == 0:
        return keyed.withColumn(out, F.lit(False)).drop("_h", "_b")
    counts = sorted((r["_b"], r["cnt"]) for r in
                    keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("cnt")).collect())
    acc = 0
    for b, c in counts:
        if acc + c >= k:
            need = k - acc
            break
        acc += c
    last = (keyed.filter(F.col("_b") == b).orderBy("_h", id_col)
                 .select("_h", id_col).limit(need).orderBy(F.col("_h").desc(),
                                                          F.col(id_col).desc()).first())
    th, tid = last["_h"], last[id_col]
    is_test = (F.col("_h") < F.lit(th)) | ((F.col("_h") == F.lit(th)) & (F.col(id_col) <= F.lit(tid)))
    return keyed.withColumn(out, is_test).drop("_h", "_b")


def fold_ids(df: DataFrame, id_col: str, folds: int = 5, seed: int = 42,
             out: str = "fold") -> DataFrame:
    """Deterministic folds of equal size (to one row): the rank in the seeded
    order modulo ``folds`` (M14)."""
    ordered = df.withColumn("_h", shuffle_key(id_col, seed + 1)).orderBy("_h", id_col)
    return numbered(ordered, "_pos").withColumn(
        out, ((F.col("_pos") - 1) % folds).cast("int")).drop("_h", "_pos")


# ---------------------------------------------------------- M9 - M17 --
def scaler_pipeline(features: list[str]) -> Pipeline:
    """Assembler and scaler, fitted on training rows only."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)])


# ----------------------------------------------- M10, M11: boosting runs --
# Rounds without gain after which boosting stops.
PATIENCE = 10


@dataclass(frozen=True)
class GbtParams:
    """One point of the boosted-tree grid (the reference's values are the
    defaults of ``reference_grid``)."""
    max_iter: int = 100
    max_depth: int = 3
    step_size: float = 0.1
    subsampling: float = 0.8


def reference_grid() -> list[GbtParams]:
    """All 54 points of the reference's search."""
    return [GbtParams(n, d, r, s) for n in (100, 200, 300) for d in (3, 5, 7)
            for r in (0.01, 0.05, 0.1) for s in (0.8, 1.0)]


def stop_at(losses: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(trees of the best model, whether boosting stopped): the run ends when
    ``patience`` rounds in a row bring no smaller loss than the best so far."""
    return boosting.stop_at(losses, patience)


def _gbt(p: GbtParams, trees: int, label: str) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                        lossType="squared", seed=42, maxIter=trees, maxDepth=p.max_depth,
                        stepSize=p.step_size, subsamplingRate=p.subsampling)


def cut_model(model: GBTRegressionModel, trees: int) -> GBTRegressionModel:
    """The boosted model of the first ``trees`` trees."""
    sc = SparkContext._active_spark_context
    jvm, own = sc._jvm, model._java_obj
    cls = jvm.org.apache.spark.ml.regression
    kept = sc._gateway.new_array(cls.DecisionTreeRegressionModel, trees)
    weights = sc._gateway.new_array(jvm.double, trees)
    for i, (tree, weight) in enumerate(zip(own.trees()[:trees], own.treeWeights()[:trees])):
        kept[i], weights[i] = tree, weight
    java = cls.GBTRegressionModel(f"{own.uid()}_{trees}", kept, weights)
    java.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())
    return GBTRegressionModel(java)


def boosted_run(train: DataFrame, valid: DataFrame, label: str, p: GbtParams,
                patience: int = PATIENCE, first: int = 0) -> tuple[GBTRegressionModel, list[float]]:
    """A boosted model of up to ``p.max_iter`` trees that covers its own early
    stop, and its mean squared error on ``valid`` after every tree.

    The trees are the same however many are asked for, so a run that does not
    stop within a first guess of its length (``first``, or from the rate) is
    fitted anew at twice that."""
    trees = min(p.max_iter, first or patience + math.ceil(0.5 / p.step_size))
    while True:
        model = _gbt(p, trees, label).fit(train)
        losses = model.evaluateEachIteration(valid, "squared")
        if trees == p.max_iter or stop_at(losses, patience)[1]:
            return model, losses
        trees = min(p.max_iter, 2 * trees)


def early_stopped(train: DataFrame, valid: DataFrame, label: str, p: GbtParams,
                  patience: int = PATIENCE, first: int = 0) -> tuple[GBTRegressionModel, list[float], int]:
    """(model cut to its best iteration, losses up to the stop, best).

    Rows that fit one task are fitted there (the same trees without the jobs);
    more are fitted by Spark."""
    if boosting.fit_a_task(train, valid):
        return _in_tasks([boosting.Fold(train, valid)], label, p, patience)[0]
    model, losses = boosted_run(train, valid, label, p, patience, first)
    best, stopped = stop_at(losses, patience)
    return cut_model(model, best), losses[:best + patience] if stopped else losses, best


def _in_tasks(folds: list[boosting.Fold], label: str, p: GbtParams, patience: int) -> list[tuple]:
    job = boosting.Job(0, p.max_depth, p.step_size, p.subsampling, p.max_iter, patience)
    fits = boosting.fit_many(folds, label, [job._replace(fold=i) for i in range(len(folds))])
    best = [stop_at(fit.losses, patience)[0] for fit in fits]
    return [(boosting.to_model(fit.nodes, _gbt(p, n, label)), fit.losses, n) for fit, n in zip(fits, best)]


def early_stopped_folds(data: list[dict], label: str, p: GbtParams,
                        patience: int = PATIENCE) -> list[GBTRegressionModel]:
    """The early-stopped model of every fold of ``scaled_folds``."""
    if data and boosting.fit_a_task(data[0]["rows"]):
        folds = [boosting.Fold(d["train"], d["valid"]) for d in data]
        return [model for model, _, _ in _in_tasks(folds, label, p, patience)]
    with ThreadPoolExecutor(len(data)) as pool:
        return list(pool.map(lambda d: early_stopped(d["train"], d["valid"], label, p, patience)[0], data))


def scaled_folds(df: DataFrame, features: list[str], label: str, folds: int) -> list[dict]:
    """Vectors of each fold's training rows (without a slice for validation),
    validation rows and test rows; scaling is fitted on the training rows.
    ``df`` has a column ``fold``; the fold after a test fold validates."""
    out = []
    for f in range(folds):
        train = (F.col("fold") != f) & (F.col("fold") != (f + 1) % folds)
        scaler = scaler_pipeline(features).fit(df.filter(train))
        rows = scaler.transform(df).select("features", label, "fold").cache()
        out.append({"train": rows.filter(train), "rows": rows,
                    "valid": rows.filter(F.col("fold") == (f + 1) % folds),
                    "test": rows.filter(F.col("fold") == f)})
    return out


def staged_grid(df: DataFrame, features: list[str], label: str, grid: list[GbtParams],
                folds: int = 5, patience: int = PATIENCE, parallelism: int = FITS_AT_ONCE) -> DataFrame:
    """Cross-validated search over ``grid`` by mean absolute error, with early
    stopping in every fit (M10, M11). A boosted model contains those of fewer
    trees, so points that differ in ``max_iter`` only share one fit a fold,
    and each is scored at its own best iteration. ``df`` has a column ``fold``.
    Folds that fit one task are fitted side by side, a fit a task; larger ones
    by Spark's jobs.

    -> one row a point: parameters, cv_mae, cv_std (over the folds),
    best_trees (mean), rank (ties: fewer trees, then smaller parameters)."""
    longest: dict[GbtParams, int] = {}
    for p in grid:
        key = replace(p, max_iter=0)
        longest[key] = max(longest.get(key, 0), p.max_iter)
    data = scaled_folds(df, features, label, folds)

    # Long fits first, so that none is left over at the end.
    jobs = sorted(((key, f) for key in longest for f in range(folds)),
                  key=lambda j: -longest[j[0]] * j[0].max_depth / j[0].step_size)

    def scored(key: GbtParams, losses: list[float], maes: list[float]) -> dict[GbtParams, tuple[float, int]]:
        out = {}
        for p in grid:
            if replace(p, max_iter=0) == key:
                best = stop_at(losses[:p.max_iter], patience)[0]
                out[p] = maes[best - 1], best
        return out

    def run(job: tuple[GbtParams, int]) -> dict[GbtParams, tuple[float, int]]:
        key, f = job
        model, losses = boosted_run(data[f]["train"], data[f]["valid"], label,
                                    replace(key, max_iter=longest[key]), patience)
        return scored(key, losses, model.evaluateEachIteration(data[f]["test"], "absolute"))

    if jobs and boosting.fit_a_task(data[0]["rows"]):
        fits = boosting.fit_many([boosting.Fold(d["train"], d["valid"], d["test"]) for d in data], label, [
            boosting.Job(f, key.max_depth, key.step_size, key.subsampling, longest[key], patience)
            for key, f in jobs])
        done = [scored(key, fit.losses, fit.maes) for (key, _), fit in zip(jobs, fits)]
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            done = list(pool.map(run, jobs))
    for d in data:
        d["rows"].unpersist()
    rows = []
    for p in grid:
        got = [d[p] for d in done if p in d]
        mean = sum(m for m, _ in got) / folds
        rows.append((p.max_iter, p.max_depth, p.step_size, p.subsampling, mean,
                     math.sqrt(sum((m - mean) ** 2 for m, _ in got) / folds),
                     sum(b for _, b in got) / folds))
    rows.sort(key=lambda r: (r[4], *r[:4]))
    return df.sparkSession.createDataFrame(
        [(*r, i + 1) for i, r in enumerate(rows)],
        "max_iter int, max_depth int, step_size double, subsampling double, cv_mae double, "
        "cv_std double, best_trees double, rank int")


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: n, MAE, R^2 (1 - SS_res / SS_tot, not squared correlation),
    min and max of the label (M12, M13, A20)."""
    y, p = F.col(label), F.col(prediction)
    a = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - p)).alias("mae"),
                 F.sum((y - p) * (y - p)).alias("_ssr"), F.avg(y).alias("_my"),
                 F.var_pop(y).alias("_vy"), F.min(y).alias("y_min"), F.max(y).alias("y_max"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_ssr"), F.col("_vy") * F.col("n"))
    return a.select("n", "mae", r2.alias("r2"), "y_min", "y_max")


def sized_for_fits(df: DataFrame, key: str, rows_per_task: int = 20_000) -> DataFrame:
    """``df`` dealt by ``key`` into partitions of about ``rows_per_task`` rows:
    a fit is a chain of jobs over them, so neither empty tasks nor one task for
    everything will do."""
    return df.repartition(max(1, -(-df.count() // rows_per_task)), key)


def feature_importances(model, names: list[str]) -> DataFrame:
    """(feature, importance, rank) from a fitted tree model."""
    spark = SparkSession.getActiveSession()
    imp = [float(x) for x in model.featureImportances.toArray()]
    rows = sorted(zip(names, imp), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame([(n, v, i + 1) for i, (n, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")
