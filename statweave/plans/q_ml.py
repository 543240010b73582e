"""Segmentation and value-estimation queries (stage-3/4 analogues, M1-M19).

Entity features are the customer measures; segmentation imputes (mean for
rates, 0 for counts), z-scores, sweeps K, clusters and projects; valuation
learns ``spend`` from the other measures plus the one-hot segment with
boosted trees (grid search and CV inside Spark ML)."""

from __future__ import annotations

import functools
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ml, rank, schema
from ..operators.aggregate import crosstab
from ..session import cut_lineage, scratch_path
from ..sources import files
from ..sources.tables import read_table
from ..specs import MEAN_IMPUTED, MIN_MODEL_ROWS, STATS, ZERO_IMPUTED
from . import q_match
from .entity import CS_SQL, entity_stats_once, once
from .registry import query, rnd, round_doubles

K_FINAL = 4
FOLDS = 5


def imputed(spark, sf_dir):
    """Entity frame written once to the shared folder (the fits below make
    several passes over it), then mean/zero imputation."""
    cs = entity_stats_once(spark, sf_dir)
    cs = cs.withColumns({c: F.col(c).cast("double") for c in STATS})
    return ml.impute(cs, MEAN_IMPUTED, ZERO_IMPUTED)


def scaled(spark, sf_dir):
    return ml.zscore(imputed(spark, sf_dir), STATS, population=True)


def features(spark, sf_dir):
    """Scaled measures assembled into one vector column, written once a
    session: K sweeps, K-means and PCA all iterate over this frame."""
    return once(spark, sf_dir, "features", lambda: cut_lineage(
        ml.sized_for_fits(ml.assemble(scaled(spark, sf_dir), STATS), "c_custkey")))


def _impute_sql() -> str:
    cols = []
    for s in STATS:
        if s in MEAN_IMPUTED:
            cols.append(f"round(coalesce(CAST({s} AS DOUBLE), (SELECT avg({s}) FROM cs)), 6) AS {s}")
        else:
            cols.append(f"round(coalesce(CAST({s} AS DOUBLE), 0.0), 6) AS {s}")
    return ", ".join(cols)


@query("impute", "M1 A19 T19", sql=f"""
WITH {CS_SQL} SELECT c_custkey, {_impute_sql()} FROM cs
""")
def impute_q(spark, sf_dir):
    return round_doubles(imputed(spark, sf_dir).select("c_custkey", *STATS))


def _zscore_sql() -> str:
    imp = ", ".join(
        f"coalesce(CAST({s} AS DOUBLE), (SELECT avg({s}) FROM cs)) AS {s}" if s in MEAN_IMPUTED
        else f"coalesce(CAST({s} AS DOUBLE), 0.0) AS {s}" for s in STATS)
    z = ", ".join(
        f"round(CASE WHEN {s} IS NULL THEN NULL WHEN stddev_pop({s}) OVER () = 0 THEN 0.0 "
        f"ELSE ({s} - avg({s}) OVER ()) / stddev_pop({s}) OVER () END, 6) AS {s}" for s in STATS)
    return f"WITH {CS_SQL}, im AS (SELECT c_custkey, {imp} FROM cs) SELECT c_custkey, {z} FROM im"


@query("zscore", "M2 T14", sql=_zscore_sql())
def zscore_q(spark, sf_dir):
    return round_doubles(scaled(spark, sf_dir).select("c_custkey", *STATS))


def clustered(spark, sf_dir, k: int = K_FINAL):
    """(rows with their cluster, model): one fit a session serves the
    profile, the exemplars, the cross-tab and the projection."""
    def build():
        out, model = ml.kmeans_assign(features(spark, sf_dir), k, seed=42)
        return cut_lineage(out), model
    return once(spark, sf_dir, f"clusters-{k}", build)


@query("kmeans_sweep", "M4 M5 M19 T16 T17")
def kmeans_sweep_q(spark, sf_dir):
    return ml.kmeans_sweep(features(spark, sf_dir), range(2, 11), seed=42)


@query("silhouette_sampled", "M5 T16")
def silhouette_sampled_q(spark, sf_dir):
    """Euclidean silhouette of the final clusters from a stratified sample
    against all points, with its standard error."""
    out, _ = clustered(spark, sf_dir)
    return round_doubles(ml.sampled_silhouette(out, "c_custkey"))


@query("kmeans_assign", "M3 M7")
def kmeans_assign_q(spark, sf_dir):
    out, _ = clustered(spark, sf_dir)
    return out.select("c_custkey", "c_name", "grp", "seg", "cluster")


@query("cluster_profile", "A13")
def cluster_profile_q(spark, sf_dir):
    out, _ = clustered(spark, sf_dir)
    raw = imputed(spark, sf_dir).select("c_custkey", *STATS)
    j = out.select("c_custkey", "cluster").join(raw, "c_custkey")
    return round_doubles(j.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(s).alias(s) for s in STATS]))


@query("cluster_exemplars", "W2")
def cluster_exemplars_q(spark, sf_dir):
    out, _ = clustered(spark, sf_dir)
    raw = entity_stats_once(spark, sf_dir).select("c_custkey", "spend")
    j = out.select("c_custkey", "c_name", "cluster").join(raw, "c_custkey")
    top = rank.top_k(j, 1, ["cluster"], "spend", ["c_name", "c_custkey"])
    return round_doubles(top.select("cluster", "c_custkey", "c_name", "spend"))


@query("cluster_crosstab", "A14 T10")
def cluster_crosstab_q(spark, sf_dir):
    out, _ = clustered(spark, sf_dir)
    levels = schema.category_levels(out, "seg")
    return crosstab(out, "cluster", "seg", levels)


@query("pca_project", "M6 M19")
def pca_project_q(spark, sf_dir):
    out, model = clustered(spark, sf_dir)
    proj, ratios = ml.pca_project(out, 2)
    return round_doubles(proj.select("c_custkey", "cluster", "pc1", "pc2",
                                     F.lit(ratios[0]).alias("ratio1"),
                                     F.lit(ratios[1]).alias("ratio2")))


def _distance(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, x: acc + x)


@query("kmeans_check", "M3 M7", sql="""
SELECT count(*) AS n, CAST(4 AS BIGINT) AS n_clusters, TRUE AS all_nearest FROM customer
""")
def kmeans_check_q(spark, sf_dir):
    """Facts of the clustering: every point is in a cluster, and no other
    centre is nearer than its own (distances recomputed in SQL)."""
    out, model = clustered(spark, sf_dir)
    centres = F.lit([[float(x) for x in c] for c in model.clusterCenters()])
    x = vector_to_array("features")
    d = F.transform(centres, lambda c: _distance(x, c))
    own = F.get(d, F.col("cluster"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cluster").alias("n_clusters"),
                   F.bool_and(own <= F.array_min(d) + 1e-9).alias("all_nearest"))


@query("pca_check", "M6", sql="""
SELECT count(*) AS n, TRUE AS ratios_hold, TRUE AS uncorrelated, TRUE AS descending FROM customer
""")
def pca_check_q(spark, sf_dir):
    """Facts of the projection: a component's share of the total variance is
    its reported ratio, components are uncorrelated and in falling order."""
    f = features(spark, sf_dir)
    proj, ratios = ml.pca_project(f, 2)
    arr = vector_to_array("features")
    total = sum((F.var_samp(arr[i]) for i in range(len(STATS))), F.lit(0.0))
    a = proj.agg(F.count(F.lit(1)).alias("n"), F.var_samp("pc1").alias("v1"),
                 F.var_samp("pc2").alias("v2"), F.corr("pc1", "pc2").alias("c"), total.alias("v"))
    close = (F.abs(F.col("v1") / F.col("v") - ratios[0]) < 1e-6) & (
        F.abs(F.col("v2") / F.col("v") - ratios[1]) < 1e-6)
    return a.select("n", close.alias("ratios_hold"), (F.abs("c") < 1e-6).alias("uncorrelated"),
                    (F.col("v1") >= F.col("v2")).alias("descending"))


@query("embedding_pca", "M6")
def embedding_pca_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    proj, ratios = ml.pca_project(ml.array_features(e, "embedding"), 2)
    return round_doubles(proj.select("vec_id", "label", "pc1", "pc2",
                                     F.lit(ratios[0]).alias("ratio1"),
                                     F.lit(ratios[1]).alias("ratio2")))


@query("embedding_kmeans", "M3 M5")
def embedding_kmeans_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    out, _ = ml.kmeans_assign(ml.array_features(e, "embedding"), K_FINAL, seed=42)
    return out.select("vec_id", "label", "cluster")


# ------------------------------------------------------------ valuation --
def value_frame(spark, sf_dir):
    """Measures with missing values as 0 (nothing is fitted here, so nothing
    leaks from the test rows), segment and group one-hot, test rows and folds
    marked -> (frame, feature names). Written once a session."""
    return once(spark, sf_dir, "value", lambda: _value_frame(spark, sf_dir))


def _value_frame(spark, sf_dir):
    cs = entity_stats_once(spark, sf_dir)
    cs = cs.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in STATS})
    oh = schema.one_hot(schema.one_hot(cs.withColumn("group", F.col("grp")), "seg", prefix="seg"),
                        "group", prefix="group")
    level_cols = [c for c in oh.columns if c.startswith(("seg_", "group_"))]
    oh = oh.withColumns({c: F.col(c).cast("double") for c in level_cols})
    feats = ["n_orders", "n_items", "qty", "avg_disc", "avg_tax", "acctbal", *level_cols]
    split = ml.fold_ids(ml.exact_split(oh, "c_custkey", 0.2, 42), "c_custkey", FOLDS)
    return cut_lineage(ml.sized_for_fits(split, "c_custkey")), feats


@query("train_test_split", "M8 T26", sql="""
SELECT c_custkey, row_number() OVER (ORDER BY md5(c_custkey || ':42'), c_custkey)
                  <= (SELECT ceil(0.2 * count(*)) FROM customer) AS is_test FROM customer
""")
def train_test_split_q(spark, sf_dir):
    df, _ = value_frame(spark, sf_dir)
    return df.select("c_custkey", "is_test")


@query("cv_folds", "M14", sql="""
SELECT c_custkey, CAST((row_number() OVER (ORDER BY md5(c_custkey || ':43'), c_custkey) - 1) % 5
                       AS INTEGER) AS fold FROM customer
""")
def cv_folds_q(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    return ml.fold_ids(c, "c_custkey", 5, 42)


def grid_once(spark, sf_dir):
    """The whole parameter search on the training rows, once a session and
    list of points."""
    grid = ml.reference_grid()

    def build():
        df, feats = value_frame(spark, sf_dir)
        train = _training(df)
        return cut_lineage(ml.staged_grid(train, feats, "spend", grid, FOLDS))
    return once(spark, sf_dir, f"grid {grid}", build)


def best_params(spark, sf_dir) -> ml.GbtParams:
    r = grid_once(spark, sf_dir).filter("rank = 1").first()
    return ml.GbtParams(r.max_iter, r.max_depth, r.step_size, r.subsampling)


def _training(df):
    train = df.filter(~F.col("is_test"))
    if train.limit(MIN_MODEL_ROWS).count() < MIN_MODEL_ROWS:
        raise ValueError("insufficient_data: fewer than 10 training rows")
    return train


def fitted(spark, sf_dir):
    """(rows with a prediction, feature names, model, losses, parameters) of
    the best point of the grid, fitted with early stopping on a validation
    slice of the training rows, not on the test rows (T24)."""
    def build():
        df, feats = value_frame(spark, sf_dir)
        train, p = _training(df), best_params(spark, sf_dir)
        rows = ml.scaler_pipeline(feats).fit(train.filter("fold <> 0")).transform(df).cache()
        train = rows.filter(~F.col("is_test"))
        model, losses, best = ml.early_stopped(train.filter("fold <> 0"), train.filter("fold = 0"),
                                               "spend", p)
        out = cut_lineage(model.transform(rows).drop("_raw", "features"))
        rows.unpersist()
        return out, feats, model, losses, replace(p, max_iter=best)
    return once(spark, sf_dir, f"fitted {ml.reference_grid()}", build)


def gbt_fit(spark, sf_dir):
    """Predictions of one fit at fixed parameters (the bench times this; the
    queries below take their parameters from the whole search)."""
    df, feats = value_frame(spark, sf_dir)
    train = _training(df)
    rows = ml.scaler_pipeline(feats).fit(train.filter("fold <> 0")).transform(df)
    part = cut_lineage(rows.filter(~F.col("is_test")).select("features", "spend", "fold"))
    model, _, _ = ml.early_stopped(part.filter("fold <> 0"), part.filter("fold = 0"), "spend",
                                   ml.GbtParams(50, 3, 0.1, 0.8), first=50)
    return round_doubles(model.transform(rows).select("c_custkey", "is_test", "spend", "prediction"))


@query("gbt_predict", "M9 M10 M17")
def gbt_predict_q(spark, sf_dir):
    return round_doubles(fitted(spark, sf_dir)[0].select("c_custkey", "is_test", "spend", "prediction"))


@query("gbt_early_stop", "M10")
def gbt_early_stop_q(spark, sf_dir):
    """Validation loss after every tree of the final fit until ten rounds
    brought no gain, and the iteration whose trees are kept."""
    _, _, _, losses, p = fitted(spark, sf_dir)
    rows = [(i, x, i == p.max_iter) for i, x in enumerate(losses, 1)]
    return round_doubles(spark.createDataFrame(rows, "iteration int, loss double, best boolean"))


@query("residuals", "M18 A20", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice AS y, round(l_quantity * 950.0, 6) AS p,
       round(l_extendedprice - l_quantity * 950.0, 6) AS residual FROM lineitem
""")
def residuals_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice",
                                               "l_quantity"])
    p = F.col("l_quantity") * 950.0
    return li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("y"),
                     rnd(p).alias("p"), rnd(F.col("l_extendedprice") - p).alias("residual"))


@query("regression_metrics", "M12 M13 M15 A20", sql="""
WITH t AS (SELECT l_extendedprice AS y, l_quantity * 950.0 AS p FROM lineitem)
SELECT count(*) AS n, round(avg(abs(y - p)), 6) AS mae,
       round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
       min(y) AS y_min, max(y) AS y_max FROM t
""")
def regression_metrics_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_extendedprice", "l_quantity"])
    t = li.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 950.0).alias("p"))
    return round_doubles(ml.regression_metrics(t, "y", "p"))


@query("model_metrics", "M12 M13 M15")
def model_metrics_q(spark, sf_dir):
    pred = fitted(spark, sf_dir)[0]
    tr = ml.regression_metrics(pred.filter(~F.col("is_test")), "spend").withColumn("slice", F.lit("train"))
    te = ml.regression_metrics(pred.filter(F.col("is_test")), "spend").withColumn("slice", F.lit("test"))
    return round_doubles(tr.unionByName(te))


@query("feature_importance", "M16 W3 O2")
def feature_importance_q(spark, sf_dir):
    _, feats, model, _, _ = fitted(spark, sf_dir)
    return ml.feature_importances(model, feats)


@query("valuation_check", "M9 M16 M17", sql="""
SELECT count(*) AS n, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_test, TRUE AS importances_sum_to_one,
       TRUE AS better_than_the_mean FROM customer
""")
def valuation_check_q(spark, sf_dir):
    """Facts of the fitted trees: every row is predicted, importances sum to
    one, and the test error is below that of predicting the training mean."""
    p, feats, model, _, _ = fitted(spark, sf_dir)
    mean = p.filter(~F.col("is_test")).agg(F.avg("spend")).first()[0]
    total = ml.feature_importances(model, feats).agg(F.sum("importance")).first()[0]
    err = F.when(F.col("is_test"), F.abs(F.col("spend") - F.col("prediction")))
    base = F.when(F.col("is_test"), F.abs(F.col("spend") - F.lit(mean)))
    return p.agg(F.count("prediction").alias("n"), F.count_if("is_test").alias("n_test"),
                 F.lit(abs(total - 1) < 1e-9).alias("importances_sum_to_one"),
                 (F.avg(err) < F.avg(base)).alias("better_than_the_mean"))


@query("gbt_grid", "M11")
def gbt_grid_q(spark, sf_dir):
    """All 54 points of the search with their cross-validated error."""
    return round_doubles(grid_once(spark, sf_dir))


def cv_once(spark, sf_dir):
    """Out-of-fold predictions of the best point over all rows: in each fold
    the fit stops early on the fold after it."""
    def build():
        df, feats = value_frame(spark, sf_dir)
        p = best_params(spark, sf_dir)
        folds = ml.scaled_folds(df, feats, "spend", FOLDS)
        models = ml.early_stopped_folds(folds, "spend", p)
        out = [model.transform(d["test"]).select("fold", "spend", "prediction")
               for model, d in zip(models, folds)]
        every = cut_lineage(functools.reduce(DataFrame.unionByName, out))
        for d in folds:
            d["rows"].unpersist()
        return every
    return once(spark, sf_dir, f"cv {ml.reference_grid()}", build)


def _fold_mae(pred):
    return pred.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("spend") - F.col("prediction"))).alias("mae"),
        (1 - F.try_divide(F.sum(F.pow(F.col("spend") - F.col("prediction"), 2)),
                          F.var_pop("spend") * F.count(F.lit(1)))).alias("r2"))


@query("cv_mae", "M14")
def cv_mae_q(spark, sf_dir):
    """5-fold CV of the chosen parameters on all rows: MAE per fold plus
    mean and population std across folds (as the reference reports)."""
    w = Window.partitionBy(F.lit(1))  # one row a fold
    out = _fold_mae(cv_once(spark, sf_dir)).withColumns(
        {"mae_mean": F.avg("mae").over(w), "mae_std": F.stddev_pop("mae").over(w)})
    return round_doubles(out.select("fold", "n", "mae", "r2", "mae_mean", "mae_std"))


def report_row(spark, sf_dir):
    """One row: size of the data and of the match, best parameters, errors on
    both slices, cross-validated error (M15)."""
    pred, _, _, _, p = fitted(spark, sf_dir)
    best = grid_once(spark, sf_dir).filter("rank = 1").select(
        "max_iter", "max_depth", "step_size", "subsampling", "cv_mae")

    def metrics(rows, name):
        return ml.regression_metrics(rows, "spend").select(
            F.col("n").alias(f"n_{name}"), F.col("mae").alias(f"mae_{name}"), F.col("r2").alias(f"r2_{name}"))

    folds = _fold_mae(cv_once(spark, sf_dir)).agg(
        F.avg("mae").alias("cv_mean"), F.stddev_pop("mae").alias("cv_std"))
    pairs = q_match.assigned(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_matched"))
    names = q_match.lefts(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_names"))
    out = (metrics(pred.filter(~F.col("is_test")), "train"), metrics(pred.filter("is_test"), "test"),
           best.withColumnRenamed("cv_mae", "grid_mae"), folds, pairs, names)
    row = {k: v for df in out for k, v in df.first().asDict().items()}  # one row each
    row["trees"] = p.max_iter
    row["n_unmatched"] = row.pop("n_names") - row["n_matched"]
    return spark.createDataFrame([tuple(row[c] for c in REPORT_COLUMNS)],
                                 ", ".join(f"{c} {t}" for c, t in REPORT_COLUMNS.items()))


REPORT_COLUMNS = {
    "n_train": "long", "n_test": "long", "n_matched": "long", "n_unmatched": "long",
    "max_iter": "int", "max_depth": "int", "step_size": "double", "subsampling": "double",
    "trees": "int", "grid_mae": "double", "mae_train": "double", "r2_train": "double",
    "mae_test": "double", "r2_test": "double", "cv_mean": "double", "cv_std": "double"}


@query("valuation_report", "M15 S9")
def valuation_report_q(spark, sf_dir):
    return round_doubles(report_row(spark, sf_dir))


@query("valuation_report_text", "S9 M15 X10")
def valuation_report_text_q(spark, sf_dir):
    """The report as numbered Markdown lines, written by the text sink and
    read back."""
    path = files.write_markdown_report(report_row(spark, sf_dir), scratch_path(spark, "valuation-report"),
                                       "Value estimation")
    lines = spark.read.text(path)
    return lines.select(F.col("value").alias("line"))


@query("valuation_counts", "M8 M15 J8 J9", sql=f"""
WITH RECURSIVE {q_match.ASSIGN_SQL}
SELECT (SELECT count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) FROM customer) AS n_train,
       (SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) FROM customer) AS n_test,
       (SELECT count(*) FROM assigned) AS n_matched,
       (SELECT count(*) FROM l) - (SELECT count(*) FROM assigned) AS n_unmatched
""")
def valuation_counts_q(spark, sf_dir):
    """The counts of the report, from the split and the match."""
    split = value_frame(spark, sf_dir)[0].select(
        (~F.col("is_test")).alias("n_train"), F.col("is_test").alias("n_test"))
    names = q_match.lefts(spark, sf_dir).join(q_match.assigned(spark, sf_dir), "lid", "left").select(
        F.col("score").isNotNull().alias("n_matched"), F.col("score").isNull().alias("n_unmatched"))
    both = split.unionByName(names, allowMissingColumns=True)
    return both.agg(*[F.count_if(c).alias(c) for c in both.columns])
