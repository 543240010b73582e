"""Plan checks: no cartesian products or row-at-a-time Python,
pruned scans, partial top-k limits."""

import pytest

from statweave.plans import registry

registry.load_all()

SF = "/root/testdata/sf0.001"
# queries whose construction fits models or iterates (checked in test_ml / test_match)
ITERATIVE = {"kmeans_sweep", "kmeans_assign", "cluster_profile", "cluster_exemplars",
             "cluster_crosstab", "pca_project", "embedding_pca", "embedding_kmeans",
             "train_test_split", "gbt_predict", "gbt_grid", "cv_mae", "feature_importance",
             "model_metrics", "fuzzy_assign", "unmatched_entities", "near_misses", "report_text",
             "csv_roundtrip", "kmeans_check", "pca_check", "valuation_check"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - ITERATIVE))
def test_no_cartesian_or_row_python(spark, name):
    p = _plan(registry.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p                 # no row-at-a-time Python UDF
    if "MapInPandas" in p or "ArrowEvalPython" in p:
        assert name in {"html_table_extract", "page_extract_status"}


def test_top_k_partial_limit(spark):
    p = _plan(registry.QUERIES["top_k_per_stat"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_pruning(spark):
    from statweave.plans.entity import entity_stats
    p = _plan(entity_stats(spark, SF))
    li = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double,l_tax:double>" in li


def test_multiset_diff_scans_once(spark):
    p = _plan(registry.QUERIES["multiset_diff"](spark, SF))
    assert p.count("orders.parquet") == 1 and "SortAggregate" not in p
