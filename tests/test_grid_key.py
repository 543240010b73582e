"""A search over other points is not answered by an earlier one's result."""

from statweave.operators import ml
from statweave.plans import q_ml

SF = "/root/testdata/sf0.001"


def test_grid_is_staged_by_its_points(spark, monkeypatch):
    monkeypatch.setattr(ml, "staged_grid", lambda df, feats, label, grid, folds: spark.range(len(grid)))
    for n in (7, 3, 7):
        monkeypatch.setattr(ml, "reference_grid", lambda: [ml.GbtParams(50 + i) for i in range(n)])
        assert q_ml.grid_once(spark, SF).count() == n
