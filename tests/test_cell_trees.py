"""Forests and boosted trees grown from cells in tasks of their own, and stacking on written scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_cells import FEATS, _rows

from rarefy.operators import cell_trees as CT
from rarefy.operators import cells as CE
from rarefy.operators import ensemble_fit as EF
from rarefy.operators import models as MD
from rarefy.session import cut_lineage


@pytest.fixture
def grown(monkeypatch):
    """Small tables take cells, too; the kinds that were grown from them."""
    kinds, grow = [], CT.grow
    monkeypatch.setattr(CE, "CELL_LEAST", 1)
    monkeypatch.setattr(CT, "grow", lambda est, kind, *a: kinds.append(kind) or grow(est, kind, *a))
    return kinds


def test_a_forest_of_cells_scores_as_one_of_rows(spark, grown, monkeypatch, tmp_path):
    df = _rows(spark)
    got = MD.fit_model("RandomForest", df, FEATS, params={"numTrees": 60, "maxDepth": 5})
    assert grown == ["rf"]
    again = MD.fit_model("RandomForest", df, FEATS, params={"numTrees": 60, "maxDepth": 5})
    monkeypatch.setattr(CE, "CELL_LEAST", 10 ** 9)
    plain = MD.fit_model("RandomForest", df, FEATS, params={"numTrees": 60, "maxDepth": 5})
    forest = got.pipeline.stages[-1]
    assert forest.getNumTrees == 60 and max(t.depth for t in forest.trees) == 5 and forest.getMaxDepth() == 5
    assert sum(forest.featureImportances) == pytest.approx(1.0)
    assert np.abs(forest.featureImportances.toArray() - plain.pipeline.stages[-1].featureImportances.toArray()).max() < 0.05
    got.save(str(tmp_path / "m"))
    scores = {k: np.array([r[0] for r in m.transform(df).orderBy("row_id").select("score").collect()])
              for k, m in (("got", got), ("again", again), ("plain", plain), ("loaded", MD.load_model(str(tmp_path / "m"))))}
    assert np.allclose(scores["got"], scores["again"], atol=1e-9) and (scores["got"] == scores["loaded"]).all()
    assert np.abs(scores["got"] - scores["plain"]).mean() < 0.02 and np.corrcoef(scores["got"], scores["plain"])[0, 1] > 0.98


def test_boosted_trees_are_grown_from_cells(spark, grown):
    m = MD.fit_model("XGBoost", _rows(spark), FEATS, params={"maxIter": 3, "maxDepth": 3})
    assert grown == ["gbt"] and m.pipeline.stages[-1].treeWeights == [1.0, 0.3, 0.3]


def test_other_parameters_weights_and_classes_are_left_to_mllib(spark, grown):
    df = _rows(spark).withColumn("w", F.rand(3))
    MD.fit_model("RandomForest", df, FEATS, preset=dict(MD.PRESETS["RandomForest"], weights="col:w", numTrees=2, maxDepth=2))
    MD.fit_model("RandomForest", df, FEATS, params={"numTrees": 2, "maxDepth": 2, "minInstancesPerNode": 3})
    MD.fit_model("XGBoost", df, FEATS, params={"maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 3})
    MD.fit_model("RandomForest", df.withColumn("Class", F.col("Class") * 2), FEATS, params={"numTrees": 2, "maxDepth": 2})
    assert grown == []


def test_a_meta_model_is_fitted_to_written_scores(spark, monkeypatch):
    plans, fit = [], EF.fit_model

    def spied(name, train, *a, **k):
        if name == "meta":
            plans.append(train._jdf.queryExecution().analyzed().toString())
        return fit(name, train, *a, **k)
    monkeypatch.setattr(EF, "fit_model", spied)
    presets = {"LogisticRegression": None, "GradientBoosting": dict(kind="gbt", maxIter=2, maxDepth=2, stepSize=0.3, weights=None, seed=1)}
    df = cut_lineage(_rows(spark, 600))
    st = EF.stacking(list(presets), df, FEATS, cv=2, presets=presets)
    assert len(plans) == 1 and "UDF" not in plans[0] and st.transform(df).count() == 600
