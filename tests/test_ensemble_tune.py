"""Ensembles of fitted models and cross-validated search on a small fixture."""

import numpy as np
import pandas as pd

from rarefy.operators import ensemble_fit as EF
from rarefy.operators import models as MD
from rarefy.operators import tune as TU


def _data(spark, n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    y = ((x[:, 0] - x[:, 1] + rng.normal(0, 0.7, n)) > 0.8).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(Class=y, row_id=np.arange(n))
    return spark.createDataFrame(pdf)


FAST = {"LogisticRegression": None,
        "GradientBoosting": dict(kind="gbt", maxIter=5, maxDepth=2, stepSize=0.3, weights=None, seed=1)}


def test_voting_weighted_stacking_bagging(spark):
    df = _data(spark)
    names = list(FAST)
    members = {n: MD.fit_model(n, df, ["a", "b", "c"], preset=FAST[n]) for n in names}
    for kind in ("voting", "weighted"):
        e = EF.Ensemble(kind, members, weights={n: 1.0 for n in names})
        m = MD.metrics_of(e.transform(df).withColumnRenamed("label", "Class"))
        assert m["roc_auc"] > 0.75
    st = EF.stacking(names, df, ["a", "b", "c"], cv=3, presets=FAST, members=members)
    out = st.transform(df)
    assert out.count() == 300
    assert MD.metrics_of(out.withColumnRenamed("label", "Class"))["roc_auc"] > 0.75
    bag = EF.bagging("LogisticRegression", df, ["a", "b", "c"], n_estimators=3)
    assert len(bag.members) == 3
    # each member sees a feature subset of floor(0.8 * 3) = 2 features
    assert all(len(m.features) == 2 for m in bag.members.values())


def test_grid_and_random_search(spark):
    df = _data(spark, 240, 5)
    grid = {"C": [0.1, 10], "penalty": ["l2"]}
    best, res = TU.grid_search("LogisticRegression", grid, df, ["a", "b", "c"], cv=3, parallelism=2)
    rows = res.collect()
    assert len(rows) == 2 and all(0.5 < r["mean_score"] <= 1.0 for r in rows)
    assert best.extra["best_score"] == max(r["mean_score"] for r in rows)
    _, r2 = TU.random_search("LogisticRegression", {"C": [0.1, 1, 10], "penalty": ["l1", "l2"]},
                             df, ["a", "b", "c"], n_iter=2, cv=3, parallelism=2)
    assert r2.count() == 2


def test_param_grid_sizes_and_mapping():
    sizes = {k: len(TU.grid_points(g)) for k, g in TU.param_grids().items()}
    assert sizes == {"LogisticRegression": 20, "RandomForest": 216, "XGBoost": 324,
                     "LightGBM": 216, "GradientBoosting": 243}
    m = TU.to_mllib("XGBoost", {"n_estimators": 50, "max_depth": 3, "learning_rate": 0.1,
                                "scale_pos_weight": 10, "subsample": 0.8, "colsample_bytree": 0.8}, 1000)
    assert m["maxIter"] == 50 and m["weightCol"] == "_w_spw_10" and m["featureSubsetStrategy"] == "0.8"
