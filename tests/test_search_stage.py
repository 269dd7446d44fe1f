"""Searches with classes of points and rungs, the saved feature stage, restored ensembles, a restarted stream."""

import json
import os
import tempfile
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarefy.operators import ensemble_fit as EF
from rarefy.operators import models as MD
from rarefy.operators import tune as TU
from rarefy.operators.feature_stage import FeatureStage, fit_stage
from rarefy.sources import tables as T
from rarefy.streaming import stream_score


def _data(spark, n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    y = ((x[:, 0] - x[:, 1] + rng.normal(0, 0.7, n)) > 0.8).astype(int)
    return spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(Class=y, row_id=np.arange(n)))


def test_equal_points_are_fitted_once_and_scores_spread(spark, monkeypatch):
    df, fits, fit = _data(spark), [], TU._fit
    monkeypatch.setattr(TU, "_fit", lambda *a: fits.append(a[1]) or fit(*a))
    grid = {"C": [0.1, 10], "penalty": ["l2"], "solver": ["liblinear", "saga"]}
    known = {}
    best, res = TU.grid_search("LogisticRegression", grid, df, ["a", "b", "c"], cv=3, parallelism=2, known=known)
    assert len(fits) == 2 * 3 + 1  # two classes of points, three folds, one refit
    rows = sorted(res.collect(), key=lambda r: r["point"])
    assert [r["fitted_as"] for r in rows] == [0, 0, 2, 2] and rows[0]["fold_scores"] == rows[1]["fold_scores"]
    for r in rows:
        assert r["mean_score"] == pytest.approx(np.mean(r["fold_scores"])) and r["std_score"] == pytest.approx(np.std(r["fold_scores"]))
        assert r["rank"] == 1 + sum(s["mean_score"] > r["mean_score"] for s in rows) and 0.5 < r["mean_train_score"] <= 1
    assert best.extra["best_score"] == max(r["mean_score"] for r in rows)
    # a search over the same folds fits only the refit anew
    fits.clear()
    _, again = TU.random_search("LogisticRegression", grid, df, ["a", "b", "c"], n_iter=3, cv=3, parallelism=2, known=known)
    assert len(fits) == 1 and again.count() == 3


def test_fold_scores_are_those_of_held_out_folds(spark):
    from rarefy.operators.split import stratified_kfold
    df = _data(spark, 240, 7)
    _, res = TU.grid_search("LogisticRegression", {"C": [1.0]}, df, ["a", "b", "c"], cv=3, parallelism=1)
    folded = stratified_kfold(df, "Class", 3, 42)
    want = []
    for f in range(3):
        m = MD.fit_model("LogisticRegression", folded.where(F.col("fold") != f), ["a", "b", "c"], preset=dict(kind="lr", maxIter=100, C=1.0, weights="balanced"))
        want.append(MD.metrics_of(m.transform(folded.where(F.col("fold") == f)))["roc_auc"])
    assert res.first()["fold_scores"] == pytest.approx(want, abs=0.02)


def test_halving_keeps_the_best_third_and_ends_on_all_rows(spark):
    df = _data(spark, 900, 5)
    best, res = TU.adaptive_search("LogisticRegression", df, ["a", "b", "c"], n_trials=9, cv=2, parallelism=4, min_rows=100)
    rows = res.collect()
    by = {k: [r for r in rows if r["rung"] == k] for k in {r["rung"] for r in rows}}
    assert [len(by[k]) for k in sorted(by)] == [9, 3, 1] and by[2][0]["n_rows"] == 900 and by[0][0]["n_rows"] < 200
    for k in (0, 1):
        top = sorted(by[k], key=lambda r: (-r["mean_score"], r["trial"]))[:len(by[k + 1])]
        assert {r["trial"] for r in by[k + 1]} == {r["trial"] for r in top} == {r["trial"] for r in by[k] if r["kept"]}
    assert json.loads(by[2][0]["params"])["C"] == best.extra["best_params"]["C"]
    # no time: one trial is scored all the same
    t = time.monotonic()
    best, res = TU.adaptive_search("LogisticRegression", df, ["a", "b", "c"], n_trials=9, timeout=0, cv=2, parallelism=4, min_rows=100)
    assert res.count() == 1 and best.extra["best_params"] == TU.drawn_point(TU.SEARCH_SPACES["LogisticRegression"], 42, 0) and time.monotonic() - t < 60


def test_drawn_points_stay_in_range():
    for name, space in TU.SEARCH_SPACES.items():
        points = [TU.drawn_point(space, 1, t) for t in range(200)]
        for k, rng in space.items():
            seen = [p[k] for p in points]
            assert set(seen) == set(rng) if isinstance(rng, list) else min(seen) >= rng[0] and max(seen) <= rng[1]
        assert all("weightCol" in TU.to_mllib(name, p, 1000) for p in points)


def _transactions(spark, n=400):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(0, 1, (n, 4)), columns=["V1", "V2", "V3", "V4"])
    pdf = pdf.assign(Time=rng.integers(0, 200_000, n).astype(float), Amount=rng.gamma(2.0, 50.0, n), row_id=np.arange(n))
    return spark.createDataFrame(pdf.assign(Class=(pdf.V1 + rng.normal(0, 0.5, n) > 0.5).astype(int)))


def test_one_artefact_scores_a_raw_file(spark):
    tx = _transactions(spark)
    stage = fit_stage(tx, interactions=True, pca=2, select_k=9, select_method="f_test", contract=["Time", "V1", "V2", "V3", "V4", "Amount"])
    assert len(stage.inputs) == 9 and stage.interactions and stage.pca is not None
    rows = stage.transform(tx)
    m = MD.fit_model("LogisticRegression", rows, stage.inputs)
    m.stage = stage
    base = tempfile.mkdtemp()
    m.save(os.path.join(base, "model"))
    back = MD.load_model(os.path.join(base, "model"))
    assert json.dumps(FeatureStage.from_dict(stage.to_dict()).to_dict()) == json.dumps(stage.to_dict())
    T.align_schema(tx, keep=("Class",)).select(*T.CONTRACT, "Class").coalesce(1).write.option("header", True).csv(os.path.join(base, "raw.csv"))
    scanned = T.scan_transactions(spark, os.path.join(base, "raw.csv"))
    a = m.transform(tx).select("score").toPandas().score.sort_values().to_numpy()
    b = back.transform(scanned).select("score").toPandas().score.sort_values().to_numpy()
    assert len(a) == len(b) == 400 and np.allclose(a, b)
    # columns that are missing count as 0, and their order and further ones don't matter
    less = tx.drop("V4").select("V2", F.lit("x").alias("note"), "Amount", "V1", "V3", "Time", "row_id")
    assert np.allclose(back.transform(less).toPandas().sort_values("row_id").score, back.transform(tx.withColumn("V4", F.lit(0.0))).toPandas().sort_values("row_id").score)


def test_stage_equals_engineer_features(spark):
    from rarefy.operators.features import engineer_features
    tx = _transactions(spark)
    stage = fit_stage(tx, scale=None, interactions=True)
    want, meta = engineer_features(tx, add_inter=True)
    cols = ["row_id", "Time", "Amount", *meta.added_features]
    got = stage.engineered(tx).select(*cols).toPandas().sort_values("row_id")
    assert set(meta.added_features) <= set(stage.inputs)
    assert np.allclose(got.to_numpy(float), want.select(*cols).toPandas().sort_values("row_id").to_numpy(float))


def test_restored_ensembles_score_alike(spark):
    df = _data(spark)
    names = {"LogisticRegression": None, "GradientBoosting": dict(kind="gbt", maxIter=5, maxDepth=2, stepSize=0.3, weights=None, seed=1), "KNN": None}
    members = {n: MD.fit_model(n, df, ["a", "b", "c"], preset=p) for n, p in names.items()}
    meta = MD.fit_model("meta", EF.member_scores(members, df).withColumnRenamed("label", "Class"), [f"s_{n}" for n in names], preset=dict(kind="lr", maxIter=50, C=1.0, weights=None))
    for e in (EF.Ensemble("voting", members, voting="hard"), EF.Ensemble("weighted", members, weights={"KNN": 1.0, "GradientBoosting": 2.0, "LogisticRegression": 3.0}),
              EF.Ensemble("stacking", members, meta=meta)):
        path = os.path.join(tempfile.mkdtemp(), "e")
        e.save(path)
        back = EF.load_ensemble(path)
        assert (back.kind, back.voting, list(back.members), back.weights) == (e.kind, e.voting, list(e.members), e.weights)
        a, b = (x.transform(df).toPandas().sort_values("row_id") for x in (e, back))
        assert np.allclose(a.score, b.score) and (a.prediction == b.prediction).all()
    with pytest.raises(FileNotFoundError):
        EF.load_ensemble("/nowhere/at/all")


def test_member_scores_need_one_read_of_the_rows(spark):
    df = _data(spark)
    members = {n: MD.fit_model("LogisticRegression", df, ["a", "b"], preset=dict(kind="lr", maxIter=5, C=c, weights=None)) for n, c in (("x", 1.0), ("y", 0.01))}
    plan = EF.member_scores(members, df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_restarted_stream_gives_each_row_once(spark):
    tx = _transactions(spark, 300)
    stage = fit_stage(tx, contract=["Time", "V1", "V2", "V3", "V4", "Amount"])
    m = MD.fit_model("LogisticRegression", stage.transform(tx), stage.inputs)
    m.stage = stage
    base = tempfile.mkdtemp()
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    raw = tx.drop("V4")  # aligned by the stage
    raw.where("row_id < 200").repartition(4).write.parquet(src)
    q = stream_score(spark, src, raw.schema, lambda d: d, m, sink, ckpt, available_now=False, max_files_per_trigger=1)
    while q.isActive and not q.recentProgress:
        q.awaitTermination(0.2)
    q.stop()
    early = spark.read.parquet(sink).count()
    raw.where("row_id >= 200").repartition(2).write.mode("append").parquet(src)
    stream_score(spark, src, raw.schema, lambda d: d, m, sink, ckpt, max_files_per_trigger=2).awaitTermination()
    got = spark.read.parquet(sink).toPandas().sort_values("row_id")
    want = m.transform(raw).toPandas().sort_values("row_id")
    assert 0 < early <= 300 and got.row_id.tolist() == list(range(300)) and np.allclose(got.score.to_numpy(), want.score.to_numpy())
