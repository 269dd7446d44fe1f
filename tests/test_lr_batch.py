"""Logistic regressions of a search, fitted together in shared passes."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from rarefy.operators import lr_batch as LB
from rarefy.operators import tune as TU
from rarefy.operators.split import class_counts, stratified_kfold

FEATURES = ["a", "b", "c", "twice_a", "same", "part"]


def _data(spark, n=900, seed=4):
    """With a feature that follows from another, one of a single value, and one of few values (scores tie)."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3)).round(1)
    y = ((x[:, 0] - x[:, 1] + rng.normal(0, 1.5, n)) > 0.8).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(Class=y, row_id=np.arange(n), twice_a=2 * x[:, 0] + 5, same=3.0, part=(x[:, 2] > 0) * 1.0)
    return spark.createDataFrame(pdf).repartition(3)


def _folded(df, cv):
    _, rows = TU._assembled(df, FEATURES, "Class")
    return stratified_kfold(rows, "Class", cv, 42).persist(), class_counts(rows, "Class")


def _objective(model, mapped, rows, w):
    """MLlib's objective of a fitted model, in numpy."""
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["Class"] for r in rows])
    weight = np.array([w[c] for c in y])
    m = x @ model[0] + model[1]
    mean = np.average(x, axis=0, weights=weight)
    var = (weight[:, None] * (x - mean) ** 2).sum(0) / (weight.sum() - (weight ** 2).sum() / weight.sum())
    beta = model[0] * np.sqrt(var)
    e = mapped["elasticNetParam"]
    return np.average(np.logaddexp(0, m) - y * m, weights=weight) + mapped["regParam"] * (e * np.abs(beta).sum() + (1 - e) / 2 * (beta ** 2).sum())


def test_many_logistic_fits_share_their_passes(spark, monkeypatch):
    fits, fit = [], TU._fit
    monkeypatch.setattr(TU, "_fit", lambda *a: fits.append(a[1]) or fit(*a))
    monkeypatch.setattr(TU, "SPREAD_LEAST", 1)
    df = _data(spark)
    best, res = TU.grid_search("LogisticRegression", TU.PARAM_GRIDS["LogisticRegression"], df, FEATURES)
    rows = res.collect()
    assert len(fits) == 1 and len(rows) == 20  # the refit; 51 fits before
    assert all(len(r["fold_scores"]) == 5 and 0.5 < r["mean_score"] < r["mean_train_score"] + 0.05 for r in rows)
    assert best.extra["best_score"] == max(r["mean_score"] for r in rows)


@pytest.mark.parametrize("penalty", [0.0, 1.0])
def test_shared_fits_are_those_of_mllib(spark, monkeypatch, penalty):
    cv, seen, fitted = 3, [], LB._fitted
    monkeypatch.setattr(LB, "_fitted", lambda rdd, mo, lam, al, w, mean, scale: seen.append((fitted(rdd, mo, lam, al, w, mean, scale), mean, scale)) or seen[0][0])
    folded, counts = _folded(_data(spark), cv)
    maps = [{"regParam": r, "elasticNetParam": penalty, "weightCol": w} for r, w in ((0.02, "_w_bal"), (1e-4, "_w_one"))]
    weights = [TU._class_weights(m["weightCol"], counts) for m in maps]
    got = LB.fold_scores(maps, weights, folded, "Class", cv)
    (theta, mean, scale), = seen
    ev = BinaryClassificationEvaluator(labelCol="Class", metricName="areaUnderROC", numBins=0)
    for i, (m, w) in enumerate(zip(maps, weights)):
        for f in range(cv):
            train = folded.where(F.col("fold") != f)
            model, _ = TU._fit("LogisticRegression", m, train, "Class", counts)
            coef = theta[i * cv + f][:-1] / scale
            ours, theirs, rows = (coef, theta[i * cv + f][-1] - (coef * mean).sum()), (model.coefficients.toArray(), model.intercept), train.collect()
            assert -1e-12 < _objective(theirs, m, rows, w) - _objective(ours, m, rows, w) < 1e-4  # never above MLlib's
            for k, part in ((0, folded.where(F.col("fold") == f)), (1, train)):
                assert got[i][k][f] == pytest.approx(ev.evaluate(model.transform(part)), abs=5e-3)
    folded.unpersist()


def test_roc_auc_is_exact_over_ranges_and_ties(spark, monkeypatch):
    monkeypatch.setattr(LB, "RANGE_SCORES", 100)
    monkeypatch.setattr(LB, "TASK_SCORES", 2000)
    monkeypatch.setattr(LB, "BLOCK_ROWS", 64)
    cv = 3
    folded, _ = _folded(_data(spark), cv)
    rdd = LB._blocks(folded, "Class")
    theta = np.array([[1.0, -1, 0, 0, 0, 0, 0.1], [0, 0, 0, 0, 0, 1.0, 0], [0, 0, 0, 0, 0, 0, 2.0]] * 2)
    held = np.array([0, 1, 2, 2, 0, 1])
    blocks = rdd.collect()
    g, x = np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])
    got = LB._aucs(rdd, theta, held, x[::20], 900, 400, np.zeros(6), np.ones(6))
    assert len(g) == 900
    for t, h, pair in zip(theta, held, got):
        s = LB._scores(x, t[:, None], np.zeros(6), np.ones(6))[:, 0]
        for part, auc in ((g >> 1 == h, pair[0]), (g >> 1 != h, pair[1])):
            pos, neg = s[part & (g & 1 == 1)], s[part & (g & 1 == 0)]
            diff = pos[:, None] - neg[None, :]
            assert auc == ((diff > 0).sum() + 0.5 * (diff == 0).sum()) / diff.size
    folded.unpersist()


def test_many_trials_of_few_rows_share_their_passes(spark, monkeypatch):
    fits, fit = [], TU._fit
    monkeypatch.setattr(TU, "_fit", lambda *a: fits.append(a[1]) or fit(*a))
    _, res = TU.adaptive_search("LogisticRegression", _data(spark), FEATURES, n_trials=12, cv=3, min_rows=1000)
    assert len(fits) == 1 and res.count() == 12  # the refit; 37 fits before


def test_rows_that_only_mllib_can_judge_are_left_to_it(spark, monkeypatch):
    monkeypatch.setattr(TU, "SPREAD_LEAST", 1)
    df = _data(spark).withColumn("b", F.when(F.col("row_id") == 7, F.lit(None)).otherwise(F.col("b")))
    folded, counts = _folded(df, 3)
    one = [{"regParam": 0.1, "elasticNetParam": 0.0, "weightCol": "_w_one"}]
    assert LB.fold_scores(one, [TU._class_weights("_w_one", counts)], folded, "Class", 3) is None
    folded.unpersist()
    with pytest.raises(Exception, match="NaN|null|nan"):
        TU.grid_search("LogisticRegression", TU.PARAM_GRIDS["LogisticRegression"], df, FEATURES)


def test_class_weights_are_those_of_the_column(spark):
    counts = {0: 30, 1: 10}
    df = spark.createDataFrame([(0,), (1,)], "Class int")
    for name in ("_w_bal", "_w_one", "_w_spw_7"):
        col = {r["Class"]: r["w"] for r in df.select("Class", TU._weight(name, "Class", counts).alias("w")).collect()}
        assert col == pytest.approx(TU._class_weights(name, counts)), json.dumps(name)
