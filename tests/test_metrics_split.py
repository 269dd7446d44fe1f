"""Exact metrics vs brute force; split and fold properties."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rarefy.operators import metrics as M
from rarefy.operators import split as SP


def _auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def _ap(y, s):
    order = np.argsort(-s, kind="stable")
    ys, ss = y[order], s[order]
    P = y.sum()
    ap, tp, fp, prev_r = 0.0, 0, 0, 0.0
    for t in np.unique(ss)[::-1]:
        m = ss == t
        tp += ys[m].sum()
        fp += (1 - ys[m]).sum()
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_auc_ap_bruteforce(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 1500)
    s = np.round(rng.random(1500) * 0.5 + y * 0.2, 2)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s}))
    assert abs(M.roc_auc(df).first()[0] - _auc(y, s)) < 1e-12
    assert abs(M.average_precision(df).first()[0] - _ap(y, s)) < 1e-12


def test_threshold_metrics(spark):
    y = np.array([1, 1, 0, 0, 1, 0, 0, 0])
    p = np.array([1, 0, 1, 0, 1, 0, 0, 0])
    df = spark.createDataFrame(pd.DataFrame({"label": y, "prediction": p}))
    t = M.threshold_metrics(df).first()
    tp, fp, fn, tn = 2, 1, 1, 4
    assert t["accuracy"] == 6 / 8 and t["precision"] == 2 / 3 and t["recall"] == 2 / 3
    mcc = (tp * tn - fp * fn) / np.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    assert abs(t["mcc"] - mcc) < 1e-12


def test_stratified_split_counts_and_determinism(spark):
    n = 3000
    pdf = pd.DataFrame({"row_id": np.arange(n), "Class": (np.arange(n) % 10 == 0).astype(int)})
    df = spark.createDataFrame(pdf)
    a = SP.split_data(df, "Class", 0.2, 0.1, 42).toPandas()
    b = SP.split_data(df, "Class", 0.2, 0.1, 42).toPandas()
    assert a.sort_values("row_id").split.tolist() == b.sort_values("row_id").split.tolist()
    for c, g in a.groupby("Class"):
        nc = len(g)
        kt = int(np.ceil(0.2 * nc))
        kv = int(np.ceil(0.1 / 0.8 * (nc - kt)))
        assert (g.split == "test").sum() == kt and (g.split == "val").sum() == kv


def test_kfold_disjoint_cover_balanced(spark):
    n = 1003
    pdf = pd.DataFrame({"row_id": np.arange(n), "Class": (np.arange(n) % 7 == 0).astype(int)})
    f = SP.stratified_kfold(spark.createDataFrame(pdf), "Class", 5, 1).toPandas()
    assert len(f) == n and f.row_id.is_unique and set(f.fold) == set(range(5))
    for _, g in f.groupby("Class"):
        cnt = g.fold.value_counts()
        assert cnt.max() - cnt.min() <= 1


def test_random_under(spark):
    pdf = pd.DataFrame({"row_id": np.arange(100), "Class": [1] * 10 + [0] * 90})
    out = SP.random_under(spark.createDataFrame(pdf), "Class", 42).toPandas()
    assert (out.Class == 1).sum() == 10 and (out.Class == 0).sum() == 10
