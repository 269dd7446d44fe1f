"""Hand-made edge fixtures (hours on bin edges, collapsing quantile edges,
one class, ties, zero denominators, constant and null columns)."""

import math

import pytest
from pyspark.sql import functions as F

from rarefy.functions.exprs import time_flags, time_hours, time_period
from rarefy.operators import features as FE
from rarefy.operators import metrics as M
from rarefy.operators.scale import fit_scaler


def test_period_edges(spark):
    hours = [0, 6, 12, 18, 24]
    df = spark.createDataFrame([(float(h * 3600),) for h in hours], "Time double")
    d = df.withColumn("h", time_hours("Time")).withColumn("p", time_period("h"))
    d = d.select("h", "p", *[v.alias(k) for k, v in time_flags("h").items()]).collect()
    by_h = {r["h"]: r for r in d}
    assert by_h[0.0]["p"] is None          # 24h wraps to 0, and 0 is outside (0, 6]
    assert by_h[6.0]["p"] == "Night" and by_h[6.0]["Is_Morning"] == 1
    assert by_h[12.0]["p"] == "Morning" and by_h[12.0]["Is_Afternoon"] == 1
    assert by_h[18.0]["p"] == "Afternoon" and by_h[18.0]["Is_Evening"] == 1
    assert by_h[0.0]["Is_Night"] == 1


def test_negative_time_wraps_like_python(spark):
    df = spark.createDataFrame([(-3600.0,)], "Time double")
    assert df.select(time_hours("Time")).first()[0] == pytest.approx((-3600.0 / 3600) % 24)


def test_amounts_all_equal(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(20)], "row_id double, Amount double")
    out = FE.add_amount_features(df).collect()
    assert {r["Amount_Bin"] for r in out} == {0}
    assert all(r["Amount_ZScore"] is None for r in out)      # zero std
    assert all(r["Is_High_Amount"] == 0 and r["Is_Low_Amount"] == 0 for r in out)


def test_duplicate_quantile_edges_collapse(spark):
    vals = [1.0] * 60 + [2.0] * 30 + [3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0]
    df = spark.createDataFrame([(v,) for v in vals], "Amount double")
    st = FE.fit_amount_stats(df)
    assert st.edges == sorted(set(st.edges))
    bins = {r["Amount"]: r["Amount_Bin"] for r in FE.add_amount_features(df, st).collect()}
    assert bins[1.0] == 0 and bins[12.0] == len(st.edges) - 2
    assert set(bins.values()) <= set(range(len(st.edges) - 1))
    assert bins[2.0] == 1 and bins[3.0] == 3   # edges [1, 1.4, 2, 2.1, 12]: (2, 2.1] is empty


def test_null_amount(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "Amount double")
    rows = FE.add_amount_features(df).collect()
    nul = [r for r in rows if r["Amount"] is None][0]
    assert nul["Amount_Log"] is None and nul["Amount_Bin"] is None
    assert nul["Is_High_Amount"] == 0


def test_metrics_one_class_and_no_positive_prediction(spark):
    df = spark.createDataFrame([(0, 0.2, 0), (0, 0.3, 0)], "label int, score double, prediction int")
    t = M.threshold_metrics(df).first()
    assert t["precision"] == 0.0 and t["recall"] == 0.0 and t["f1"] == 0.0 and t["mcc"] == 0.0
    assert M.roc_auc(df).first()[0] is None
    assert M.average_precision(df).first()[0] is None


def test_all_tied_scores(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    assert M.roc_auc(df).first()[0] == 0.5
    assert M.average_precision(df).first()[0] == 0.5


def test_constant_feature_scaling(spark):
    df = spark.createDataFrame([(2.0, float(i)) for i in range(5)], "c double, x double")
    m = fit_scaler(df, ["c", "x"], "standard")
    assert m.scale["c"] == 1.0
    r = fit_scaler(df, ["c", "x"], "robust")
    assert r.scale["c"] == 1.0 and r.center["x"] == 2.0
