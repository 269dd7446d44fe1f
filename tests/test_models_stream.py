"""Model fit, save/load round trip, and stream output equal to batch output."""

import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rarefy.operators import models as MD
from rarefy.operators.scale import fit_scaler
from rarefy.streaming import stream_score


def _data(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 2))
    y = ((x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.5, n)) > 1.0).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(Class=y, row_id=np.arange(n))
    return spark.createDataFrame(pdf)


def test_fit_save_load_roundtrip(spark):
    df = _data(spark)
    sc = fit_scaler(df, ["a", "b"])
    stage = sc.as_sql_transformer(["row_id", "a", "b", "Class"])
    r = MD.train_model("LogisticRegression", sc.transform(df), ["a", "b"], "Class", df,
                       scaler_stage=stage)
    assert r.train_metrics["roc_auc"] > 0.8
    path = os.path.join(tempfile.mkdtemp(), "m")
    r.model.save(path)
    back = MD.load_model(path)
    a = r.model.transform(df).select("row_id", "score").toPandas().sort_values("row_id")
    b = back.transform(df).select("row_id", "score").toPandas().sort_values("row_id")
    assert np.allclose(a.score.to_numpy(), b.score.to_numpy())


def test_stream_equals_batch(spark):
    df = _data(spark, 300, 1)
    m = MD.fit_model("LogisticRegression", df, ["a", "b"], "Class")
    base = tempfile.mkdtemp()
    src = os.path.join(base, "src")
    df.repartition(3).write.parquet(src)
    q = stream_score(spark, src, df.schema, lambda d: d, m, os.path.join(base, "sink"),
                     os.path.join(base, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination()
    s = spark.read.parquet(os.path.join(base, "sink")).toPandas().sort_values("row_id")
    b = m.transform(df).toPandas().sort_values("row_id")
    assert len(s) == len(b)
    assert np.allclose(s.score.to_numpy(), b.score.to_numpy())
    assert (s.prediction.to_numpy() == b.prediction.to_numpy()).all()


def test_svm_and_knn_models(spark):
    df = _data(spark, 300, 2)
    svm = MD.fit_model("SVM", df, ["a", "b"], "Class")
    out = svm.transform(df).toPandas()
    assert out.score.between(0, 1).all()
    assert MD.metrics_of(svm.transform(df))["roc_auc"] > 0.7
    knn = MD.fit_model("KNN", df, ["a", "b"], "Class")
    assert MD.metrics_of(knn.transform(df.withColumn("row_id", F.col("row_id"))))["roc_auc"] > 0.7
