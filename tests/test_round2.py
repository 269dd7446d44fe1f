"""Regressions: large ids, null features, heavy score tables, models in threads."""

import math

from pyspark.sql import functions as F


def test_top_n_by_keeps_large_ids_apart(spark):
    from rarefy.operators.resample import top_n_by
    d = spark.range(100).select((F.col("id") + F.lit(2 ** 60)).alias("row_id"), F.lit(1.0).alias("key"))
    got = sorted(r["row_id"] for r in top_n_by(d, "key", 10).collect())
    assert got == [2 ** 60 + i for i in range(10)]


def test_infinity_is_a_quantile(spark):
    from rarefy.operators.quantiles import column_quantiles
    d = spark.createDataFrame([(1.0,), (2.0,), (math.inf,)], "x double")
    assert column_quantiles(d, "x", [0.0, 0.5, 1.0]) == [1.0, 2.0, math.inf]


def test_null_features_keep_every_row(spark):
    from rarefy.operators.models import knn_classify
    from rarefy.operators.resample import smote
    from rarefy.operators.split import class_counts
    rows = [(i, None if i % 11 == 5 else float(i % 17), float(i % 5), int(i < 60)) for i in range(210)]
    d = spark.createDataFrame(rows, "row_id long, a double, b double, Class int")
    out = knn_classify(d.where("row_id >= 50"), d.where("row_id < 100"), ["a", "b"])
    assert out.count() == 100 and out.where("score IS NULL").count() == 0
    assert class_counts(smote(d, ["a", "b"]), "Class") == {0: 150, 1: 150}


def test_auc_of_a_heavy_score_table(spark):
    from rarefy.operators.metrics import _rank_metrics
    t = spark.range(100).select((F.col("id") / 100).alias("score"), F.lit(200_000_000).cast("long").alias("pos"), F.lit(800_000_000).cast("long").alias("neg"))
    assert abs(_rank_metrics(t).first()["roc_auc"] - 0.5) < 1e-9


def test_svm_trains_in_a_thread_and_errors_are_rows(spark):
    from rarefy.operators.models import train_many
    rows = [(i, float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(120)]
    d = spark.createDataFrame(rows, "row_id long, a double, b double, Class int")
    results, table = train_many(d, d, ["a", "b"], names=["SVM", "NoSuchModel"])
    found = {r["model"]: r for r in table.collect()}
    assert results["SVM"] is not None and found["SVM"]["roc_auc"] > 0.9 and found["SVM"]["error"] is None
    assert results["NoSuchModel"] is None and "KeyError" in found["NoSuchModel"]["error"]


def test_job_on_a_transaction_csv(spark, tmp_path):
    """The job reads the 31-column file and trains on its components, too."""
    n = 400
    v = [(F.sin(F.col("id") * (i + 1)) + F.when(F.col("id") % 5 == 0, 1.5).otherwise(0.0)).alias(f"V{i}") for i in range(1, 29)]
    rows = spark.range(n).select((F.col("id") * 60.0).alias("Time"), *v, (F.col("id") % 97 + 0.5).alias("Amount"),
                                 (F.col("id") % 5 == 0).cast("int").alias("Class"))
    path = str(tmp_path / "tx.csv")
    rows.coalesce(1).write.option("header", True).csv(path)
    from rarefy.plans.catalog_models import MODEL_FEATURES, ModelData
    from rarefy.plans.job import load, run_job
    md = ModelData(spark, path, resample="smote", tx=load(spark, path))
    assert md.features == MODEL_FEATURES + [f"V{i}" for i in range(1, 29)]
    assert md.train.groupBy("Class").count().select("count").distinct().count() == 1
    table = run_job(spark, path, str(tmp_path / "out"), run_ensembling=False, models=["LogisticRegression"]).collect()
    assert len(table) == 1 and table[0]["roc_auc"] > 0.9
    assert (tmp_path / "out" / "eda_report").is_dir()


def test_f_scores_with_a_large_mean(spark):
    from rarefy.operators.select import f_scores
    d = spark.range(1000).select((F.col("id") % 2).cast("int").alias("Class"), (F.col("id") % 7).cast("double").alias("x"))
    near = f_scores(d, ["x"])["x"]
    far = f_scores(d.withColumn("x", F.col("x") + 1e9), ["x"])["x"]
    assert abs(near - far) < 1e-6 * max(1.0, near)


def test_poisson_draws_have_the_whole_tail(spark):
    from rarefy.operators.ensemble_fit import _poisson_weight
    u = spark.range(20_000).select(((F.col("id") + 0.5) / 20_000).alias("u"))
    for lam in (0.8, 30.0):
        r = u.select(_poisson_weight(F.col("u"), lam).alias("w")).agg(F.avg("w").alias("m"), F.max("w").alias("x")).first()
        assert abs(r["m"] - lam) < 0.01 * lam and (lam < 1 or r["x"] > 40)
