"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables through the views in ``sources.tables``
and runs over whole tables. Names match the operator keys of the survey.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import select as S
from ..operators import split as SP
from ..operators.scale import fit_scaler
from ..sources import tables as T
from .common import (ENSEMBLE_WEIGHTS, SPLIT_SEED, TEST_SIZE, VAL_SIZE, rnd, scorers)

VCOLS = [f"V{i}" for i in range(1, T.VECTOR_SIZE + 1)]
LINE_COLS = ["V1", "V2", "V3", "V4", "Amount", "Class"]


def _spark_df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- sources ------------------------------------------------------------

def q_scan_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """The events written as a transaction file and scanned with the fixed schema. The file has no
    key, so V1 and V2 carry the halves of row_id; the other components are empty."""
    from .catalog_models import work_dir
    path = work_dir(spark, "transactions") + ".csv"
    halves = {"V1": F.shiftright("row_id", 32), "V2": F.col("row_id").bitwiseAND(F.lit(0xFFFFFFFF))}
    tx = T.tx_events(spark, sf)
    cols = {c: F.col(c) for c in tx.columns} | halves
    tx.select(*[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in T.TX_SCHEMA]).write.option("header", True).csv(path)
    row_id = F.shiftleft(F.col("V1").cast("long"), 32) + F.col("V2").cast("long")
    return T.scan_transactions(spark, path).select(row_id.alias("row_id"), "Time", "Amount", T.LABEL)


def q_align_schema(spark, sf):
    return T.align_schema(T.tx_events(spark, sf))


# --- scalar features ----------------------------------------------------

def q_time_hours(spark, sf):
    return T.tx_events(spark, sf).select("row_id", X.time_hours("Time").alias("Time_Hours"))


def q_time_period(spark, sf):
    d = T.tx_events(spark, sf).select("row_id", X.time_hours("Time").alias("Time_Hours"))
    return d.withColumn("Time_Period", X.time_period("Time_Hours"))


def q_time_flags(spark, sf):
    d = T.tx_events(spark, sf).select("row_id", X.time_hours("Time").alias("Time_Hours"))
    return d.select("row_id", *[v.alias(k) for k, v in X.time_flags("Time_Hours").items()])


def q_time_cyclic(spark, sf):
    d = T.tx_events(spark, sf).select("row_id", X.time_hours("Time").alias("Time_Hours"))
    d = d.select("row_id", *[v.alias(k) for k, v in X.time_cyclic("Time_Hours").items()])
    return rnd(d, ["Time_Hours_Sin", "Time_Hours_Cos"])


def q_amount_log(spark, sf):
    d = T.tx_events(spark, sf).select("row_id", X.amount_log("Amount").alias("Amount_Log"))
    return rnd(d, ["Amount_Log"])


def q_interactions(spark, sf):
    d = FE.add_interactions(T.tx_vectors(spark, sf))
    return d.select("row_id", *[c for c in d.columns if "_x_" in c])


def _engineered(spark, sf):
    d, meta = FE.engineer_features(T.tx_events(spark, sf))
    return d


ENGINEERED_ROUND = ["Time_Hours_Sin", "Time_Hours_Cos", "Amount_Log", "Amount_ZScore"]


def q_project_selected(spark, sf):
    d = FE.project_selected(_engineered(spark, sf), ["Amount_Log", "Time_Hours"])
    return rnd(d, ["Amount_Log"])


def q_filter_class(spark, sf):
    return T.tx_events(spark, sf).where(F.col("Class") == 1)


def q_decision(spark, sf):
    return T.scored(spark, sf).withColumn("prediction", X.decision("score"))


def q_risk_band(spark, sf):
    d = T.scored(spark, sf).withColumn("prediction", X.decision("score"))
    d = d.select("row_id", "score", "prediction",
                 X.risk_band("score", "prediction").alias("risk_band"),
                 F.when(F.col("prediction") == 1, F.col("score"))
                 .otherwise(F.lit(1.0) - F.col("score")).alias("confidence"))
    return rnd(d, ["confidence"])


def q_class_weights(spark, sf):
    from ..operators.models import class_weight_table
    return rnd(class_weight_table(T.tx_events(spark, sf), "Class"), ["weight"])


def q_scale_pos_weight(spark, sf):
    tx = T.tx_events(spark, sf)
    d = tx.agg(F.count_if(F.col("Class") == 0).alias("neg"), F.count_if(F.col("Class") == 1).alias("pos"))
    d = d.withColumn("scale_pos_weight",
                     F.when(F.col("pos") > 0, F.col("neg").cast("double") / F.col("pos")))
    return rnd(d, ["scale_pos_weight"])


# --- profiling ----------------------------------------------------------

def q_shape_head(spark, sf):
    return P.shape_head(T.tx_events(spark, sf))


def q_dtype_info(spark, sf):
    return P.dtype_info(T.tx_events(spark, sf))


def q_describe(spark, sf):
    d = P.describe(T.tx_lines(spark, sf), LINE_COLS)
    return rnd(d, ["mean", "std", "min", "q25", "q50", "q75", "max"])


def q_null_counts(spark, sf):
    return P.null_counts(T.tx_events(spark, sf))


def q_class_distribution(spark, sf):
    return rnd(P.class_distribution(T.tx_events(spark, sf)), ["pct"])


def q_corr_matrix(spark, sf):
    return rnd(P.corr_pairs(T.tx_lines(spark, sf), LINE_COLS), ["corr"])


def q_corr_topk(spark, sf):
    return rnd(P.corr_topk(T.tx_vectors(spark, sf), VCOLS, "Class", 10), ["corr", "abs_corr"])


def q_density_by_class(spark, sf):
    d = FE.add_time_features(T.tx_events(spark, sf))
    out = P.density_by_class(d, ["Time_Hours", "Amount"], "Class", bins=50)
    return rnd(rnd(out, ["x"]), ["density"], 9)


def q_box_stats(spark, sf):
    d = P.box_stats(T.tx_lines(spark, sf), ["V1", "V2", "V3", "V4", "Amount"], "Class")
    return rnd(d, ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])


def q_amount_quantile_flags(spark, sf):
    d = FE.add_amount_features(T.tx_events(spark, sf))
    return d.select("row_id", "Is_High_Amount", "Is_Very_High_Amount", "Is_Low_Amount")


def q_amount_decile(spark, sf):
    return FE.add_amount_features(T.tx_events(spark, sf)).select("row_id", "Amount", "Amount_Bin")


def q_amount_zscore(spark, sf):
    d = FE.add_amount_features(T.tx_events(spark, sf)).select("row_id", "Amount_ZScore")
    return rnd(d, ["Amount_ZScore"])


def q_engineer_features(spark, sf):
    return rnd(_engineered(spark, sf), ENGINEERED_ROUND)


def q_decile_fraud_rate(spark, sf):
    """Flagship: fraud rate per amount decile of the engineered table."""
    d = _engineered(spark, sf)
    g = d.groupBy("Amount_Bin").agg(F.count("*").alias("n"),
                                    F.count_if(F.col("Class") == 1).alias("n_fraud"))
    return rnd(g.withColumn("fraud_pct", F.col("n_fraud") * F.lit(100.0) / F.col("n")), ["fraud_pct"])


# --- split / scale / resample ---------------------------------------------

def _split(spark, sf, val=0.0):
    return SP.split_data(T.tx_events(spark, sf), "Class", TEST_SIZE, val, SPLIT_SEED)


def q_stratified_split(spark, sf):
    return _split(spark, sf, VAL_SIZE).select("row_id", "Class", "split")


def q_random_split(spark, sf):
    d = SP.split_data(T.tx_events(spark, sf), "Class", TEST_SIZE, 0.0, SPLIT_SEED, stratify=False)
    return d.select("row_id", "split")


def q_stratified_kfold(spark, sf):
    return SP.stratified_kfold(T.tx_events(spark, sf), "Class", 5, SPLIT_SEED) \
        .select("row_id", "Class", "fold")


def _scaled(spark, sf, method):
    from ..session import cut_lineage
    d = cut_lineage(_split(spark, sf))  # fitted on and applied to the same split
    m = fit_scaler(d.where(F.col("split") == "train"), ["Time", "Amount"], method)
    return rnd(m.transform(d).select("row_id", "split", "Time", "Amount"), ["Time", "Amount"])


def q_standard_scale(spark, sf):
    return _scaled(spark, sf, "standard")


def q_robust_scale(spark, sf):
    return _scaled(spark, sf, "robust")


def q_random_under(spark, sf):
    return SP.random_under(T.tx_events(spark, sf), "Class", SPLIT_SEED).select("row_id", "Class")


# --- metrics on the fixed-score table ---------------------------------------

def _decided(spark, sf):
    return T.scored(spark, sf).withColumn("prediction", X.decision("score"))


def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_decided(spark, sf))


def q_threshold_metrics(spark, sf):
    return rnd(M.threshold_metrics(_decided(spark, sf)), ["accuracy", "precision", "recall", "f1", "mcc"])


def q_roc_auc(spark, sf):
    return rnd(M.roc_auc(T.scored(spark, sf)), ["roc_auc"])


def q_average_precision(spark, sf):
    return rnd(M.average_precision(T.scored(spark, sf)), ["average_precision"])


def q_class_report(spark, sf):
    return rnd(M.class_report(_decided(spark, sf)), ["precision", "recall", "f1"])


def _member_scores(spark, sf):
    tx = T.tx_events(spark, sf)
    return tx.select("row_id", F.col("Class").alias("label"),
                     *[v.alias(k) for k, v in scorers().items()])


def q_vote_soft(spark, sf):
    from ..operators.ensemble import soft_vote
    d = soft_vote(_member_scores(spark, sf), list(scorers()))
    return rnd(d.select("row_id", "label", "score", "prediction"), ["score"])


def q_vote_hard(spark, sf):
    from ..operators.ensemble import hard_vote
    d = hard_vote(_member_scores(spark, sf), list(scorers()))
    return rnd(d.select("row_id", "label", "score", "prediction"), ["score"])


def _weighted(spark, sf):
    from ..operators.ensemble import weighted_vote
    return weighted_vote(_member_scores(spark, sf), ENSEMBLE_WEIGHTS)


def q_weighted(spark, sf):
    return rnd(_weighted(spark, sf).select("row_id", "label", "score", "prediction"), ["score"])


def q_evaluate_ensemble(spark, sf):
    e = M.evaluate(_weighted(spark, sf)).drop("mcc")
    return rnd(e, e.columns)


# --- selection ------------------------------------------------------------

def _selected(spark, sf, method, k=10):
    tx = T.tx_vectors(spark, sf)
    names, scores = S.select_features(tx, VCOLS, "Class", method=method, k=k)
    d = scores.where(F.col("feature").isin(names)).select("feature", "score")
    return rnd(d, ["score"])


def q_select_f_test(spark, sf):
    return _selected(spark, sf, "f_test")


def q_select_mutual_info(spark, sf):
    return _selected(spark, sf, "mutual_info")


def q_select_corr(spark, sf):
    return _selected(spark, sf, "correlation")


SQL_CHECKED = {
    "decile_fraud_rate": q_decile_fraud_rate,
    "scan_transactions": q_scan_transactions,
    "align_schema": q_align_schema,
    "time_hours": q_time_hours,
    "time_period": q_time_period,
    "time_flags": q_time_flags,
    "time_cyclic": q_time_cyclic,
    "amount_log": q_amount_log,
    "interactions": q_interactions,
    "project_selected": q_project_selected,
    "filter_class": q_filter_class,
    "decision": q_decision,
    "risk_band": q_risk_band,
    "class_weights": q_class_weights,
    "scale_pos_weight": q_scale_pos_weight,
    "shape_head": q_shape_head,
    "dtype_info": q_dtype_info,
    "describe": q_describe,
    "null_counts": q_null_counts,
    "class_distribution": q_class_distribution,
    "corr_matrix": q_corr_matrix,
    "corr_topk": q_corr_topk,
    "density_by_class": q_density_by_class,
    "box_stats": q_box_stats,
    "amount_quantile_flags": q_amount_quantile_flags,
    "amount_decile": q_amount_decile,
    "amount_zscore": q_amount_zscore,
    "engineer_features": q_engineer_features,
    "stratified_split": q_stratified_split,
    "random_split": q_random_split,
    "stratified_kfold": q_stratified_kfold,
    "standard_scale": q_standard_scale,
    "robust_scale": q_robust_scale,
    "random_under": q_random_under,
    "confusion_matrix": q_confusion_matrix,
    "threshold_metrics": q_threshold_metrics,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "class_report": q_class_report,
    "vote_soft": q_vote_soft,
    "vote_hard": q_vote_hard,
    "weighted": q_weighted,
    "evaluate_ensemble": q_evaluate_ensemble,
    "select_f_test": q_select_f_test,
    "select_mutual_info": q_select_mutual_info,
    "select_corr": q_select_corr,
}
