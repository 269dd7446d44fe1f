"""Exact classification metrics as aggregates.

Threshold metrics are conditional sums in one pass. ROC-AUC is the
tie-aware rank sum and average precision the step-wise sum over distinct
thresholds; both first group rows by score (ties collapse map-side), then
take running sums with ``running_sums`` (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import running_sums


def _counts(df: DataFrame, label: str, pred: str):
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 1) & (p == 1)).cast("double").alias("tp"),
        F.count_if((y == 0) & (p == 1)).cast("double").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("double").alias("fn"),
        F.count_if((y == 0) & (p == 0)).cast("double").alias("tn"))


def _z(x):
    return F.coalesce(x, F.lit(0.0))


def threshold_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 (0 on zero division) and MCC, one row."""
    c = _counts(df, label, pred)
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    prec = _z(F.try_divide(tp, tp + fp))
    rec = _z(F.try_divide(tp, tp + fn))
    f1 = _z(F.try_divide(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn))
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    mcc = F.when(den > 0, (tp * tn - fp * fn) / den).otherwise(F.lit(0.0))
    return c.select(_z(F.try_divide(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), mcc.alias("mcc"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Rows = true class, columns pred_0 / pred_1 (all cells, zeros included)."""
    g = df.groupBy(label).agg(F.count_if(F.col(pred) == 0).alias("pred_0"),
                              F.count_if(F.col(pred) == 1).alias("pred_1"))
    return g.withColumnRenamed(label, "actual")


def score_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score with its positive and negative counts."""
    return df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def _rank_metrics(tbl: DataFrame) -> DataFrame:
    """ROC-AUC and AP from one ascending running sum over the distinct-score table.

    Descending inclusive counts follow from the ascending ones:
    cum_desc(x) = total - cum_asc(x) + own(x).
    """
    s, total = running_sums(tbl, "score", ["pos", "neg"])
    P, N = float(total["pos"]), float(total["neg"])
    cpos_d = F.lit(P) - F.col("cum_pos") + F.col("pos")
    cneg_d = F.lit(N) - F.col("cum_neg") + F.col("neg")
    agg = s.agg(
        F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg"))
              + F.lit(0.5) * F.col("pos").cast("double") * F.col("neg")).alias("u"),
        F.sum(F.col("pos").cast("double") * cpos_d / (cpos_d + cneg_d)).alias("w"))
    return agg.select(
        (F.when(F.lit(P > 0 and N > 0), F.col("u") / F.lit(P * N if P * N else 1.0))).alias("roc_auc"),
        (F.when(F.lit(P > 0), F.col("w") / F.lit(P if P else 1.0))).alias("average_precision"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under ROC = P(score_pos > score_neg) + 0.5 P(tie); null with one class."""
    return _rank_metrics(score_table(df, label, score).withColumnRenamed(score, "score")).select("roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Sum over distinct thresholds (high to low) of delta-recall x precision."""
    return _rank_metrics(score_table(df, label, score).withColumnRenamed(score, "score")) \
        .select("average_precision")


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / f1 / support, accuracy, macro and weighted averages."""
    spark = df.sparkSession
    rows = df.groupBy(label, pred).agg(F.count("*").alias("n")).collect()  # <= classes^2 rows
    classes = sorted({r[label] for r in rows} | {r[pred] for r in rows})
    cell = {(r[label], r[pred]): r["n"] for r in rows}
    total = sum(cell.values())
    out, stats = [], []
    for c in classes:
        tp = cell.get((c, c), 0)
        sup = sum(v for (a, _), v in cell.items() if a == c)
        predc = sum(v for (_, b), v in cell.items() if b == c)
        p = tp / predc if predc else 0.0
        r = tp / sup if sup else 0.0
        f = 2 * p * r / (p + r) if (p + r) else 0.0
        stats.append((p, r, f, sup))
        out.append((str(c), p, r, f, sup))
    acc = sum(cell.get((c, c), 0) for c in classes) / total if total else 0.0
    out.append(("accuracy", None, None, acc, total))
    k = len(stats) or 1
    out.append(("macro avg", sum(s[0] for s in stats) / k, sum(s[1] for s in stats) / k,
                sum(s[2] for s in stats) / k, total))
    tw = total or 1
    out.append(("weighted avg", sum(s[0] * s[3] for s in stats) / tw,
                sum(s[1] * s[3] for s in stats) / tw, sum(s[2] * s[3] for s in stats) / tw, total))
    return spark.createDataFrame(out, "class string, precision double, recall double, "
                                      "f1 double, support long")


def evaluate(df: DataFrame, label: str = "label", score: str = "score",
             pred: str = "prediction") -> DataFrame:
    """All metrics of a scored table in one row."""
    t = threshold_metrics(df, label, pred).first()
    r = _rank_metrics(score_table(df, label, score).withColumnRenamed(score, "score")).first()
    auc, ap = r["roc_auc"], r["average_precision"]
    return df.sparkSession.createDataFrame(
        [(auc, ap, t["accuracy"], t["precision"], t["recall"], t["f1"], t["mcc"])],
        "roc_auc double, average_precision double, accuracy double, precision double, "
        "recall double, f1 double, mcc double")
