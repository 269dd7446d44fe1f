"""The four profiles of an EDA run as one summary table (no figures)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .profile import box_stats, class_distribution, corr_topk, density_by_class, numeric_columns

SCHEMA = "section string, feature string, Class int, stat string, value double"


def eda_report(df: DataFrame, label: str = "Class", n_features: int = 10) -> DataFrame:
    spark = df.sparkSession
    cd = class_distribution(df, label).collect()
    rows = []
    for r in cd:
        rows += [("class_distribution", None, r[label], "n", float(r["n"])),
                 ("class_distribution", None, r[label], "pct", float(r["pct"]))]
    feats = [c for c in numeric_columns(df) if c != label]
    top = corr_topk(df, feats, label, n_features).collect()
    rows += [("corr_topk", r["feature"], None, "abs_corr", float(r["abs_corr"])) for r in top]
    chosen = [r["feature"] for r in top] or feats[:n_features]
    for r in box_stats(df, chosen, label).collect():
        for s in ("q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers"):
            v = r[s]
            rows.append(("box", r["feature"], r[label], s, None if v is None else float(v)))
    # densities rounded to 9 places before the argmax, ties to the lower bin
    dens = density_by_class(df, chosen, label).withColumn("density", F.round("density", 9))
    w = Window.partitionBy("feature", label).orderBy(F.desc_nulls_last("density"), "bin")
    peaks = dens.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).collect()
    rows += [("density", r["feature"], r[label], "peak_x", float(r["x"])) for r in peaks]
    return spark.createDataFrame(rows, SCHEMA)
