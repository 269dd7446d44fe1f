"""Feature selection (ANOVA F, binned mutual information, correlation) and PCA.

Each score is one wide aggregate: per-class sums for F, per-pair
covariances for PCA, per (feature, bin, class) counts for mutual
information. Only the score vector (one number per feature) or the
d x d covariance reaches the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import ship_package
from .quantiles import exact_quantiles


def _scores_df(spark, scores: dict, name: str) -> DataFrame:
    data = [(i, f, (None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)))
            for i, (f, v) in enumerate(scores.items())]
    return spark.createDataFrame(data, f"position int, feature string, {name} double")


def f_scores(df: DataFrame, cols, label: str = "Class") -> dict:
    """One-way ANOVA F statistic of each feature against the label."""
    cols = list(cols)
    # sums of distances from the mean: a large mean would cancel the squares' digits
    mean = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    off = {c: F.col(c).cast("double") - F.lit(mean[c] or 0.0) for c in cols}
    rows = df.groupBy(label).agg(
        *[F.count(c).alias(f"{c}__n") for c in cols],
        *[F.sum(off[c]).alias(f"{c}__s") for c in cols],
        *[F.sum(off[c] * off[c]).alias(f"{c}__q") for c in cols],
    ).collect()  # one row per class
    out = {}
    for c in cols:
        found = [(r[f"{c}__n"], r[f"{c}__s"], r[f"{c}__q"]) for r in rows if r[f"{c}__n"]]
        n, g = sum(x[0] for x in found), len(found)
        s_all = sum(x[1] for x in found)
        shift = s_all * s_all / n if n else 0.0
        ssbn = sum(x[1] ** 2 / x[0] for x in found) - shift
        sswn = sum(x[2] for x in found) - shift - ssbn
        dfb, dfw = g - 1, n - g
        if dfb <= 0 or dfw <= 0 or sswn == 0:
            out[c] = None
        else:
            out[c] = (ssbn / dfb) / (sswn / dfw)
    return out


def mutual_info_binned(df: DataFrame, cols, label: str = "Class", n_bins: int = 10,
                       approx: bool = False) -> dict:
    """Mutual information (nats) between the label and each feature's quantile bin.

    Replaces the k-nearest-neighbour estimator with a discretised one:
    decile edges per feature (exact quantiles), right-closed bins, then
    I = sum p(b,c) ln(p(b,c) / (p(b) p(c))) from (feature, bin, class) counts.
    """
    cols = list(cols)
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(df, cols, probs, approx=approx)
    interior = {}
    for c in cols:
        e = sorted(set(v for v in q[(c,)] if v is not None))
        interior[c] = e[1:-1]
    # bin = number of interior edges strictly below x. Bucketizer's binary search has left-closed bins, so it
    # gets -x and the edges' negatives: its number counts the edges at or above x
    cut = [c for c in cols if interior[c]]
    wide = df.select(F.col(label).alias("_label"), *[(-F.col(c).cast("double")).alias(f"_x{i}") for i, c in enumerate(cols)])
    bins = {c: F.when(F.col(f"_x{i}").isNotNull() & ~F.isnan(f"_x{i}"), F.lit(0)) for i, c in enumerate(cols)}
    if cut:
        at = {c: i for i, c in enumerate(cols)}
        wide = Bucketizer(splitsArray=[[-math.inf, *sorted(-float(e) for e in interior[c]), math.inf] for c in cut], inputCols=[f"_x{at[c]}" for c in cut],
                          outputCols=[f"_b{at[c]}" for c in cut], handleInvalid="keep").transform(wide)
        bins |= {c: F.when(bins[c].isNotNull(), F.lit(len(interior[c])) - F.col(f"_b{at[c]}").cast("int")) for c in cut}
    wide = wide.select(F.col("_label").alias(label), *[bins[c].alias(c) for c in cols])
    counts = (wide.unpivot([label], cols, "feature", "bin").where(F.col("bin").isNotNull())
              .groupBy("feature", "bin", label).count().collect())
    by_f = {}
    for r in counts:
        by_f.setdefault(r["feature"], []).append((r["bin"], r[label], r["count"]))
    out = {}
    for c in cols:
        cells = by_f.get(c, [])
        n = sum(x[2] for x in cells)
        pb, pc = {}, {}
        for bb, cc, k in cells:
            pb[bb] = pb.get(bb, 0) + k
            pc[cc] = pc.get(cc, 0) + k
        mi = 0.0
        for bb, cc, k in cells:
            mi += (k / n) * math.log((k * n) / (pb[bb] * pc[cc]))
        out[c] = max(mi, 0.0) if n else None
    return out


def corr_scores(df: DataFrame, cols, label: str = "Class") -> dict:
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c)
                   for c in cols]).first()
    return {c: (None if row[c] is None else abs(row[c])) for c in cols}


def top_k(scores: dict, k: int, keep_order: bool = True) -> list:
    """Top-k names by score (ties: earlier column first); None scores last."""
    names = list(scores)
    ranked = sorted(names, key=lambda f: (scores[f] is None, -(scores[f] or 0.0), names.index(f)))
    chosen = ranked[:k]
    return [f for f in names if f in chosen] if keep_order else chosen


def select_features(df: DataFrame, cols, label: str = "Class", method: str = "mutual_info",
                    k: int = 20):
    """Return (selected names, scores DataFrame).

    f_test / mutual_info keep the original column order (a support mask);
    correlation returns names in score order.
    """
    spark = df.sparkSession
    if method == "f_test":
        s = f_scores(df, cols, label)
        return top_k(s, k), _scores_df(spark, s, "score")
    if method == "mutual_info":
        s = mutual_info_binned(df, cols, label)
        return top_k(s, k), _scores_df(spark, s, "score")
    if method == "correlation":
        s = corr_scores(df, cols, label)
        return top_k(s, k, keep_order=False), _scores_df(spark, s, "score")
    raise ValueError(f"Unknown selection method: {method}")


@dataclass
class PCAModel:
    columns: list
    mean: list
    components: np.ndarray          # k x d
    explained_variance_ratio: list

    def transform(self, df: DataFrame, prefix: str = "PCA_") -> DataFrame:
        """One matrix product per Arrow batch (d x k literals in one expression would exceed the size of
        compiled code). A row with a null gets nulls."""
        ship_package(df.sparkSession)
        mean, basis = np.array(self.mean, dtype=float), np.asarray(self.components, dtype=float).T

        @pandas_udf("array<double>")
        def project(x: pd.DataFrame) -> pd.Series:
            out = (x.to_numpy(dtype=float) - mean) @ basis
            return pd.Series([None if np.isnan(r).all() else r for r in out], dtype=object)

        d = df.withColumn("_pca", project(F.struct(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(self.columns)])))
        return d.withColumns({f"{prefix}{i + 1}": F.col("_pca")[i] for i in range(basis.shape[1])}).drop("_pca")


def covariance(df: DataFrame, cols):
    """Mean vector and sample covariance of complete rows.

    Each partition sums its rows and their Gram matrix in numpy (data
    shifted by a rough mean first, against cancellation) and emits
    1 + d + d^2 keyed numbers; a keyed sum combines them map-side. Only
    d^2 numbers reach the driver.
    """
    import pandas as pd
    from ..session import ship_package
    ship_package(df.sparkSession)
    cols = list(cols)
    d = len(cols)
    shift_row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    shift = np.array([shift_row[c] or 0.0 for c in cols])

    def part(it):
        n, sx, g = 0.0, np.zeros(d), np.zeros((d, d))
        for pdf in it:
            X = pdf[cols].to_numpy(dtype=float) - shift
            X = X[~np.isnan(X).any(axis=1)]
            n += len(X)
            sx += X.sum(axis=0)
            g += X.T @ X
        yield pd.DataFrame({"k": np.arange(1 + d + d * d, dtype="int64"),
                            "v": np.concatenate([[n], sx, g.ravel()])})

    tot = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .mapInPandas(part, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(1 + d + d * d)
    for r in tot:
        v[r["k"]] = r["v"]
    n, sx, g = v[0], v[1:1 + d], v[1 + d:].reshape(d, d)
    if n < 2:
        return shift, np.zeros((d, d))
    mu = sx / n
    cov = (g - n * np.outer(mu, mu)) / (n - 1)
    return shift + mu, cov


def fit_pca(df: DataFrame, cols, n_components: float | int = 0.95) -> PCAModel:
    """Centred PCA from the sample covariance (one aggregate pass).

    ``n_components`` as an int keeps that many components; as a fraction,
    the fewest whose cumulative explained variance exceeds it. Component
    signs are fixed so each component's largest absolute loading is positive.
    """
    cols = list(cols)
    d = len(cols)
    mean, cov = covariance(df, cols)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0.0, None), vecs[:, order].T
    total = vals.sum()
    ratio = vals / total if total > 0 else np.zeros_like(vals)
    if isinstance(n_components, float) and 0 < n_components < 1:
        k = int(np.searchsorted(np.cumsum(ratio), n_components, side="right") + 1)
    else:
        k = int(n_components)
    k = max(1, min(k, d))
    comps = vecs[:k]
    for i in range(k):
        if comps[i][np.argmax(np.abs(comps[i]))] < 0:
            comps[i] = -comps[i]
    return PCAModel(cols, list(mean), comps, ratio[:k].tolist())


def pca_transform(df: DataFrame, model: PCAModel) -> DataFrame:
    return model.transform(df)


def feature_importance(model, feature_names, spark) -> DataFrame:
    """Names with the model's importances, highest first."""
    imp = model.featureImportances.toArray().tolist()
    data = [(f, float(v)) for f, v in zip(feature_names, imp)]
    return spark.createDataFrame(data, "feature string, importance double") \
        .orderBy(F.desc("importance"), F.asc("feature"))
