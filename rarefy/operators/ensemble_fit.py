"""Ensembles of fitted models: voting, stacking, bagging, weighted.

Member scores are columns of one DataFrame; the combination is column arithmetic.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import unit_uniform
from ..session import SPREAD_LEAST, cut_lineage, parts_side_by_side
from ..sources.tables import path_exists
from .ensemble import hard_vote, soft_vote, weighted_vote
from .metrics import class_report, confusion_matrix, evaluate
from .models import PRESETS, FittedModel, SparkSessionRef, fit_model, load_model, weight_column
from .split import stratified_kfold


def _chains(model: FittedModel) -> bool:
    """Whether a model's transform adds columns and keeps all others."""
    return model.kind in ("lr", "rf", "gbt") and model.stage is None and not any(isinstance(s, SQLTransformer) for s in model.pipeline.stages)


def member_scores(models: dict, df: DataFrame, label: str = "Class") -> DataFrame:
    """row_id, label and one score column per member. Members that only add columns are one projection
    after the other; the others (neighbours, their own scaling) are joined by row_id."""
    out = df.withColumn("_label", F.col(label))
    for name, m in models.items():
        if _chains(m):
            out = m.transform(out).withColumnRenamed("score", f"s_{name}").drop("prediction")
    out = out.select("row_id", F.col("_label").alias("label"), *[f"s_{n}" for n, m in models.items() if _chains(m)])
    for name, m in models.items():
        if not _chains(m):
            out = out.join(m.transform(df).select("row_id", F.col("score").alias(f"s_{name}")), on="row_id")
    return out.select("row_id", "label", *[f"s_{n}" for n in models])


@dataclass
class Ensemble:
    kind: str
    members: dict
    weights: dict = field(default_factory=dict)
    meta: FittedModel | None = None
    voting: str = "soft"

    def transform(self, df: DataFrame, label: str = "Class") -> DataFrame:
        sc = member_scores(self.members, df, label)
        cols = [f"s_{n}" for n in self.members]
        if self.kind == "voting":
            return soft_vote(sc, cols) if self.voting == "soft" else hard_vote(sc, cols)
        if self.kind == "weighted":
            return weighted_vote(sc, {f"s_{k}": v for k, v in self.weights.items()})
        if self.kind == "bagging":
            return soft_vote(sc, cols)
        if self.kind == "stacking":
            out = self.meta.transform(sc.withColumnRenamed("label", "Class"))
            return out.withColumnRenamed("Class", "label")
        raise ValueError(self.kind)

    def save(self, path: str):
        for n, m in self.members.items():
            m.save(os.path.join(path, n))
        if self.meta is not None:
            self.meta.save(os.path.join(path, "_meta"))
        ss = SparkSessionRef.get()
        ss.createDataFrame([(self.kind, k, float(v)) for k, v in (self.weights or {"": 0.0}).items()],
                           "kind string, member string, weight double") \
            .coalesce(1).write.mode("overwrite").json(os.path.join(path, "_weights"))
        about = dict(kind=self.kind, voting=self.voting, members=list(self.members), weights=self.weights, meta=self.meta is not None)
        ss.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "_ensemble"))


def load_ensemble(path: str) -> Ensemble:
    """Restore a saved ensemble with its members, weights and meta model; a missing path raises FileNotFoundError."""
    spark = SparkSessionRef.get()
    if not path_exists(spark, os.path.join(path, "_ensemble")):
        raise FileNotFoundError(f"no saved ensemble under {path}")
    about = json.loads(spark.read.text(os.path.join(path, "_ensemble")).first()[0])
    return Ensemble(about["kind"], {n: load_model(os.path.join(path, n)) for n in about["members"]}, about["weights"],
                    load_model(os.path.join(path, "_meta")) if about["meta"] else None, about["voting"])


def fit_members(names, train, features, label="Class", presets=None, parallelism: int = 4):
    """Fit members concurrently (independent Spark jobs share the cluster)."""
    from concurrent.futures import ThreadPoolExecutor
    names = list(names)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(names)))) as ex:
        fitted = list(ex.map(lambda n: fit_model(n, train, features, label,
                                                 preset=(presets or {}).get(n)), names))
    return dict(zip(names, fitted))


def voting(names, train, features, label="Class", voting="soft", presets=None, members=None) -> Ensemble:
    members = members or fit_members(names, train, features, label, presets)
    return Ensemble("voting", members, voting=voting)


def weighted(names, train, features, label="Class", weights=None, presets=None, members=None) -> Ensemble:
    w = weights or {n: 1.0 / len(names) for n in names}
    members = members or fit_members(names, train, features, label, presets)
    return Ensemble("weighted", members, weights=w)


def _for_folds(df: DataFrame, cv: int) -> DataFrame:
    """Rows in the partitions of ``cv`` fits side by side: each level of a forest sends the sums of all
    its nodes from every partition, so partitions beyond a fit's part of the cores only add to that. Few rows stay where they are."""
    n = df.count()
    return df if n < SPREAD_LEAST else df.coalesce(parts_side_by_side(n, df.sparkSession.sparkContext.defaultParallelism, cv))


def stacking(names, train, features, label="Class", cv: int = 5, seed: int = 42,
             presets=None, members=None) -> Ensemble:
    """Out-of-fold member scores (k folds) feed a logistic meta model;
    members are then refitted on all training rows."""
    from concurrent.futures import ThreadPoolExecutor
    folded = _for_folds(stratified_kfold(train, label, cv, seed), cv).persist()

    def fold_scores(f):
        fit_rows = folded.where(F.col("fold") != f)
        hold = folded.where(F.col("fold") == f)
        ms = fit_members(names, fit_rows, features, label, presets, parallelism=1)
        # written: each job of the meta model would send the trees of all folds to its tasks
        return cut_lineage(member_scores(ms, hold, label))

    with ThreadPoolExecutor(max_workers=cv) as ex:
        parts = list(ex.map(fold_scores, range(cv)))
    oof = parts[0]
    for p_ in parts[1:]:
        oof = oof.unionByName(p_)
    oof = oof.persist()
    meta_feats = [f"s_{n}" for n in names]
    meta = fit_model("meta", oof.withColumnRenamed("label", label), meta_feats, label,
                     preset=dict(kind="lr", maxIter=1000, C=1.0, weights=None))
    members = members or fit_members(names, train, features, label, presets)
    folded.unpersist()
    oof.unpersist()
    return Ensemble("stacking", members, meta=meta)


def _poisson_weight(u, lam: float):
    """Inverse-CDF Poisson(lam) draw from a uniform column (bootstrap multiplicity).

    The draws go as far as doubles tell the distribution from 1, so the tail is whole for any lam."""
    import math
    cdf, k, expr = 0.0, 0, None
    while True:
        p = math.exp(k * math.log(lam) - lam - math.lgamma(k + 1)) if lam > 0 else float(k == 0)
        if cdf + p >= 1.0 or (k > lam and p < 2.0 ** -53):
            break
        cdf += p
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(float(k))) if expr is None else expr.when(cond, F.lit(float(k)))
        k += 1
    return F.lit(float(k)) if expr is None else expr.otherwise(F.lit(float(k)))


def bagging(name, train, features, label="Class", n_estimators: int = 10, max_samples: float = 0.8,
            max_features: float = 0.8, bootstrap: bool = True, seed: int = 42) -> Ensemble:
    """Members fit on bootstrap weights (Poisson(max_samples) per row, hashed,
    so no rows are copied) and a hashed 80% subset of the features."""
    import math
    from concurrent.futures import ThreadPoolExecutor
    base = dict(PRESETS[name])
    weighed, _ = weight_column(train, label, base.get("weights"))
    n_feat = max(1, int(math.floor(max_features * len(features))))

    def member(i):
        u = unit_uniform("row_id", seed, f"bag{i}")
        w = _poisson_weight(u, max_samples) if bootstrap else (u < F.lit(max_samples)).cast("double")
        # feature subset: the n_feat features with the smallest hash for this member
        import hashlib
        ranked = sorted(features, key=lambda c: hashlib.md5(f"{c}:{seed}:{i}".encode()).hexdigest())
        feats = [c for c in features if c in ranked[:n_feat]]
        # the base model's class weights times the row's multiplicity
        d = weighed.withColumn("_bw", w * F.col("_w")).drop("_w").where(F.col("_bw") > 0)
        preset = dict(base)
        preset["weights"] = "col:_bw"
        return f"m{i}", fit_model(name, d, feats, label, preset=preset)

    with ThreadPoolExecutor(max_workers=4) as ex:
        members = dict(ex.map(member, range(n_estimators)))
    return Ensemble("bagging", members)


def evaluate_ensemble(ens: Ensemble, test: DataFrame, label: str = "Class", name: str = "Ensemble"):
    """Metrics row, classification report and confusion matrix of an ensemble."""
    out = ens.transform(test, label).select("label", "score", "prediction").persist()  # all members score each row once
    try:
        m = evaluate(out).withColumn("name", F.lit(name))
        return m, class_report(out), confusion_matrix(out)
    finally:
        out.unpersist()


ENSEMBLE_TYPES = ("voting", "stacking", "bagging", "weighted")


def train_ensemble(kind: str, names, train, test, features, label="Class", params=None,
                   weights=None, save_path=None, members=None):
    """Build, evaluate (and save) one ensemble; ``members`` reuses fitted base models."""
    p = params or {}
    if kind == "voting":
        e = voting(names, train, features, label, p.get("voting", "soft"), members=members)
    elif kind == "stacking":
        e = stacking(names, train, features, label, p.get("cv", 5), members=members)
    elif kind == "bagging":
        e = bagging(list(names)[0], train, features, label, p.get("n_estimators", 10),
                    p.get("max_samples", 0.8), p.get("max_features", 0.8))
    elif kind == "weighted":
        e = weighted(names, train, features, label, weights, members=members)
    else:
        raise ValueError(f"Unknown ensemble type: {kind}")
    metrics, _, _ = evaluate_ensemble(e, test, label, f"{kind.title()} Ensemble")
    if save_path:
        e.save(save_path)
    return e, metrics.first().asDict()


def compare_ensembles(names, train, test, features, label="Class",
                      types=("voting", "stacking", "weighted"), save_dir=None,
                      members=None, prebuilt=None) -> DataFrame:
    """One metrics row per ensemble type, best ROC-AUC first.

    ``members`` (fitted base models) are shared by every type; ``prebuilt``
    maps a type to an already fitted Ensemble.
    """
    spark = train.sparkSession
    rows = []
    members = members or fit_members(names, train, features, label)
    prebuilt = prebuilt or {}
    for t in types:
        try:
            if t in prebuilt:
                mt, _, _ = evaluate_ensemble(prebuilt[t], test, label)
                m = mt.first().asDict()
            else:
                _, m = train_ensemble(t, names, train, test, features, label,
                                      members=None if t == "bagging" else members)
            rows.append((t, m["roc_auc"], m["f1"], m["precision"], m["recall"], m["accuracy"]))
            rows[-1] += (None,)
        except Exception as e:  # noqa: BLE001 - one failed type doesn't stop the others
            rows.append((t, None, None, None, None, None, f"{type(e).__name__}: {e}"[:500]))
    df = spark.createDataFrame(rows, "ensemble_type string, roc_auc double, f1 double, "
                                     "precision double, recall double, accuracy double, error string") \
        .orderBy(F.desc_nulls_last("roc_auc"), "ensemble_type")
    if save_dir:
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(
            os.path.join(save_dir, "ensemble_comparison"))
    return df
