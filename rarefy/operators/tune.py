"""Parameter search by cross-validation on stratified hash folds.

Points keep the original parameter names; ``to_mllib`` maps them onto MLlib
parameters (those without an MLlib equal are listed in ``UNMAPPED`` and
ignored). Points with equal mapped parameters are one class: it is fitted once
per fold, and its scores go to all of its points. Fits of classes and folds run
side by side (``parallelism``), those of logistic regressions in shared passes (``lr_batch``);
results hold every fold's score, their mean,
standard deviation and rank, and the mean score on the training folds. The
best point is refitted on all training rows.

``adaptive_search`` is successive halving: all trials on a small hashed share of
the rows, the best third of them on three times as many rows, and so on to all
rows, within a number of trials and a time limit.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import time
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import HASH_BITS, uniform_hash
from ..session import SPREAD_LEAST, parts_side_by_side
from . import lr_batch
from .models import FittedModel
from .split import class_counts, stratified_kfold

# The search grids, with the original parameter names.
PARAM_GRIDS = {
    "LogisticRegression": {"C": [0.01, 0.1, 1, 10, 100], "penalty": ["l1", "l2"],
                           "solver": ["liblinear", "saga"]},
    "RandomForest": {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 20, None],
                     "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
                     "class_weight": ["balanced", "balanced_subsample"]},
    "XGBoost": {"n_estimators": [50, 100, 200], "max_depth": [3, 5, 7],
                "learning_rate": [0.01, 0.1, 0.2], "scale_pos_weight": [1, 10, 50],
                "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0]},
    "LightGBM": {"n_estimators": [50, 100, 200], "max_depth": [3, 5, 7, -1],
                 "learning_rate": [0.01, 0.1, 0.2], "num_leaves": [31, 50, 100],
                 "class_weight": ["balanced", None]},
    "GradientBoosting": {"n_estimators": [50, 100, 200], "max_depth": [3, 5, 7],
                         "learning_rate": [0.01, 0.1, 0.2], "min_samples_split": [2, 5, 10],
                         "min_samples_leaf": [1, 2, 4]},
}
UNMAPPED = {"solver", "min_samples_split", "num_leaves", "gamma", "reg_alpha", "reg_lambda"}
#: deepest trees that MLlib grows
MAX_DEPTH = 30
#: so many logistic fits and more of an adaptive search share their passes over few rows, too
BATCH_FITS = 20
FAMILY = {"LogisticRegression": "lr", "RandomForest": "rf", "XGBoost": "gbt",
          "LightGBM": "gbt", "GradientBoosting": "gbt", "CatBoost": "gbt"}


def param_grids() -> dict:
    return {k: {p: list(v) for p, v in g.items()} for k, g in PARAM_GRIDS.items()}


def grid_points(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def _weight_name(point: dict) -> str:
    if "scale_pos_weight" in point:
        return f"_w_spw_{point['scale_pos_weight']}"
    cw = point.get("class_weight", "balanced")
    return "_w_bal" if cw in ("balanced", "balanced_subsample") else "_w_one"


def _class_weights(name: str, counts: dict) -> dict:
    """The weights of ``_weight`` by class."""
    if name == "_w_bal":
        return {c: sum(counts.values()) / (len(counts) * n) for c, n in counts.items()}
    return {c: float(name.removeprefix("_w_spw_")) if name != "_w_one" and c == 1 else 1.0 for c in counts}


def _weight(name: str, label: str, counts: dict):
    """The weight column of a name: balanced, one, or a factor on positives."""
    if name == "_w_one":
        return F.lit(1.0)
    if name == "_w_bal":
        total = sum(counts.values())
        bal = F.create_map(*sum([[F.lit(c), F.lit(total / (len(counts) * n))] for c, n in counts.items()], []))
        return F.element_at(bal, F.col(label))
    return F.when(F.col(label) == 1, F.lit(float(name.removeprefix("_w_spw_")))).otherwise(F.lit(1.0))


def to_mllib(model_name: str, point: dict, n_train: int) -> dict:
    """Original parameter point -> MLlib parameter values."""
    fam = FAMILY[model_name]
    out = {"weightCol": _weight_name(point)}
    if fam == "lr":
        c = float(point.get("C", 1.0))
        out.update(regParam=1.0 / (c * max(n_train, 1)),
                   elasticNetParam=1.0 if point.get("penalty") == "l1" else 0.0)
    elif fam == "rf":
        md = point.get("max_depth")
        out.update(numTrees=int(point.get("n_estimators", 100)),
                   maxDepth=MAX_DEPTH if md is None else min(MAX_DEPTH, int(md)),
                   minInstancesPerNode=int(point.get("min_samples_leaf", 1)))
        if "max_features" in point:
            out["featureSubsetStrategy"] = point["max_features"] or "all"
    else:
        md = point.get("max_depth", 3)
        out.update(maxIter=int(point.get("n_estimators", 100)),
                   maxDepth=8 if md in (None, -1) else int(md),
                   stepSize=float(point.get("learning_rate", 0.1)),
                   subsamplingRate=float(point.get("subsample", 1.0)),
                   minInstancesPerNode=int(point.get("min_child_samples", point.get("min_samples_leaf", 1))))
        cs = point.get("colsample_bytree")
        if cs is not None:
            out["featureSubsetStrategy"] = "all" if float(cs) >= 1.0 else repr(float(cs))
    return out


def _estimator(model_name: str, label: str):
    fam = FAMILY[model_name]
    if fam == "lr":
        return LogisticRegression(featuresCol="features", labelCol=label, maxIter=100)
    if fam == "rf":
        return RandomForestClassifier(featuresCol="features", labelCol=label, seed=42)
    return GBTClassifier(featuresCol="features", labelCol=label, seed=42)


def _evaluator(scoring: str, label: str):
    if scoring == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                             metricName="areaUnderROC", numBins=0)
    if scoring == "f1":
        return MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel",
                                                 metricLabel=1.0)
    if scoring == "accuracy":
        return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    raise ValueError(scoring)


RESULTS = ("point int, params string, mean_score double, std_score double, rank int, fold_scores array<double>, "
           "mean_train_score double, fitted_as int")


def _fit(model_name: str, mapped: dict, rows: DataFrame, label: str, counts: dict):
    est = _estimator(model_name, label)
    data = rows.withColumn("_w", _weight(mapped["weightCol"], label, counts))
    params = {est.getParam(k): ("_w" if k == "weightCol" else v) for k, v in mapped.items()}
    return est.fit(data, params), data


def _scored(model_name: str, maps: list[dict], folded: DataFrame, label: str, counts: dict, cv: int, scoring: str,
            parallelism: int, known: dict, deadline: float | None = None, together: bool = False) -> dict:
    """{mapped parameters as JSON: (fold scores, training scores)} of the maps. ``known`` has those of earlier
    calls over the same folds. Logistic fits of many rows share their passes, and with ``together`` many fits of few rows. After the deadline no further fit starts, and maps without all folds are missing."""
    ev = _evaluator(scoring, label)
    todo = [(k, m, f) for k, m in {json.dumps(m, sort_keys=True): m for m in maps}.items() if k not in known for f in range(cv)]
    if FAMILY[model_name] == "lr" and scoring == "roc_auc" and deadline is None and set(counts) == {0, 1} \
            and todo and (sum(counts.values()) >= SPREAD_LEAST or together and len(todo) >= BATCH_FITS):
        new = {k: m for k, m, _ in todo}
        got = lr_batch.fold_scores(list(new.values()), [_class_weights(m["weightCol"], counts) for m in new.values()], folded, label, cv)
        if got is not None:
            known.update(zip(new, got))
            todo = []

    def one(job):
        key, mapped, fold = job
        if deadline is not None and time.monotonic() > deadline:
            return key, fold, None
        model, data = _fit(model_name, mapped, folded.where(F.col("fold") != fold), label, counts)
        return key, fold, (float(ev.evaluate(model.transform(folded.where(F.col("fold") == fold)))), float(ev.evaluate(model.transform(data))))

    found: dict = {}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        for key, fold, got in ex.map(one, todo):
            if got is not None:
                found.setdefault(key, {})[fold] = got
    for key, by_fold in found.items():
        if len(by_fold) == cv:
            known[key] = tuple([by_fold[f][i] for f in range(cv)] for i in (0, 1))
    return {k: known[k] for k in {json.dumps(m, sort_keys=True) for m in maps} if k in known}


def _assembled(train: DataFrame, features, label: str) -> tuple[VectorAssembler, DataFrame]:
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    keep = [c for c in ("row_id",) if c in train.columns]
    return va, va.transform(train).select(*keep, label, "features")


def _compact(df: DataFrame, n: int, parallelism: int) -> DataFrame:
    """All of the n rows kept in the partitions of a search."""
    return df.coalesce(parts_side_by_side(n, df.sparkSession.sparkContext.defaultParallelism, parallelism)).persist()


def _share_of(folded: DataFrame, wanted, n: int, parallelism: int) -> DataFrame:
    """The wanted n rows, dealt out by row_id: a coalesced partition would read many whole partitions of all rows."""
    parts = parts_side_by_side(n, folded.sparkSession.sparkContext.defaultParallelism, parallelism)
    return folded.where(wanted).repartition(parts, "row_id").persist()


def _refit(model_name, point, score, va, rows, features, label, counts, n) -> FittedModel:
    model, _ = _fit(model_name, to_mllib(model_name, point, n), rows, label, counts)
    return FittedModel(model_name, FAMILY[model_name], list(features), label, PipelineModel(stages=[va, model]),
                       {"best_params": point, "best_score": score})


def cross_validate(model_name: str, points, train: DataFrame, features, label: str = "Class",
                   cv: int = 5, scoring: str = "roc_auc", parallelism: int = 8, seed: int = 42, known: dict | None = None):
    """Evaluate every point with k-fold CV; refit the best on all rows.

    Returns (FittedModel of the best point, results DataFrame). Searches over the same rows and
    seed that share a dictionary ``known`` fit no class of points twice.
    """
    spark = train.sparkSession
    points = list(points)
    va, rows = _assembled(train, features, label)
    counts = class_counts(rows, label)
    n = sum(counts.values())
    folded = _compact(stratified_kfold(rows, label, cv, seed), n, parallelism)
    maps = [to_mllib(model_name, p, int(n * (cv - 1) / cv)) for p in points]
    keys = [json.dumps(m, sort_keys=True) for m in maps]
    found = _scored(model_name, maps, folded, label, counts, cv, scoring, parallelism, {} if known is None else known)
    means = np.array([np.mean(found[k][0]) for k in keys])
    ranks = [1 + int((means > m).sum()) for m in means]
    out = [(i, json.dumps(p, default=str), float(means[i]), float(np.std(found[k][0])), ranks[i], found[k][0], float(np.mean(found[k][1])), keys.index(k))
           for i, (p, k) in enumerate(zip(points, keys))]
    res = spark.createDataFrame(out, RESULTS).orderBy("rank", "point")
    best = int(np.argmax(means))
    fitted = _refit(model_name, points[best], float(means[best]), va, folded, features, label, counts, n)
    folded.unpersist()
    return fitted, res


def grid_search(model_name, grid, train, features, label="Class", cv=5, scoring="roc_auc",
                parallelism=8, seed=42, known=None):
    return cross_validate(model_name, grid_points(grid), train, features, label, cv, scoring, parallelism, seed, known)


def random_search(model_name, grid, train, features, label="Class", n_iter=50, cv=5,
                  scoring="roc_auc", parallelism=8, seed=42, known=None):
    """n_iter distinct grid points in seeded hash order (all points if fewer)."""
    pts = grid_points(grid)
    order = sorted(range(len(pts)), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
    chosen = [pts[i] for i in order[:n_iter]]
    return cross_validate(model_name, chosen, train, features, label, cv, scoring, parallelism, seed, known)


# Search ranges of the adaptive search. (low, high, log scale, integer), or a list of categories.
SEARCH_SPACES = {
    "XGBoost": {"n_estimators": (50, 500, False, True), "max_depth": (3, 10, False, True), "learning_rate": (0.01, 0.3, True, False),
                "scale_pos_weight": (1, 100, True, False), "subsample": (0.6, 1.0, False, False), "colsample_bytree": (0.6, 1.0, False, False),
                "gamma": (0, 10, False, False), "reg_alpha": (1e-8, 10.0, True, False), "reg_lambda": (1e-8, 10.0, True, False)},
    "LightGBM": {"n_estimators": (50, 500, False, True), "max_depth": (3, 15, False, True), "learning_rate": (0.01, 0.3, True, False),
                 "num_leaves": (20, 200, False, True), "min_child_samples": (5, 100, False, True), "subsample": (0.6, 1.0, False, False),
                 "colsample_bytree": (0.6, 1.0, False, False), "reg_alpha": (1e-8, 10.0, True, False), "reg_lambda": (1e-8, 10.0, True, False)},
    "RandomForest": {"n_estimators": (50, 500, False, True), "max_depth": (5, 50, False, True), "min_samples_split": (2, 20, False, True),
                     "min_samples_leaf": (1, 10, False, True), "max_features": ["sqrt", "log2", None],
                     "class_weight": ["balanced", "balanced_subsample", None]},
    "LogisticRegression": {"C": (1e-5, 100.0, True, False), "penalty": ["l1", "l2"], "solver": ["liblinear", "saga"]},
}


def drawn_point(space: dict, seed: int, trial: int) -> dict:
    """The trial's point, by hash of seed, trial and parameter."""
    out = {}
    for name, rng in space.items():
        u = int(hashlib.md5(f"{seed}:{trial}:{name}".encode()).hexdigest()[:13], 16) / 16 ** 13
        if isinstance(rng, list):
            out[name] = rng[int(u * len(rng))]
            continue
        lo, hi, log, integer = rng
        v = math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))) if log else lo + u * (hi - lo + integer)
        out[name] = min(int(v), hi) if integer else v
    return out


def adaptive_search(model_name, train, features, label="Class", n_trials=100, timeout=None, cv=5,
                    scoring="roc_auc", parallelism=8, seed=42, eta=3, min_rows=1000):
    """Successive halving. Each rung scores its trials on a hashed share of the rows (nested; about ``min_rows``
    at least in the first), and the best 1 / ``eta`` go on to ``eta`` times the rows, up to all of them.

    ``timeout`` (seconds): no further fit starts after it; the rung in work keeps the trials that are complete. The
    first trial is always scored. Returns (FittedModel of the best trial of the last rung, refitted on all rows;
    results: rung, share, n_rows, trial, params, mean_score, fold_scores, kept).
    """
    spark = train.sparkSession
    deadline = None if timeout is None else time.monotonic() + timeout
    space = SEARCH_SPACES[model_name]
    va, rows = _assembled(train, features, label)
    all_counts = class_counts(rows, label)
    n = sum(all_counts.values())
    folded = _compact(stratified_kfold(rows, label, cv, seed), n, parallelism)
    points = [drawn_point(space, seed, t) for t in range(n_trials)]
    rungs = max(0, min(math.floor(math.log(max(1, n / min_rows), eta)), math.floor(math.log(max(1, n_trials), eta))))
    alive, out, last = list(range(n_trials)), [], []
    for rung in range(rungs + 1):
        share = 1 / eta ** (rungs - rung)
        wanted = uniform_hash("row_id", seed, "rung") < F.lit(int(share * 2 ** HASH_BITS))
        counts = all_counts if rung == rungs else class_counts(folded.where(wanted), label)
        size = sum(counts.values())
        part = folded if rung == rungs else _share_of(folded, wanted, size, parallelism)
        maps = {t: to_mllib(model_name, points[t], int(size * (cv - 1) / cv)) for t in alive}
        known: dict = {}
        if deadline is not None and not last:  # the first trial, whatever the time
            _scored(model_name, [maps[alive[0]]], part, label, counts, cv, scoring, parallelism, known)
        found = _scored(model_name, list(maps.values()), part, label, counts, cv, scoring, parallelism, known, deadline, together=True)
        scores = {t: found[k] for t, k in ((t, json.dumps(m, sort_keys=True)) for t, m in maps.items()) if k in found}
        if not scores:
            break
        last = sorted(scores, key=lambda t: (-np.mean(scores[t][0]), t))
        alive = last[:max(1, math.ceil(len(last) / eta))]
        out += [(rung, share, size, t, json.dumps(points[t], default=str), float(np.mean(scores[t][0])), scores[t][0], t in alive) for t in last]
        best_score = float(np.mean(scores[last[0]][0]))
        if rung < rungs:
            part.unpersist()
        if deadline is not None and time.monotonic() > deadline:
            break
    fitted = _refit(model_name, points[last[0]], best_score, va, folded, features, label, all_counts, n)
    folded.unpersist()
    res = spark.createDataFrame(out, "rung int, share double, n_rows long, trial int, params string, mean_score double, fold_scores array<double>, kept boolean")
    return fitted, res.orderBy(F.desc("rung"), F.desc("mean_score"), "trial")


def compare_tuning(model_name, grid, train, features, label="Class", n_iter_random=30,
                   n_trials_adaptive=50, cv=5, parallelism=8, scoring="roc_auc", seed=42, known=None, save_dir=None, timeout=None) -> DataFrame:
    """Best cross-validated score of each search method, one table (with ``save_dir``, also as CSV)."""
    spark = train.sparkSession
    known = {} if known is None else known
    runs = [("grid", *grid_search(model_name, grid, train, features, label, cv, scoring, parallelism, seed, known)),
            ("random", *random_search(model_name, grid, train, features, label, n_iter_random, cv, scoring, parallelism, seed, known))]
    if model_name in SEARCH_SPACES:
        runs.append(("adaptive", *adaptive_search(model_name, train, features, label, n_trials_adaptive, timeout, cv, scoring, parallelism, seed)))
    rows = [(name, m.extra["best_score"], res.count(), json.dumps(m.extra["best_params"], default=str)) for name, m, res in runs]
    out = spark.createDataFrame(rows, "method string, best_cv_score double, n_evaluated long, best_params string").orderBy(F.desc("best_cv_score"), "method")
    if save_dir:
        out.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{save_dir}/tuning_comparison")
    return out
