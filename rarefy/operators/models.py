"""MLlib classifiers with class-imbalance weights, scoring and persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_weight_table(df: DataFrame, label: str = "Class") -> DataFrame:
    """'balanced' weights n / (k * n_c) per class (a #classes-row table)."""
    g = df.groupBy(label).agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in g)
    k = len(g)
    rows = [(r[label], r["n"], total / (k * r["n"])) for r in g]
    return df.sparkSession.createDataFrame(rows, f"{label} int, n long, weight double")


def knn_classify(train: DataFrame, test: DataFrame, features, label: str = "Class", k: int = 5,
                 id_col: str = "row_id") -> DataFrame:
    """k-nearest-neighbour vote: score = share of positive neighbours. A row that has no
    neighbours, since a feature is null, gets the share of positives in ``train``."""
    from .knn import knn_join
    nn = knn_join(test, train, features, k, id_col, ref_cols=[label])
    votes = nn.groupBy(F.col("q_id").alias(id_col)).agg(F.avg(F.col(label).cast("double")).alias("score"))
    prior = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return test.select(id_col, F.col(label).alias("label")).join(votes, on=id_col, how="left") \
        .withColumn("score", F.coalesce("score", F.lit(prior))) \
        .withColumn("prediction", (F.col("score") > F.lit(0.5)).cast("int"))


# ---------------------------------------------------------------------------
# Classifiers
# ---------------------------------------------------------------------------

import json  # noqa: E402
import math  # noqa: E402
import os  # noqa: E402
from concurrent.futures import ThreadPoolExecutor  # noqa: E402
from dataclasses import dataclass, field  # noqa: E402

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402  (module-level: pandas UDF type hints are resolved here)
from pyspark.ml import Pipeline, PipelineModel  # noqa: E402
from pyspark.ml.classification import (GBTClassifier, LinearSVC,  # noqa: E402
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402

from . import cell_trees  # noqa: E402
from .cells import bin_column, binned  # noqa: E402
from .feature_stage import FeatureStage  # noqa: E402
from .metrics import evaluate  # noqa: E402

# Model presets. The four boosters map onto MLlib's GBT with
# their usual defaults (rounds, depth, learning rate); imbalance handling as
# in the original configuration ('balanced' weights or neg/pos on positives).
PRESETS = {
    "LogisticRegression": dict(kind="lr", maxIter=1000, C=1.0, weights="balanced"),
    "RandomForest": dict(kind="rf", numTrees=100, maxDepth=10, weights="balanced", seed=42),
    "XGBoost": dict(kind="gbt", maxIter=100, maxDepth=6, stepSize=0.3, weights="scale_pos", seed=42),
    "LightGBM": dict(kind="gbt", maxIter=100, maxDepth=8, stepSize=0.1, weights="balanced", seed=42),
    "CatBoost": dict(kind="gbt", maxIter=100, maxDepth=6, stepSize=0.05, weights=None, seed=42),
    "GradientBoosting": dict(kind="gbt", maxIter=100, maxDepth=3, stepSize=0.1, weights=None, seed=42),
    "KNN": dict(kind="knn", k=5),
    "SVM": dict(kind="svm", n_components=100, weights="balanced", seed=42),
}
DEFAULT_MODELS = ["LogisticRegression", "RandomForest", "XGBoost", "LightGBM"]


def weight_column(df: DataFrame, label: str, how) -> tuple:
    """Return (df with ``_w``, class->weight map) for the imbalance rule."""
    if how is None:
        return df.withColumn("_w", F.lit(1.0)), {}
    if isinstance(how, str) and how.startswith("col:"):
        return df.withColumn("_w", F.col(how[4:]).cast("double")), {}
    rows = df.groupBy(label).agg(F.count("*").alias("n")).collect()
    counts = {r[label]: r["n"] for r in rows}
    if how == "balanced":
        total, k = sum(counts.values()), len(counts)
        wmap = {c: total / (k * n) for c, n in counts.items()}
    elif how == "scale_pos":
        pos, neg = counts.get(1, 0), counts.get(0, 0)
        wmap = {0: 1.0, 1: (neg / pos) if pos > 0 else 1.0}
    else:
        raise ValueError(how)
    m = F.create_map(*sum([[F.lit(c), F.lit(float(w))] for c, w in wmap.items()], []))
    return df.withColumn("_w", F.coalesce(F.element_at(m, F.col(label)), F.lit(1.0))), wmap


@dataclass
class FittedModel:
    """A fitted classifier: MLlib PipelineModel plus score post-processing."""
    name: str
    kind: str
    features: list
    label: str
    pipeline: PipelineModel | None
    extra: dict = field(default_factory=dict)
    knn_train: DataFrame | None = None
    stage: FeatureStage | None = None

    def transform(self, df: DataFrame, keep=("row_id",)) -> DataFrame:
        """Add ``score`` (P(class 1), or decision value) and ``prediction``. A model with a feature stage takes raw rows."""
        if self.stage is not None:
            df = self.stage.transform(df)
        if self.kind == "knn":
            out = knn_classify(self.knn_train, df, self.features, self.label, self.extra["k"])
            return out.drop("label").join(df, on="row_id")
        if self.kind == "svm":
            # stages before the classifier (e.g. the scaler), random features, classifier
            pre = PipelineModel(stages=list(self.pipeline.stages[:-1]))
            d = pre.transform(df) if pre.stages else df
            d = d.withColumn("features", rff_features(self.features, self.extra))
            t = self.pipeline.stages[-1].transform(d)
        else:
            t = self.pipeline.transform(df)
        if self.kind == "svm":
            m = vector_to_array("rawPrediction")[1]
            a, b = self.extra["platt_a"], self.extra["platt_b"]
            s = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(a) * m + F.lit(b)))
        else:
            s = vector_to_array("probability")[1]
        t = t.withColumn("score", s)
        pred = (F.col("score") > F.lit(0.5)).cast("int") if self.kind == "svm" else \
            F.col("prediction").cast("int")
        t = t.withColumn("prediction", pred)
        return t.drop("features", "rawPrediction", "probability", "_w", *[bin_column(f) for f in self.features])

    @property
    def feature_importances(self):
        last = self.pipeline.stages[-1] if self.pipeline is not None else None
        return getattr(last, "featureImportances", None)

    def save(self, path: str):
        """One artefact directory: the PipelineModel (scaler stage included) + metadata."""
        meta = dict(name=self.name, kind=self.kind, features=self.features, label=self.label,
                    extra=self.extra, stage=self.stage and self.stage.to_dict())
        if self.pipeline is not None:
            self.pipeline.write().overwrite().save(os.path.join(path, "pipeline"))
        if self.knn_train is not None:
            self.knn_train.write.mode("overwrite").parquet(os.path.join(path, "knn_train"))
        spark = SparkSessionRef.get()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(path, "meta"))


class SparkSessionRef:
    @staticmethod
    def get():
        from pyspark.sql import SparkSession
        return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def load_model(path: str) -> FittedModel:
    """Restore a saved model; a missing path raises FileNotFoundError."""
    spark = SparkSessionRef.get()
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        raise FileNotFoundError(f"no saved model under {path}")
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    pipe = None
    if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "pipeline"))):
        pipe = PipelineModel.load(os.path.join(path, "pipeline"))
    knn = None
    if meta["kind"] == "knn":
        knn = spark.read.parquet(os.path.join(path, "knn_train"))
    return FittedModel(meta["name"], meta["kind"], meta["features"], meta["label"], pipe,
                       meta["extra"], knn, FeatureStage.from_dict(meta["stage"]) if meta.get("stage") else None)


def rff_params(n_in: int, d_out: int, gamma: float, seed: int) -> dict:
    """Random Fourier features of an RBF kernel: z(x) = sqrt(2/D) cos(W x + b)."""
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(d_out, n_in))
    b = rng.uniform(0.0, 2.0 * math.pi, size=d_out)
    return {"rff_W": W.tolist(), "rff_b": b.tolist(), "rff_scale": math.sqrt(2.0 / d_out)}


def rff_features(features, extra) -> "Column":
    """The projection as one Arrow-batched numpy matmul (a D x d literal
    expression tree would exceed the JIT's method size), as an ML vector."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.functions import pandas_udf
    from ..session import ship_package
    ship_package(SparkSessionRef.get())  # a pool's thread has no active session of its own

    W = np.asarray(extra["rff_W"], dtype=float)
    b = np.asarray(extra["rff_b"], dtype=float)
    scale = float(extra["rff_scale"])

    @pandas_udf("array<double>")
    def rff(x: pd.DataFrame) -> pd.Series:
        Z = scale * np.cos(x.to_numpy(dtype=float) @ W.T + b)
        return pd.Series(list(Z))

    cols = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    return array_to_vector(rff(F.struct(*cols)))


def _fit_cells(est, kind: str, data: DataFrame, features, label: str) -> PipelineModel | None:
    """Trees fitted to cells: grown in tasks of their own, or by MLlib where these don't do (many cells, other parameters).
    None where cells don't pay, and for a forest that isn't grown here."""
    found = binned(data, features, label, est.getMaxBins())
    if found is None:
        return None
    bins, cells = found
    cols = bins.getOutputCols()
    try:
        va = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
        about = cells.agg(F.count(F.lit(1)).alias("n"), F.collect_set(label).alias("classes")).first()
        if cell_trees.suits(est, kind, about["n"]) and set(about["classes"]) == {0, 1}:
            return PipelineModel(stages=[bins, va, cell_trees.grow(est, kind, cells, cols, label, est.getSeed())])
        return None if kind == "rf" else PipelineModel(stages=[bins, *Pipeline(stages=[va, est]).fit(cells).stages])
    finally:
        cells.unpersist()


def fit_model(name: str, train: DataFrame, features, label: str = "Class",
              val: DataFrame | None = None, preset: dict | None = None,
              scaler_stage=None, params: dict | None = None) -> FittedModel:
    """Fit one preset (or explicit ``preset`` dict) on ``train``."""
    cfg = dict(PRESETS[name] if preset is None else preset)
    cfg.update(params or {})
    kind = cfg.pop("kind")
    features = list(features)
    if kind == "knn":
        return FittedModel(name, kind, features, label, None, {"k": cfg.get("k", 5)},
                           train.select("row_id", *features, label))
    how = cfg.pop("weights", None)
    data, _ = weight_column(train, label, how)
    if val is not None and kind == "gbt":
        vdata = val.withColumn("_w", F.lit(1.0))
        data = data.withColumn("_is_val", F.lit(False)).unionByName(vdata.withColumn("_is_val", F.lit(True)))
    stages = [scaler_stage] if scaler_stage is not None else []
    stages.append(VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"))
    extra = {}
    if kind == "lr":
        n = data.count()
        c = cfg.pop("C", 1.0)
        est = LogisticRegression(featuresCol="features", labelCol=label, weightCol="_w",
                                 maxIter=cfg.pop("maxIter", 100), regParam=1.0 / (c * max(n, 1)),
                                 elasticNetParam=cfg.pop("elasticNetParam", 0.0))
    elif kind == "rf":
        # the same trees; a row's node in each tree is kept from level to level instead of being sought from the root
        est = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="_w",
                                     **{"cacheNodeIds": True, "checkpointInterval": -1} | cfg)
        # weights by class only: the rows of a cell have one weight
        if scaler_stage is None and how in (None, "balanced", "scale_pos") and cell_trees.suits(est, kind, 0):
            model = _fit_cells(est, kind, data, features, label)
            if model is not None:
                return FittedModel(name, kind, features, label, model, extra)
    elif kind == "gbt":
        if val is not None:
            cfg["validationIndicatorCol"] = "_is_val"
        est = GBTClassifier(featuresCol="features", labelCol=label, weightCol="_w", **cfg)
        if val is None and scaler_stage is None and est.getSubsamplingRate() == 1.0:
            model = _fit_cells(est, kind, data, features, label)
            if model is not None:
                return FittedModel(name, kind, features, label, model, extra)
    elif kind == "svm":
        var = data.select(*[F.var_pop(F.col(f).cast("double")).alias(f) for f in features]).first()
        xvar = float(np.mean([var[f] or 0.0 for f in features])) or 1.0
        gamma = cfg.pop("gamma", None) or 1.0 / (len(features) * xvar)  # 'scale' rule
        extra.update(gamma=gamma, **rff_params(len(features), cfg.pop("n_components", 100),
                                                 gamma, cfg.pop("seed", 42)))
        n = data.count()
        c = cfg.pop("C", 1.0)  # hinge loss + ||w||^2 / (2 C n): the C = 1 of the kernel machine
        feats = data.withColumn("features", rff_features(features, extra))
        svc = LinearSVC(featuresCol="features", labelCol=label, weightCol="_w", tol=1e-4,
                        maxIter=cfg.pop("maxIter", 100), regParam=1.0 / (c * max(n, 1))).fit(feats)
        # Platt scaling on the training margins (one-feature logistic regression)
        m = svc.transform(feats).withColumn("_m", vector_to_array("rawPrediction")[1])
        platt = LogisticRegression(featuresCol="_mv", labelCol=label, maxIter=100, regParam=0.0) \
            .fit(VectorAssembler(inputCols=["_m"], outputCol="_mv").transform(m.select("_m", label)))
        extra["platt_a"] = -float(platt.coefficients[0])
        extra["platt_b"] = -float(platt.intercept)
        pre = stages[:-1]  # an explicit scaler stage, if any; not the assembler
        model = PipelineModel(stages=[*pre, svc]) if not pre else \
            PipelineModel(stages=[*Pipeline(stages=pre).fit(data).stages, svc])
        return FittedModel(name, kind, features, label, model, extra)
    else:
        raise ValueError(kind)
    model = Pipeline(stages=stages + [est]).fit(data)
    return FittedModel(name, kind, features, label, model, extra)



def with_scaler(model: FittedModel, scaler_stage) -> FittedModel:
    """Prepend the fitted scaler so scaler and classifier are one artefact."""
    if model.pipeline is None or scaler_stage is None:
        return model
    return FittedModel(model.name, model.kind, model.features, model.label,
                       PipelineModel(stages=[scaler_stage] + list(model.pipeline.stages)),
                       model.extra, model.knn_train)


def score(model: FittedModel, df: DataFrame) -> DataFrame:
    """Probability of class 1 (``score``) and decision (``prediction``)."""
    return model.transform(df)


def metrics_of(scored: DataFrame, label: str = "Class") -> dict:
    """All metrics of a scored table; scores are computed once (persisted)."""
    src = scored.select(F.col(label).alias("label"), "score", "prediction").persist()
    try:
        return evaluate(src).first().asDict()
    finally:
        src.unpersist()


@dataclass
class TrainResult:
    model: FittedModel
    train_metrics: dict
    test_metrics: dict


def train_model(name: str, train: DataFrame, features, label: str = "Class",
                test: DataFrame | None = None, val: DataFrame | None = None,
                save_path: str | None = None, preset: dict | None = None,
                params: dict | None = None, scaler_stage=None) -> TrainResult:
    """Fit, evaluate on train and test, optionally save (scaler included)."""
    m = fit_model(name, train, features, label, val=val, preset=preset, params=params)
    trm = metrics_of(m.transform(train), label)
    tem = metrics_of(m.transform(test), label) if test is not None else {}
    m = with_scaler(m, scaler_stage)
    if save_path:
        m.save(save_path)
    return TrainResult(m, trm, tem)


COMPARISON_SCHEMA = ("model string, roc_auc double, f1 double, precision double, recall double, accuracy double, "
                     "error string")


def comparison_table(spark, results: dict, errors: dict | None = None) -> DataFrame:
    """One row per requested model; ``error`` is null where it was fitted."""
    keys = ("roc_auc", "f1", "precision", "recall", "accuracy")
    rows = [(n, *[None if r is None else r.test_metrics.get(k) for k in keys], (errors or {}).get(n)) for n, r in results.items()]
    return spark.createDataFrame(rows, COMPARISON_SCHEMA).orderBy(F.desc_nulls_last("roc_auc"), "model")


def train_many(train: DataFrame, test: DataFrame, features, label: str = "Class",
               names=None, val: DataFrame | None = None, save_dir: str | None = None,
               parallelism: int = 4, scaler_stage=None):
    """Fit several presets concurrently (Spark schedules the jobs).

    Returns (results dict, comparison DataFrame sorted by ROC-AUC). A model that fails has the
    result None and a row of the table with its error.
    """
    names = list(names or DEFAULT_MODELS)
    errors = {}
    train = train.persist()

    def one(n):
        try:
            path = os.path.join(save_dir, f"{n}_model") if save_dir else None
            return n, train_model(n, train, features, label, test, val, path, scaler_stage=scaler_stage)
        except Exception as e:  # noqa: BLE001 - one failed model doesn't stop the others
            errors[n] = f"{type(e).__name__}: {e}"[:500]
            return n, None

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        results = dict(ex.map(one, names))
    train.unpersist()
    table = comparison_table(train.sparkSession, results, errors)
    if save_dir:
        table.coalesce(1).write.mode("overwrite").option("header", True) \
            .csv(os.path.join(save_dir, "model_comparison"))
    return results, table
