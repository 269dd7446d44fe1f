"""Registered queries that fit models (rows-only checks: no SQL equal)."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import functions as F

from ..functions.exprs import risk_band
from ..operators import ensemble_fit as EF
from ..operators import features as FE
from ..operators import models as MD
from ..operators import profile as P
from ..operators import select as S
from ..operators import split as SP
from ..operators import tune as TU
from ..operators.feature_stage import fit_stage
from ..operators.resample import handle_imbalance
from ..operators.scale import fit_scaler
from ..session import checkpoint_dir, cut_lineage, spread
from ..sources import tables as T
from .common import SPLIT_SEED, TEST_SIZE

MODEL_FEATURES = ["Time", "Amount", "Time_Hours", "Time_Hours_Sin", "Time_Hours_Cos",
                  "Is_Night", "Is_Morning", "Is_Afternoon", "Is_Evening", "Amount_Log",
                  "Amount_Bin", "Is_High_Amount", "Is_Very_High_Amount", "Is_Low_Amount",
                  "Amount_ZScore"]
ENSEMBLE_MEMBERS = ["LogisticRegression", "RandomForest", "GradientBoosting"]


def work_dir(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), "rarefy-out", f"{name}-{uuid.uuid4().hex[:8]}")


def engineer_with(stats):
    def f(d):
        e = FE.add_amount_features(FE.add_time_features(d), stats)
        # amounts outside the fitted decile range go to the end bins
        lo = stats.edges[0] if stats.edges else 0.0
        top = max(len(stats.edges) - 2, 0)
        e = e.withColumn("Amount_Bin", F.coalesce(
            "Amount_Bin", F.when(F.col("Amount") < F.lit(lo), F.lit(0)).otherwise(F.lit(top))))
        return e.withColumn("Amount_ZScore", F.coalesce("Amount_ZScore", F.lit(0.0)))
    return f


_MEMO = {}


def model_data(spark, sf, resample="smote", val_size=0.0):
    """ModelData is deterministic; queries of one session share it."""
    key = (id(spark), spark.sparkContext.applicationId, sf, resample, val_size)
    if key not in _MEMO:
        _MEMO[key] = ModelData(spark, sf, resample, val_size)
    return _MEMO[key]


def _memo(spark, sf, what, make):
    """Per-session cache of deterministic fits shared by several queries."""
    key = (id(spark), spark.sparkContext.applicationId, sf, what)
    if key not in _MEMO:
        _MEMO[key] = make()
    return _MEMO[key]


def trained(spark, sf, names):
    """TrainResults of presets on the shared model data; missing ones are fitted concurrently."""
    from concurrent.futures import ThreadPoolExecutor
    md = model_data(spark, sf)
    todo = [n for n in names if (id(spark), spark.sparkContext.applicationId, sf, ("fit", n)) not in _MEMO]

    def one(n):
        return n, MD.train_model(n, md.train, md.features, "Class", md.test)

    if todo:
        with ThreadPoolExecutor(max_workers=4) as ex:
            for n, r in ex.map(one, todo):
                _memo(spark, sf, ("fit", n), lambda r=r: r)
    return {n: _memo(spark, sf, ("fit", n), lambda: None) for n in names}


def members(spark, sf):
    """Members of the ensembles; a preset that this session has fitted to the same rows isn't fitted again."""
    md = model_data(spark, sf)

    def make():
        known = {n: _MEMO.get((id(spark), spark.sparkContext.applicationId, sf, ("fit", n))) for n in ENSEMBLE_MEMBERS}
        todo = [n for n, r in known.items() if r is None]
        fitted = EF.fit_members(todo, md.train, md.features, "Class") if todo else {}
        return {n: fitted[n] if r is None else r.model for n, r in known.items()}

    return _memo(spark, sf, "members", make)


def stacked(spark, sf):
    md = model_data(spark, sf)
    return _memo(spark, sf, "stacking",
                 lambda: EF.stacking(ENSEMBLE_MEMBERS, md.train, md.features, "Class",
                                     members=members(spark, sf)))


def lr_grid(spark, sf):
    md = model_data(spark, sf)
    return _memo(spark, sf, "lr_grid",
                 lambda: TU.grid_search("LogisticRegression", LR_GRID, md.train, md.features, known=lr_known(spark, sf)))


def lr_known(spark, sf):
    """Scores of the classes of points that a search of this session has fitted (same rows, folds and seed)."""
    return _memo(spark, sf, "lr_known", dict)


class ModelData:
    """Split, feature statistics and scaler fitted on the training rows only."""

    def __init__(self, spark, sf, resample="smote", val_size=0.0, tx=None):
        """``tx``: transactions to use instead of the events under ``sf``; their V columns are features, too."""
        tx = T.tx_events(spark, sf) if tx is None else tx
        self.components = T.v_columns(tx)
        self.features = MODEL_FEATURES + self.components
        n = tx.count()
        held = spread(tx, n, "row_id", "Time", "Amount").persist()  # read by each pass that looks for the split's cuts
        d = cut_lineage(SP.split_data(held, "Class", TEST_SIZE, val_size, SPLIT_SEED))
        held.unpersist()
        raw_train = d.where(F.col("split") == "train").drop("split")
        self.stats = FE.fit_amount_stats(raw_train)
        self.prepare_raw = engineer_with(self.stats)
        cols = ["row_id", *self.features, "Class"]
        train = self.prepare_raw(raw_train).select(*cols)
        self.scaler = fit_scaler(train, self.features, "standard")
        self.scaler_stage = self.scaler.as_sql_transformer(cols)
        ts = self.scaler.transform(train)
        if resample:
            ts = handle_imbalance(ts, self.features, "Class", resample, SPLIT_SEED, count=False).data
        self.train = cut_lineage(spread(ts, n, "row_id", *self.features[:2]))
        self.test_raw = self.prepare_raw(d.where(F.col("split") == "test").drop("split")).select(*cols)
        self.test = cut_lineage(self.scaler.transform(self.test_raw))
        self.val = None
        if val_size > 0:
            self.val = self.scaler.transform(
                self.prepare_raw(d.where(F.col("split") == "val").drop("split")).select(*cols))


def _metrics_row(spark, name, m: dict):
    keys = ["roc_auc", "average_precision", "accuracy", "precision", "recall", "f1", "mcc"]
    return spark.createDataFrame([(name, *[m.get(k) for k in keys])],
                                 "model string, " + ", ".join(f"{k} double" for k in keys))


def _fit_one(name):
    def q(spark, sf):
        r = trained(spark, sf, [name])[name]
        return _metrics_row(spark, name, r.test_metrics)
    q.__name__ = f"q_{name}"
    return q


GBT_PRESETS = ["XGBoost", "LightGBM", "CatBoost", "GradientBoosting"]


def q_gbt(spark, sf):
    """The four boosted-tree presets, fitted concurrently, as one metrics table."""
    res = trained(spark, sf, GBT_PRESETS)
    return _metrics_rows(spark, {n: r.test_metrics for n, r in res.items()})


def _metrics_rows(spark, by_name: dict):
    out = None
    for n, m in by_name.items():
        r = _metrics_row(spark, n, m)
        out = r if out is None else out.unionByName(r)
    return out


def q_gbt_validation(spark, sf):
    md = model_data(spark, sf, val_size=0.1)
    r = MD.train_model("XGBoost", md.train, md.features, "Class", md.test, val=md.val)
    trees = r.model.pipeline.stages[-1].getNumTrees
    return _metrics_row(spark, "XGBoost+validation", r.test_metrics).withColumn("n_trees", F.lit(trees))


def q_score(spark, sf):
    md = model_data(spark, sf)
    m = MD.fit_model("LogisticRegression", md.train, md.features)
    return MD.score(m, md.test).select("row_id", "Class", "score", "prediction")


def q_train_model(spark, sf):
    md = model_data(spark, sf)
    r = MD.train_model("LogisticRegression", md.train, md.features, "Class", md.test)
    return _metrics_row(spark, "train", r.train_metrics).unionByName(
        _metrics_row(spark, "test", r.test_metrics)).withColumnRenamed("model", "split")


def q_train_many(spark, sf):
    """Comparison table of the default presets (fits shared with the single-model queries)."""
    return MD.comparison_table(spark, trained(spark, sf, MD.DEFAULT_MODELS))


def q_write_comparison(spark, sf):
    """Comparison tables of models, ensembles and tuning as CSV, read back: rows, and whether they are the same."""
    md = model_data(spark, sf)
    out = work_dir(spark, "comparison")
    tables = {"models": MD.comparison_table(spark, trained(spark, sf, ENSEMBLE_MEMBERS)),
              "ensembles": EF.compare_ensembles(ENSEMBLE_MEMBERS, md.train, md.test, md.features, "Class", ("voting", "weighted"), members=members(spark, sf)),
              "tuning": lr_grid(spark, sf)[1].select("point", "rank", "mean_score")}
    found = None
    for name, table in tables.items():
        path = os.path.join(out, f"{name}_comparison")
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        back = spark.read.schema(table.schema).option("header", True).csv(path)
        row = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("comparison"), "n").crossJoin(  # one row by one row
            table.exceptAll(back).unionByName(back.exceptAll(table)).agg((F.count(F.lit(1)) == 0).alias("same")))
        found = row if found is None else found.unionByName(row)
    return found


def q_feature_importance(spark, sf):
    md = model_data(spark, sf)
    m = MD.fit_model("RandomForest", md.train, md.features)
    return S.feature_importance(m.pipeline.stages[-1], md.features, spark)


def _saved_model(spark, sf):
    """(model data, the model as fitted, its path): scaler and classifier as one artefact."""
    def make():
        md = model_data(spark, sf)
        path = work_dir(spark, "model")
        r = MD.train_model("LogisticRegression", md.train, md.features, "Class", None, save_path=path, scaler_stage=md.scaler_stage)
        return md, r.model, path
    return _memo(spark, sf, "saved_model", make)


def q_save_model(spark, sf):
    """Fit and save (scaler stage + classifier in one PipelineModel); list the stages that were written."""
    path = _saved_model(spark, sf)[2]
    saved = spark.read.json(os.path.join(path, "pipeline", "stages", "*", "metadata")).select("class", F.col("_metadata.file_path").alias("file"))
    return saved.select(F.regexp_extract("file", r"stages/(\d+)_", 1).cast("int").alias("position"), F.substring_index("class", ".", -1).alias("stage"))


def q_load_model(spark, sf):
    """Load the saved artefact and score unscaled test rows: does it agree with the model in memory."""
    md, m, path = _saved_model(spark, sf)
    return _agreement(m.transform(md.test_raw), MD.load_model(path).transform(md.test_raw))


def q_save_scaler(spark, sf):
    """Persist the fitted scaler alone as an MLlib stage, reload and apply it: is each row as the fitted scaler gives it."""
    from pyspark.ml import PipelineModel
    md = model_data(spark, sf)
    path = work_dir(spark, "scaler")
    PipelineModel(stages=[md.scaler_stage]).write().overwrite().save(path)
    loaded = PipelineModel.load(path).transform(md.test_raw).select("row_id", F.struct(*md.features).alias("_loaded"))
    here = md.scaler.transform(md.test_raw).select("row_id", F.struct(*[F.col(c).cast("double") for c in md.features]).alias("_here"))
    return here.join(loaded, "row_id", "full").select("row_id", F.coalesce(F.col("_here") == F.col("_loaded"), F.lit(False)).alias("agrees"))


def _agreement(a, b, keys=("row_id",)):
    """Rows of a with whether b gives the same score and prediction."""
    other = b.select(*keys, F.col("score").alias("_score"), F.col("prediction").alias("_prediction"))
    same = (F.abs(F.col("score") - F.col("_score")) < 1e-9) & (F.col("prediction") == F.col("_prediction"))
    return a.join(other, list(keys), "full").select(*keys, F.coalesce(same, F.lit(False)).alias("agrees"))


def q_save_weighted(spark, sf):
    """A weighted ensemble saved with members and weights, restored, and both scored: do they agree, row by row."""
    md = model_data(spark, sf)
    e = EF.weighted(ENSEMBLE_MEMBERS, md.train, md.features, "Class", weights={n: float(i + 1) for i, n in enumerate(ENSEMBLE_MEMBERS)}, members=members(spark, sf))
    path = work_dir(spark, "weighted")
    e.save(path)
    return _agreement(e.transform(md.test), EF.load_ensemble(path).transform(md.test))


def raw_model(spark, sf):
    """One artefact that scores raw transactions: feature stage (fitted on the training rows) and classifier."""
    def make():
        tx = T.tx_events(spark, sf)
        held = spread(tx, tx.count(), "row_id", "Time", "Amount").persist()
        d = SP.split_data(held, "Class", TEST_SIZE, 0.0, SPLIT_SEED)
        raw = cut_lineage(d.where(F.col("split") == "train").drop("split"))
        held.unpersist()
        stage = fit_stage(raw)
        m = MD.fit_model("LogisticRegression", cut_lineage(stage.transform(raw)), stage.inputs)
        m.stage = stage
        path = work_dir(spark, "raw")
        m.save(path)
        return m, path
    return _memo(spark, sf, "raw_model", make)


def q_raw_score(spark, sf):
    """Raw transactions in a CSV file, scored by the loaded artefact: do they agree with the fitted one."""
    m, path = raw_model(spark, sf)
    tx = T.tx_events(spark, sf)
    file = os.path.join(work_dir(spark, "transactions"), "raw.csv")
    T.align_schema(tx, keep=("Class",)).select(*T.CONTRACT, "Class").write.option("header", True).csv(file)
    # the file has no row key: its rows are told apart by time and amount
    key = lambda df: df.withColumn("row_id", F.xxhash64("Time", "Amount"))
    scored = lambda model, df: model.transform(key(df)).select("row_id", "score", "prediction").distinct()
    both = _agreement(scored(m, tx), scored(MD.load_model(path), T.scan_transactions(spark, file)))
    return both.agg(F.count(F.lit(1)).alias("n"), F.min(F.col("agrees").cast("int")).alias("all_agree"))


def q_save_search(spark, sf):
    """Best model of a grid search plus all search results, saved and read back: has each point all fold scores and
    their mean, and is the loaded model the first in rank."""
    best, res = lr_grid(spark, sf)
    path = work_dir(spark, "search")
    best.save(os.path.join(path, "best_model"))
    res.write.mode("overwrite").parquet(os.path.join(path, "results"))
    loaded, saved = MD.load_model(os.path.join(path, "best_model")), spark.read.parquet(os.path.join(path, "results"))
    first = saved.where("rank = 1").orderBy("point").first()
    whole = (F.size("fold_scores") == 5) & (F.abs(F.aggregate("fold_scores", F.lit(0.0), lambda a, x: a + x) / 5 - F.col("mean_score")) < 1e-12)
    return saved.select("point", "params", whole.alias("whole"), (F.col("rank") >= 1).alias("ranked"),
                        F.lit(json.dumps(loaded.extra["best_params"], default=str) == first["params"]).alias("best_restored"))


def q_batch_score(spark, sf):
    md, m, _ = _saved_model(spark, sf)
    rows = md.prepare_raw(T.tx_events(spark, sf)).select("row_id", *MODEL_FEATURES, "Class")
    out = m.transform(rows)
    return out.select("row_id", "score", "prediction", risk_band("score", "prediction").alias("risk_band"))


STREAM_FILES = 6


def q_stream_score(spark, sf):
    """Events that arrive as files, scored by a stream that is stopped and started again: does each row come
    once, with the score of the batch."""
    from ..streaming import stream_score
    m, _ = raw_model(spark, sf)
    ev = T.read_table(spark, sf, "events")
    t0 = T.fit_t0(ev)
    base = work_dir(spark, "stream")
    source, sink = os.path.join(base, "source"), os.path.join(base, "sink")
    part = F.pmod(F.xxhash64("event_id"), F.lit(STREAM_FILES))

    def start(**kw):
        return stream_score(spark, source, ev.schema, lambda src: T.events_to_tx(src, t0), m, sink, os.path.join(base, "checkpoint"), max_files_per_trigger=1, **kw)

    def arrive(files):
        ev.where(part.isin(files)).repartition(len(files), part).write.mode("append").parquet(source)

    first = STREAM_FILES // 2
    arrive(list(range(first)))
    q = start(available_now=False)  # stopped while it runs, after a batch at least
    while q.isActive and not q.recentProgress:
        q.awaitTermination(0.2)
    q.stop()
    arrive(list(range(first, STREAM_FILES)))
    start().awaitTermination()
    return _agreement(spark.read.parquet(sink), m.transform(T.events_to_tx(ev, t0)))


def _ens_query(kind):
    def q(spark, sf):
        md = model_data(spark, sf)
        if kind == "stacking":
            mt, _, _ = EF.evaluate_ensemble(stacked(spark, sf), md.test, "Class")
            m = mt.first().asDict()
        else:
            _, m = EF.train_ensemble(kind, ENSEMBLE_MEMBERS, md.train, md.test, md.features, "Class",
                                     members=None if kind == "bagging" else members(spark, sf))
        return _metrics_row(spark, f"{kind} ensemble", m)
    q.__name__ = f"q_ens_{kind}"
    return q


def q_compare_ensembles(spark, sf):
    md = model_data(spark, sf)
    return EF.compare_ensembles(ENSEMBLE_MEMBERS, md.train, md.test, md.features, "Class",
                                members=members(spark, sf), prebuilt={"stacking": stacked(spark, sf)})


def q_param_grids(spark, sf):
    """Every grid point with its MLlib parameters for the actual training size."""
    n_train = model_data(spark, sf).train.count()
    rows = []
    for m, g in TU.param_grids().items():
        for i, p in enumerate(TU.grid_points(g)):
            rows.append((m, i, json.dumps(p, default=str),
                         json.dumps(TU.to_mllib(m, p, n_train), default=str)))
    return spark.createDataFrame(rows, "model string, point int, params string, mllib_params string")


LR_GRID = TU.PARAM_GRIDS["LogisticRegression"]


def q_grid_search(spark, sf):
    return lr_grid(spark, sf)[1]


def q_random_search(spark, sf):
    md = model_data(spark, sf)
    _, res = TU.random_search("LogisticRegression", LR_GRID, md.train, md.features, known=lr_known(spark, sf))
    return res


def q_adaptive_search(spark, sf):
    md = model_data(spark, sf)
    return TU.adaptive_search("LogisticRegression", md.train, md.features)[1]


def q_compare_tuning(spark, sf):
    md = model_data(spark, sf)
    return TU.compare_tuning("LogisticRegression", LR_GRID, md.train, md.features, known=lr_known(spark, sf))


def q_pca(spark, sf):
    tx = T.tx_vectors(spark, sf)
    vcols = T.v_columns(tx)
    m = S.fit_pca(tx, vcols, 0.95)
    return m.transform(tx).select("row_id", *[f"PCA_{i + 1}" for i in range(len(m.components))])


def q_pca_variance(spark, sf):
    tx = T.tx_vectors(spark, sf)
    m = S.fit_pca(tx, T.v_columns(tx), 0.95)
    import numpy as np
    cum = np.cumsum(m.explained_variance_ratio).tolist()
    return spark.createDataFrame([(i + 1, float(r), float(c)) for i, (r, c) in
                                  enumerate(zip(m.explained_variance_ratio, cum))],
                                 "component int, ratio double, cumulative double")


def q_eda_report(spark, sf):
    from ..operators.eda import eda_report
    from ..functions.exprs import time_hours
    from .common import rnd
    return rnd(eda_report(T.tx_events(spark, sf).withColumn("Time_Hours", time_hours("Time"))), ["value"])


def q_run_job(spark, sf):
    from .job import run_job
    return run_job(spark, sf, out_dir=work_dir(spark, "job"))


QUERIES = {
    "lr": _fit_one("LogisticRegression"),
    "rf": _fit_one("RandomForest"),
    "gbt": q_gbt,
    "gbt_validation": q_gbt_validation,
    "svm": _fit_one("SVM"),
    "knn_model": _fit_one("KNN"),
    "score": q_score,
    "train_model": q_train_model,
    "train_many": q_train_many,
    "write_comparison": q_write_comparison,
    "feature_importance": q_feature_importance,
    "save_model": q_save_model,
    "load_model": q_load_model,
    "save_scaler": q_save_scaler,
    "save_weighted": q_save_weighted,
    "save_search": q_save_search,
    "batch_score": q_batch_score,
    "stream_score": q_stream_score,
    "raw_score": q_raw_score,
    "train_ensemble": _ens_query("voting"),
    "stacking": _ens_query("stacking"),
    "bagging": _ens_query("bagging"),
    "weighted_models": _ens_query("weighted"),
    "compare_ensembles": q_compare_ensembles,
    "param_grids": q_param_grids,
    "grid_search": q_grid_search,
    "random_search": q_random_search,
    "adaptive_search": q_adaptive_search,
    "compare_tuning": q_compare_tuning,
    "pca": q_pca,
    "pca_variance": q_pca_variance,
    "eda_report": q_eda_report,
    "run_job": q_run_job,
}
