"""Registered queries that did less than their operator."""

from conftest import SF_SMALL


def test_scan_transactions_query_scans_a_file(spark, monkeypatch):
    from rarefy.plans import catalog
    from rarefy.sources import tables as T
    seen, scan = [], T.scan_transactions
    monkeypatch.setattr(T, "scan_transactions", lambda s, path, *a: seen.append(path) or scan(s, path, *a))
    out = catalog.q_scan_transactions(spark, SF_SMALL)
    want = T.tx_events(spark, SF_SMALL)
    assert seen and seen[0].endswith(".csv") and out.columns == want.columns
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0


def test_run_job_query_takes_the_defaults(spark, monkeypatch):
    """EDA, features, all default models and ensembles; tuning is asked for by flag."""
    from rarefy.plans import catalog_models, job
    seen = []
    monkeypatch.setattr(job, "run_job", lambda *a, **k: seen.append((a, k)))
    catalog_models.q_run_job(spark, SF_SMALL)
    (_, k), = seen
    assert set(k) == {"out_dir"}


def test_job_runs_every_step(spark, tmp_path, monkeypatch):
    """The whole job with tuning, on small models: each step leaves its table."""
    from rarefy.operators import models as MD
    from rarefy.plans import job
    for n in ("RandomForest", "XGBoost"):
        monkeypatch.setitem(MD.PRESETS, n, MD.PRESETS[n] | ({"numTrees": 3, "maxDepth": 2} if n == "RandomForest" else {"maxIter": 2, "maxDepth": 2}))
    monkeypatch.setattr(job, "TUNING_GRID", {"n_estimators": [2, 3], "max_depth": [2], "learning_rate": [0.1]})
    out = str(tmp_path / "out")
    table = job.run_job(spark, SF_SMALL, out, run_tuning=True, models=["LogisticRegression", "RandomForest", "XGBoost"]).collect()
    assert {r["model"] for r in table} == {"LogisticRegression", "RandomForest", "XGBoost"} and all(r["error"] is None for r in table)
    ensembles = spark.read.option("header", True).csv(f"{out}/ensemble_comparison").collect()
    assert {r["ensemble_type"] for r in ensembles} == {"voting", "stacking", "weighted"} and all(r["error"] is None for r in ensembles)
    assert spark.read.json(f"{out}/xgboost_tuning").count() == 2
    assert MD.load_model(f"{out}/xgboost_tuned_model").extra["best_params"]["max_depth"] == 2
    assert spark.read.option("header", True).csv(f"{out}/eda_report").count() > 0
