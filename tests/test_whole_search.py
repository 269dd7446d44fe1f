"""Searches of the registered queries score all of their trials, however long that takes."""

import itertools
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from rarefy.operators import tune as TU
from rarefy.plans import catalog_models as CM


@pytest.fixture
def slow_search(spark, monkeypatch):
    """A query's model data of 300 rows and two different trials, on a clock that leaps a day at each look."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 2))
    y = ((x[:, 0] + rng.normal(0, 0.7, 300)) > 0.8).astype(int)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(Class=y, row_id=np.arange(300)))
    days = itertools.count()
    monkeypatch.setattr(TU, "time", SimpleNamespace(monotonic=lambda: 86_400.0 * next(days)))
    monkeypatch.setattr(TU, "drawn_point", lambda space, seed, t: {"C": [0.1, 10.0][t % 2], "penalty": "l2", "solver": "saga"})
    monkeypatch.setattr(CM, "model_data", lambda *a: SimpleNamespace(train=df, features=["a", "b"]))
    monkeypatch.setattr(CM, "lr_known", lambda *a: {})
    monkeypatch.setattr(CM, "LR_GRID", {"C": [1.0], "penalty": ["l2"]})


def test_adaptive_search_scores_every_trial(spark, slow_search):
    rows = CM.q_adaptive_search(spark, "").collect()
    assert sorted(r["trial"] for r in rows) == list(range(100)) and all(len(r["fold_scores"]) == 5 for r in rows)


def test_compare_tuning_scores_every_trial(spark, slow_search):
    got = {r["method"]: r["n_evaluated"] for r in CM.q_compare_tuning(spark, "").collect()}
    assert got == {"grid": 1, "random": 1, "adaptive": 50}
