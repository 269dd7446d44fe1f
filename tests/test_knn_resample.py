"""kNN join vs brute force; resampler properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarefy.operators.knn import knn_join
from rarefy.operators import resample as RS


def _sq(X, Y):
    """Squared distances summed dimension by dimension (the join's and SQL's order)."""
    D = np.zeros((len(X), len(Y)))
    for j in range(X.shape[1]):
        d = X[:, j, None] - Y[None, :, j]
        D += d * d
    return D


def _brute(X, ids, k, exclude_self):
    D = np.sqrt(_sq(X, X))
    if exclude_self:
        np.fill_diagonal(D, np.inf)
    out = {}
    for i in range(len(X)):
        o = np.lexsort((ids, D[i]))[:k]
        out[ids[i]] = [int(v) for v in ids[o]]
    return out


@pytest.mark.parametrize("leaf_rows,fit_levels,group_rows", [(10_000, 8, 4096), (20, 2, 16)])
def test_knn_matches_bruteforce_with_ties(spark, leaf_rows, fit_levels, group_rows):
    rng = np.random.default_rng(5)
    X = np.round(rng.normal(0, 1, (400, 3)), 1)       # coarse grid: many distance ties
    X[:60] = X[0]                                      # a block of identical points
    ids = np.arange(400) * 7 + 3
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(row_id=ids)
    df = spark.createDataFrame(pdf)
    got = knn_join(df, df, ["a", "b", "c"], 4, exclude_self=True, leaf_rows=leaf_rows,
                   fit_levels=fit_levels, fit_rows=100, group_rows=group_rows).toPandas()
    got = got.sort_values(["q_id", "rank"]).groupby("q_id").r_id.apply(list).to_dict()
    want = _brute(X, ids, 4, True)
    assert got == want


def test_knn_query_and_reference_differ(spark):
    rng = np.random.default_rng(6)
    Q, R = rng.random((50, 2)), rng.random((300, 2))
    qdf = spark.createDataFrame(pd.DataFrame(Q, columns=["x", "y"]).assign(row_id=np.arange(50)))
    rdf = spark.createDataFrame(pd.DataFrame(R, columns=["x", "y"]).assign(row_id=np.arange(1000, 1300)))
    got = knn_join(qdf, rdf, ["x", "y"], 3, leaf_rows=20).toPandas()
    D = np.sqrt(_sq(Q, R))
    for q, g in got.groupby("q_id"):
        want = list(1000 + np.lexsort((np.arange(300), D[q]))[:3])
        assert g.sort_values("rank").r_id.tolist() == want


def _fixture(spark, n_maj=200, n_min=20, seed=0):
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 1, (n_maj, 2))
    b = rng.normal(2, 0.5, (n_min, 2))
    pdf = pd.DataFrame(np.vstack([a, b]), columns=["x", "y"])
    pdf["Class"] = [0] * n_maj + [1] * n_min
    pdf["row_id"] = np.arange(len(pdf))
    return spark.createDataFrame(pdf), pdf


def test_smote_properties(spark):
    df, pdf = _fixture(spark)
    out = RS.smote(df, ["x", "y"], "Class", k=5, seed=42).toPandas()
    assert (out.Class == 1).sum() == 200 and (out.Class == 0).sum() == 200
    syn = out[out.row_id < 0]
    assert len(syn) == 180 and syn.row_id.is_unique
    mins = pdf[pdf.Class == 1][["x", "y"]].to_numpy()
    # each synthetic row lies on a segment between two minority rows
    for _, r in syn.iterrows():
        p = np.array([r.x, r.y])
        ok = False
        for a in mins:
            for b in mins:
                d = b - a
                t = np.dot(p - a, d) / max(np.dot(d, d), 1e-300)
                if -1e-9 <= t <= 1 + 1e-9 and np.linalg.norm(a + t * d - p) < 1e-9:
                    ok = True
                    break
            if ok:
                break
        assert ok
    again = RS.smote(df, ["x", "y"], "Class", k=5, seed=42).toPandas()
    key = lambda d: d.sort_values("row_id").round(12).to_numpy().tolist()
    assert key(out) == key(again)


def test_smote_minority_smaller_than_k(spark):
    df, _ = _fixture(spark, n_maj=30, n_min=3, seed=1)
    out = RS.smote(df, ["x", "y"], "Class", k=5, seed=1).toPandas()
    assert (out.Class == 1).sum() == 30      # k is reduced to n_min - 1 = 2


def test_tomek_and_enn_bruteforce(spark):
    df, pdf = _fixture(spark, n_maj=150, n_min=40, seed=3)
    X, y, ids = pdf[["x", "y"]].to_numpy(), pdf.Class.to_numpy(), pdf.row_id.to_numpy()
    D = np.sqrt(_sq(X, X))
    np.fill_diagonal(D, np.inf)
    nn1 = np.array([np.lexsort((ids, D[i]))[0] for i in range(len(X))])
    link = {ids[i] for i in range(len(X)) if nn1[nn1[i]] == i and y[i] != y[nn1[i]]}
    got = set(RS.tomek_pairs(df, ["x", "y"], "Class").toPandas().row_id)
    assert got == link
    nn3 = [np.lexsort((ids, D[i]))[:3] for i in range(len(X))]
    keep = {ids[i] for i in range(len(X)) if y[i] == 1 or all(y[j] == y[i] for j in nn3[i])}
    got = set(RS.enn(df, ["x", "y"], "Class", 3, "auto").toPandas().row_id)
    assert got == keep


def test_handle_imbalance_dispatch(spark):
    df, _ = _fixture(spark)
    none = RS.handle_imbalance(df, ["x", "y"], "Class", None)
    assert none.before == none.after == {0: 200, 1: 20}
    under = RS.handle_imbalance(df, ["x", "y"], "Class", "random_under")
    assert under.after == {0: 20, 1: 20}
    nm = RS.handle_imbalance(df, ["x", "y"], "Class", "nearmiss")
    assert nm.after[1] == 20 and nm.after[0] <= 20
    with pytest.raises(ValueError):
        RS.handle_imbalance(df, ["x", "y"], "Class", "bogus")


def test_rows_that_several_passes_read_are_written_once(spark, monkeypatch):
    """The kNN join after SMOTE doesn't draw the rows anew in each of its passes, nor does NearMiss average its distances anew."""
    from rarefy.operators import resample as RS
    rows = [(i, float(i * 37 % 101), float(i * 53 % 89), int(i % 4 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, x double, y double, Class int")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    seen, knn, top = [], RS.knn_join, RS.top_n_by
    monkeypatch.setattr(RS, "knn_join", lambda q, r, *a, **k: seen.append(plan(q) + plan(r)) or knn(q, r, *a, **k))
    monkeypatch.setattr(RS, "top_n_by", lambda d, *a, **k: seen.append(plan(d)) or top(d, *a, **k))
    for run, n in ((RS.smote_tomek, 2), (RS.smote_enn, 2), (RS.nearmiss3, 3)):
        del seen[:]
        assert run(df, ["x", "y"]).count() > 0
        assert len(seen) == n and not any(w in seen[-1] for w in ("Generate", "Aggregate", "Join"))
