"""Order statistics of any doubles, splits as projections, running sums, co-moments, kNN with nulls and copies, LSH recall."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarefy.operators import metrics as M
from rarefy.operators import split as SP
from rarefy.operators.knn import MedianTree, fit_cuts, knn_join
from rarefy.operators.knn_lsh import knn_join_lsh, recall
from rarefy.operators.moments import co_moments, correlations
from rarefy.operators.profile import corr_pairs
from rarefy.operators.quantiles import column_quantiles, exact_quantiles, order_statistics, values_at
from rarefy.operators.ranking import running_sums


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [
    [math.inf] + [float(i) for i in range(2000)],
    [-math.inf, math.inf, math.inf] + [float(-i) for i in range(999)],
    [10.0 ** e * s for e in range(-300, 300, 3) for s in (1, -1, 1.0000001)] + [0.0, -0.0, 5e-324, -5e-324, 1.7e308],
    [1.0 + k * 2 ** -52 for k in range(1500)],
])
def test_order_statistics_of_any_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    want = np.sort(np.array(values))
    ranks = [0, 1, len(values) // 3, len(values) // 2, len(values) - 2, len(values) - 1]
    assert order_statistics(df, "x", ranks, n_buckets=8, max_bracket=20)[("x",)] == [want[r] for r in ranks]


def test_many_targets_of_many_keys(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(0, 1, (3000, 6)), columns=list("abcdef")).assign(g=rng.integers(0, 4, 3000))
    probs = [i / 20 for i in range(21)]
    q = exact_quantiles(spark.createDataFrame(pdf), list("abcdef"), probs, by=["g"], n_buckets=16, max_bracket=30)
    assert len(q) == 24
    for (g, c), got in q.items():
        assert got == pytest.approx(np.quantile(pdf[pdf.g == g][c], probs).tolist(), abs=1e-12)
    assert column_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]


def test_values_at_ranks_that_differ_by_group(spark):
    df = spark.createDataFrame([(g, 2 ** 53 + g * 1000 + i) for g in (1, 2) for i in range(100)] + [(None, 5)], "g int, h long")
    got = values_at(df, "h", {(1,): [0, 99, 100], (2,): [50], (3,): [0]}, ["g"], n_buckets=4, max_bracket=5)
    assert got == {(1,): [2 ** 53 + 1000, 2 ** 53 + 1099, None], (2,): [2 ** 53 + 2050], (3,): [None]}


def test_splits_are_projections_with_exact_sizes(spark):
    n = 3000
    pdf = pd.DataFrame({"row_id": np.arange(n), "Class": ([0] * 7 + [1, 2, 2]) * (n // 10)})
    df = spark.createDataFrame(pdf)
    for out in (SP.split_data(df, "Class", 0.2, 0.1, 1), SP.split_data(df, None, 0.3, 0.0, 1, stratify=False), SP.stratified_kfold(df, "Class", 7, 1), SP.random_under(df, "Class", 1)):
        assert "Exchange" not in plan(out) and "Join" not in plan(out) and "Window" not in plan(out)
    s = SP.split_data(df, "Class", 0.2, 0.1, 1).toPandas().groupby(["Class", "split"]).size().to_dict()
    for c, k in ((0, 2100), (1, 300), (2, 600)):
        test = math.ceil(0.2 * k)
        assert s[(c, "test")] == test and s[(c, "val")] == math.ceil(0.1 / 0.8 * (k - test)) and sum(v for (a, _), v in s.items() if a == c) == k
    f = SP.stratified_kfold(df, "Class", 7, 1).toPandas().groupby(["Class", "fold"]).size()
    for c, k in ((0, 2100), (1, 300), (2, 600)):
        assert f[c].tolist() == [k // 7 + (i < k % 7) for i in range(7)]
    assert SP.random_under(df, "Class", 1).groupBy("Class").count().toPandas().set_index("Class")["count"].to_dict() == {0: 300, 1: 300, 2: 300}


def test_splits_of_odd_tables(spark):
    rows = [(1, 0)] * 50 + [(i, 0) for i in range(2, 20)] + [(100, None), (101, 1)]
    df = spark.createDataFrame(rows, "row_id long, Class int")
    out = SP.split_data(df, "Class", 0.25, 0.0, 3).collect()
    assert len(out) == len(rows) and len({r["split"] for r in out if r["row_id"] == 1}) == 1  # rows of one id stay together
    assert [r["split"] for r in out if r["Class"] is None] == ["train"]
    assert SP.stratified_kfold(df, "Class", 5, 3).where("fold < 0 OR fold > 4 OR fold IS NULL").count() == 0
    empty = df.limit(0)
    assert SP.split_data(empty).count() == SP.stratified_kfold(empty).count() == SP.random_under(empty).count() == 0


def test_running_sums_of_empty_one_and_tied_parts(spark):
    empty = spark.createDataFrame([], "k double, v long")
    out, total = running_sums(empty, "k", ["v"])
    assert out.count() == 0 and total == {"v": 0}
    df = spark.createDataFrame([(float(i), i) for i in range(500)] + [(math.inf, 7), (math.nan, 9)], "k double, v long")
    out, total = running_sums(df, "k", ["v"], n_parts=7)
    rows = {r["k"]: r["cum_v"] for r in out.collect() if not math.isnan(r["k"])}
    assert rows[499.0] == sum(range(500)) and rows[math.inf] == rows[499.0] + 7 and total["v"] == rows[math.inf] + 9


def test_auc_reads_the_scores_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"label": rng.integers(0, 2, 400), "score": np.round(rng.random(400), 2)})
    df = spark.createDataFrame(pdf).mapInArrow(seen, "label long, score double")
    auc = M.roc_auc(df).first()[0]
    pos, neg = (pdf[pdf.label == c].score.to_numpy() for c in (1, 0))
    d = pos[:, None] - neg[None, :]
    assert auc == pytest.approx(((d > 0) + 0.5 * (d == 0)).mean()) and reads.value == 400


def test_co_moments_with_nulls_and_a_large_mean(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(0, 1, (800, 5)) + np.array([1e9, 0, -3e6, 5, 0])
    X[:, 3] += X[:, 1]
    X[rng.random((800, 5)) < 0.1] = np.nan
    X[:, 4] = 2.0
    pdf = pd.DataFrame(X, columns=list("abcde"))
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in X], ", ".join(f"{c} double" for c in "abcde")).repartition(4)
    got = correlations(co_moments(df, list("abcde")))
    want = pdf.corr().to_numpy()
    assert np.allclose(got[:4, :4], want[:4, :4], atol=1e-9) and np.isnan(got[4]).all()
    rows = {(r["feature_a"], r["feature_b"]): r["corr"] for r in corr_pairs(df, list("abcde")).collect()}
    assert len(rows) == 10 and rows[("d", "b")] == pytest.approx(want[3, 1]) and rows[("e", "a")] is None
    assert all(r["corr"] is None for r in corr_pairs(df.limit(0), ["a", "b"]).collect())


def brute(q, r, k, skip):
    out = {}
    for i, x in q:
        if any(v is None or not math.isfinite(v) for v in x):
            continue
        d = sorted((math.sqrt(sum((a - b) * (a - b) for a, b in zip(x, y))), j) for j, y in r if not (skip and j == i) and all(v is not None and math.isfinite(v) for v in y))
        out[i] = [j for _, j in d[:k]]
    return out


def test_knn_keeps_rows_without_features_outside(spark):
    rng = np.random.default_rng(6)
    rows = [(i, tuple(float(v) for v in rng.normal(0, 1, 2))) for i in range(300)]
    rows += [(1000 + i, (0.25, 0.5)) for i in range(400)]  # copies of one vector
    rows += [(2000, (None, 1.0)), (2001, (1.0, math.nan)), (2002, (math.inf, 0.0)), (2003, (None, None))]
    df = spark.createDataFrame([(i, *x) for i, x in rows], "row_id long, x double, y double").repartition(5)
    got = knn_join(df, df, ["x", "y"], 4, exclude_self=True, leaf_rows=16, fit_rows=64, fit_levels=2, group_rows=32).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["q_id"], r["rank"])):
        found.setdefault(r["q_id"], []).append(r["r_id"])
    assert found == brute(rows, rows, 4, True)
    none = df.where("x IS NULL")
    assert knn_join(df, none, ["x", "y"], 3).count() == 0 and knn_join(none, df, ["x", "y"], 3).count() == 0
    few = df.where("row_id < 2")
    assert knn_join(df.where("row_id < 50"), few, ["x", "y"], 5).groupBy("q_id").count().where("count <> 2").count() == 0


def test_median_tree_reaches_all_leaves_within_a_bound():
    rng = np.random.default_rng(8)
    X = np.round(rng.normal(0, 1, (600, 3)), 1)
    tree = MedianTree()
    cuts = fit_cuts(X, 5)
    tree.grow({0: cuts}, 5)
    leaf = tree.leaf(X)
    ids = np.unique(leaf)
    assert len(ids) > 20 and max(np.bincount(leaf)) < 80
    tree.bound(ids, np.array([X[leaf == i].min(axis=0) for i in ids]), np.array([X[leaf == i].max(axis=0) for i in ids]), np.bincount(leaf)[ids], 3)
    Q, bound = rng.normal(0, 1.5, (40, 3)), rng.random(40)
    row, at = tree.within(Q, bound)
    reached = set(zip(row.tolist(), at.tolist()))
    D = np.sqrt(((Q[:, None, :] - X[None]) ** 2).sum(axis=2))
    assert {(i, int(leaf[j])) for i, j in zip(*np.nonzero(D <= bound[:, None]))} <= reached
    for i in range(40):
        assert (D[i] <= tree.enough(Q[i], 7) + 1e-12).sum() >= 7


def test_lsh_join_reaches_its_recall(spark):
    rng = np.random.default_rng(9)
    X = np.vstack([rng.normal(0, 0.05, (300, 6)), rng.normal(3, 1.0, (300, 6))])  # dense and sparse
    rows = [(i, *map(float, x)) for i, x in enumerate(X)] + [(700 + i, *map(float, X[0])) for i in range(60)] + [(900, None, *[0.0] * 5)]
    cols = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} double" for c in cols))
    exact = knn_join(df, df, cols, 5, exclude_self=True, leaf_rows=32)
    found = knn_join_lsh(df, df, cols, 5, exclude_self=True)
    r = recall(found, exact).first()
    assert r["queries"] == 660 and r["pairs"] == 3300 and r["recall"] >= 0.9
    assert found.groupBy("q_id").agg(F.count("*").alias("n"), F.max("rank").alias("k")).where("n <> 5 OR k <> 5").count() == 0
    assert knn_join_lsh(df.limit(0), df, cols, 5).count() == 0
