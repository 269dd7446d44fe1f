"""Boosted trees fitted to cells of equal binned rows."""

import random

import pytest
from pyspark.ml.feature import Bucketizer

from rarefy.operators import cells as CE
from rarefy.operators import models as MD

FEATS = ["a", "b", "c"]
SMALL = {"maxIter": 5, "maxDepth": 4}


def _rows(spark, n=3000, null=False):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(9) / 2, float(rng.randrange(12) ** 2), float(rng.random() < 0.02)
        rows.append((i, a, b, c, int(rng.random() < 0.1 + 0.1 * a + 0.3 * c - 0.001 * b)))
    if null:
        rows.append((n, None, 1.0, 0.0, 0))
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, Class int").persist()


@pytest.mark.parametrize("name", ["XGBoost", "LightGBM"])
def test_cells_give_the_scores_of_the_rows(spark, monkeypatch, tmp_path, name):
    df = _rows(spark)
    plain = MD.fit_model(name, df, FEATS, params=SMALL)
    assert not any(isinstance(s, Bucketizer) for s in plain.pipeline.stages)
    monkeypatch.setattr(CE, "CELL_LEAST", 1)
    got = MD.fit_model(name, df, FEATS, params=SMALL)
    assert isinstance(got.pipeline.stages[0], Bucketizer)
    got.save(str(tmp_path / "m"))
    want = {r["row_id"]: r["score"] for r in plain.transform(df).collect()}
    for m in (got, MD.load_model(str(tmp_path / "m"))):
        out = m.transform(df)
        assert out.columns == plain.transform(df).columns
        assert all(abs(want[r["row_id"]] - r["score"]) < 1e-9 for r in out.collect())


def test_every_row_is_in_a_cell(spark, monkeypatch):
    monkeypatch.setattr(CE, "CELL_LEAST", 1)
    df, _ = MD.weight_column(_rows(spark), "Class", "balanced")
    _, cells = CE.binned(df, FEATS, "Class")
    assert cells.count() <= 9 * 12 * 2 * 2
    want = {r[0]: r[1] for r in df.groupBy("Class").sum("_w").collect()}
    got = {r[0]: r[1] for r in cells.groupBy("Class").sum("_w").collect()}
    assert want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-6 for k in want)


def test_rows_with_null_features_and_rows_that_are_all_different_are_fitted_as_they_are(spark, monkeypatch):
    monkeypatch.setattr(CE, "CELL_LEAST", 1)
    df, _ = MD.weight_column(_rows(spark, null=True), "Class", None)
    assert CE.binned(df, FEATS, "Class") is None
    rng = random.Random(1)
    other = spark.createDataFrame([(i % 2, *[rng.random() for _ in range(14)], 1.0) for i in range(500)],
                                  "Class int, " + ", ".join(f"f{i} double" for i in range(14)) + ", _w double")
    assert CE.binned(other, [f"f{i}" for i in range(14)], "Class") is None


def test_frequent_values_have_their_own_bins_and_the_others_share_the_rest(spark):
    df = spark.createDataFrame([(0.0 if i % 50 else 1.0 + i / 5000, -float(i)) for i in range(5000)], "x double, y double")
    edges = CE.bin_edges(df, ["x", "y"], 5000)
    assert all(len(e) <= 31 and e == sorted(set(e)) for e in edges.values())
    bins = lambda col, f: Bucketizer(splits=[-float("inf"), *edges[f], float("inf")], inputCol=f, outputCol=col)
    got = bins("bx", "x").transform(df).groupBy("bx").agg({"x": "min", "*": "count"}).collect()
    assert len(got) > 10  # the rare values, 2 % of all, aren't one bin
    assert [r["count(1)"] for r in got if r["min(x)"] == 0.0] == [4900]
    spread = [r["count"] for r in bins("by", "y").transform(df).groupBy("by").count().collect()]
    assert len(spread) == 32 and max(spread) < 200


def test_a_forest_keeps_the_nodes_of_its_rows(spark):
    df = _rows(spark)
    m = MD.fit_model("RandomForest", df, FEATS, params={"numTrees": 4, "maxDepth": 4})
    plain = MD.fit_model("RandomForest", df, FEATS, params={"numTrees": 4, "maxDepth": 4, "cacheNodeIds": False})
    assert m.pipeline.stages[-1].getCacheNodeIds()
    assert m.pipeline.stages[-1].toDebugString.split("\n")[1:] == plain.pipeline.stages[-1].toDebugString.split("\n")[1:]
