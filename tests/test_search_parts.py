"""Partitions of the rows that a search fits many times."""

import random

from pyspark.sql import functions as F

from rarefy import session as S
from rarefy.operators import ensemble_fit as EF
from rarefy.operators import tune as TU


def test_fits_side_by_side_share_the_cores():
    # some rows: twice a fit's part of the cores; few rows: one partition; many rows: none beyond the largest size
    assert S.parts_side_by_side(770_000, 12, 8) == 3 and S.parts_side_by_side(770_000, 8, 8) == 2
    assert S.parts_side_by_side(3_000, 12, 8) == 1 and S.parts_side_by_side(46_000_000, 12, 8) == 92
    assert S.parts_side_by_side(770_000, 12, 1) == 24


def test_a_share_of_the_rows_is_dealt_out_not_coalesced(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 100)
    monkeypatch.setattr(S, "PART_MOST", 150)
    df = spark.range(0, 2000, 1, 40).select(F.col("id").alias("row_id")).persist()
    part = TU._share_of(df, F.col("row_id") % 5 == 0, 400, 8)
    sizes = part.rdd.glom().map(len).collect()
    assert sum(sizes) == 400 and len(sizes) == 3 and min(sizes) > 80
    assert "Exchange" in part._jdf.queryExecution().executedPlan().toString()


def test_searches_keep_their_scores_whatever_the_partitions(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.random()) for i in range(600)]
    df = spark.createDataFrame([(i, a, b, int(rng.random() < a)) for i, a, b in rows], "row_id long, a double, b double, Class int").repartition(7)
    got = []
    for most in (500_000, 60):
        monkeypatch.setattr(S, "PART_MOST", most)
        _, res = TU.adaptive_search("LogisticRegression", df, ["a", "b"], n_trials=4, cv=3, min_rows=100)
        got.append([(r["rung"], r["trial"], round(r["mean_score"], 6), r["n_rows"]) for r in res.collect()])
    assert got[0] == got[1] and {r[0] for r in got[0]} == {0, 1} and max(r[3] for r in got[0]) == 600


def test_folds_of_an_ensemble_are_few_partitions(spark, monkeypatch):
    df = spark.range(0, 2000, 1, 60)
    assert EF._for_folds(df, 5).rdd.getNumPartitions() == 60
    monkeypatch.setattr(EF, "SPREAD_LEAST", 1000)
    monkeypatch.setattr(S, "PART_ROWS", 10)
    few = EF._for_folds(df, 5)
    assert few.rdd.getNumPartitions() == -(-2 * spark.sparkContext.defaultParallelism // 5) and few.count() == 2000
