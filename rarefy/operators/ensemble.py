"""Ensembles as column arithmetic over member score columns.

Members are fitted models (or any score columns). Soft voting averages
probabilities; hard voting counts member decisions (score = vote share);
the weighted ensemble normalises weights and decides at >= 0.5.
Stacking and bagging fit MLlib models on fold / bootstrap subsets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sum(cols):
    return reduce(lambda a, b: a + b, cols)


def soft_vote(df: DataFrame, score_cols) -> DataFrame:
    """Mean probability; positive when it is above 0.5 (a tie goes to class 0)."""
    s = _sum([F.col(c) for c in score_cols]) / F.lit(float(len(score_cols)))
    return df.withColumn("score", s).withColumn("prediction", (F.col("score") > F.lit(0.5)).cast("int"))


def hard_vote(df: DataFrame, score_cols) -> DataFrame:
    """Majority of member decisions (member positive when p > 0.5); ties go to class 0."""
    votes = _sum([(F.col(c) > F.lit(0.5)).cast("int") for c in score_cols])
    n = len(score_cols)
    return df.withColumn("score", votes.cast("double") / F.lit(float(n))) \
        .withColumn("prediction", (votes * F.lit(2) > F.lit(n)).cast("int"))


def normalise(weights: dict) -> dict:
    tot = sum(weights.values())
    return {k: v / tot for k, v in weights.items()}


def weighted_vote(df: DataFrame, weights: dict, threshold: float = 0.5) -> DataFrame:
    """Weighted score sum; positive at score >= threshold (inclusive)."""
    w = {k: v for k, v in normalise(weights).items() if v > 0}
    s = _sum([F.lit(v) * F.col(k) for k, v in w.items()])
    return df.withColumn("score", s).withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("int"))
