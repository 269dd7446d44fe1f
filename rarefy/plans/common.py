"""Shared definitions of the registered queries: rounding and fixed scorers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import time_hours
from ..sources.tables import fixed_score

# Doubles that pass through transcendental functions or order-dependent
# sums are rounded the same way in the query and in its oracle.
DIGITS = 6


def rnd(df: DataFrame, cols, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# Three arithmetic scorers standing in for fitted models when a
# query must be checkable without a model; weights of the weighted ensemble.
def scorers() -> dict:
    a, t = F.col("Amount"), time_hours("Time")
    return {
        "s_amount": fixed_score("Amount"),
        "s_hour": F.floor(F.lit(100.0) * t / F.lit(24.0)) / F.lit(100.0),
        "s_mod": F.floor(F.lit(100.0) * F.pmod(a, F.lit(7.0)) / F.lit(7.0)) / F.lit(100.0),
    }


ENSEMBLE_WEIGHTS = {"s_amount": 0.5, "s_hour": 0.3, "s_mod": 0.2}
SPLIT_SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.1
KNN_FEATURES = ["Time_Hours", "Amount"]
