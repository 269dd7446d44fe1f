"""Pairwise co-moments of many columns in one aggregate.

Every task keeps d x d matrices over its rows (matrix products of an Arrow
batch with itself) and passes on one row per pair of columns: the number of
rows with both values, and sums, squares and products of the distances from a
shift. These add up, so Spark sums them per pair, and no aggregation buffer holds
more than one pair. The shift is the mean of the first rows read: near enough to
the values that their squares don't cancel, and equal for all tasks.

A null leaves a pair out of both columns' moments; NaN and infinite values make
the pair's result NaN.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

SHIFT_ROWS = 1000


def co_moments(df: DataFrame, cols) -> dict[str, np.ndarray]:
    """d x d matrices: ``n`` rows with both values; of these ``x`` and ``xx``, sums and squares of the row's column
    (distances from its shift), and ``xy``, the products. ``shift`` is a vector."""
    cols = list(cols)
    ship_package(df.sparkSession)
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    first = wide.limit(SHIFT_ROWS).agg(*[F.avg(F.when(F.abs(c) < F.lit(float("inf")), F.col(c))).alias(c) for c in wide.columns]).first()
    shift = np.array([first[c] or 0.0 for c in wide.columns])
    d = len(cols)

    def partial(batches):
        total = np.zeros((4, d, d))
        for b in batches:
            X = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns]) - shift
            M = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns]).astype(float)
            with np.errstate(invalid="ignore", over="ignore"):
                X = np.where(M > 0, X, 0.0)
                total += np.array([M.T @ M, X.T @ M, (X * X).T @ M, X.T @ X])
        i, j = np.divmod(np.arange(d * d), d)
        n, x, xx, xy = (t.reshape(-1) for t in total)
        if n.any():
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n.astype(np.int64)),
                                              pa.array(x), pa.array(xx), pa.array(xy)], ["i", "j", "n", "x", "xx", "xy"])

    rows = (wide.mapInArrow(partial, "i int, j int, n long, x double, xx double, xy double")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "xx", "xy")]).collect())  # d x d rows
    out = {c: np.zeros((d, d)) for c in ("n", "x", "xx", "xy")}
    for r in rows:
        for c in out:
            out[c][r["i"], r["j"]] = r[c]
    return out | {"shift": shift}


def correlations(m: dict[str, np.ndarray]) -> np.ndarray:
    """Pearson correlation of each pair over the rows with both values; NaN where it isn't defined."""
    with np.errstate(invalid="ignore", divide="ignore"):
        n = m["n"]
        var = m["xx"] - m["x"] * m["x"] / n
        cov = m["xy"] - m["x"] * m["x"].T / n
        return np.where((var > 0) & (var.T > 0), cov / np.sqrt(var * var.T), np.nan)
