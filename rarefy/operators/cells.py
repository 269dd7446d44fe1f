"""Training rows of boosted trees, with equal binned rows as one weighted row.

MLlib's trees see a feature only through at most ``maxBins`` bins. Rows of one
class and the same bins therefore get the same gradient in each round, and one
row with their summed weight gives the same sums in each node. The bins come
from a bounded sample (MLlib takes 10,000 rows for its own), every row enters
a cell, and the bins are a stage of the fitted pipeline.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fewer rows are fitted as they are
CELL_LEAST = 50_000
#: rows that the bins are taken from, about
SAMPLE_ROWS = 200_000
#: cells of a partition, about
PART_CELLS = 40_000
#: bits of a bin's number, and bins that one long holds
BITS, PER_LONG = 5, 12


def bin_column(feature: str) -> str:
    return f"_bin_{feature}"


def _edges(quantiles) -> tuple[list, list]:
    """(edges, frequent values) of ascending quantiles: a value that takes several of them is a bin of its own."""
    vals, times = np.unique(np.asarray(quantiles, dtype=float) + 0.0, return_counts=True)  # + 0.0: no negative zero
    edges = {float(np.nextafter(v, math.inf)) for v in vals} | {float(v) for v, k in zip(vals, times) if k > 1}
    return sorted(edges), [float(v) for v, k in zip(vals, times) if k > 1]


def bin_edges(df: DataFrame, features, n: int, max_bins: int = 32) -> dict:
    """At most ``max_bins`` - 1 ascending edges per feature, a bin being [edge, next edge). Frequent values have their
    own bins; the edges that they leave over go to the quantiles of the other values."""
    share = SAMPLE_ROWS / max(n, 1)
    if share < 1:
        df = df.where(F.pmod(F.xxhash64(*features), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    part = df.select(*[F.col(f).cast("double").alias(f) for f in features]).persist()
    try:
        first = part.approxQuantile(list(features), [i / max_bins for i in range(1, max_bins)], 1e-4)
        found = {f: _edges(q) for f, q in zip(features, first)}
        left = {f: max_bins - 1 - len(e) for f, (e, often) in found.items() if often and len(e) < max_bins - 1}
        if left:
            rest = part.select(*[F.when(~F.col(f).isin(found[f][1]), F.col(f)).alias(f) for f in left])
            steps = sorted({i / (k + 1) for k in left.values() for i in range(1, k + 1)} | {0.0})
            for (f, k), q in zip(left.items(), rest.approxQuantile(list(left), steps, 1e-4)):
                at = dict(zip(steps, q))
                more = [float(np.nextafter(at[i / (k + 1)], math.inf)) for i in range(1, k + 1)] if q else []
                found[f] = (sorted({*found[f][0], *more}), found[f][1])
    finally:
        part.unpersist()
    return {f: e for f, (e, _) in found.items()}


def binned(df: DataFrame, features, label: str, max_bins: int = 32):
    """(Bucketizer, its columns of cells with label, summed ``_w`` and number of rows ``_n``, persisted), or None where cells
    don't pay: few rows, rows with a null or infinite feature or without a class, or hardly any equal rows."""
    features = list(features)
    if max_bins > 2 ** BITS:
        return None
    odd = [F.col(label).isNull()] + [F.col(f).isNull() | F.isnan(F.col(f).cast("double")) | (F.abs(F.col(f).cast("double")) == math.inf) for f in features]
    about = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.greatest(*odd), F.lit(True))).alias("odd")).first()
    if about["n"] < CELL_LEAST or about["odd"]:
        return None
    edges = bin_edges(df, features, about["n"], max_bins)
    stage = Bucketizer(splitsArray=[[-math.inf, *edges[f], math.inf] for f in features], inputCols=features,
                       outputCols=[bin_column(f) for f in features], handleInvalid="keep")
    groups = [features[i:i + PER_LONG] for i in range(0, len(features), PER_LONG)]
    packed = stage.transform(df).select(label, "_w", *[
        sum((F.shiftleft(F.col(bin_column(f)).cast("long"), BITS * i) for i, f in enumerate(g)), F.lit(0).cast("long")).alias(f"_k{j}")
        for j, g in enumerate(groups)])
    cells = packed.groupBy(label, *[f"_k{j}" for j in range(len(groups))]).agg(F.sum("_w").alias("_w"), F.count(F.lit(1)).alias("_n")).select(label, "_w", "_n", *[
        F.shiftright(F.col(f"_k{j}"), BITS * i).bitwiseAND(F.lit(2 ** BITS - 1)).cast("double").alias(bin_column(f))
        for j, g in enumerate(groups) for i, f in enumerate(g)]).persist()
    n_cells = cells.count()
    if n_cells > about["n"] // 2:
        cells.unpersist()
        return None
    # a fit is hundreds of short jobs, whose tasks cost more than few rows
    dealt = cells.repartition(max(1, -(-n_cells // PART_CELLS))).persist()
    dealt.count()
    cells.unpersist()
    return stage, dealt
