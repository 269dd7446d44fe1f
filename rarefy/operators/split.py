"""Stratified / random splits, k folds and random under-sampling.

All randomness is ``md5(row_id:seed)``. A class is cut at the exact order
statistic of its hashes (histogram narrowing, see ``quantiles``), so it gets
exactly the wanted number of rows, and applying the cuts is a projection:
rows never move. Rows with one id, or of ids with one 60-bit hash, stay on one
side; rows without a class are train rows, in fold k - 1, and not sampled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import uniform_hash
from .quantiles import values_at


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def _by_class(label: str, values: dict, default=0):
    """Literal lookup keyed by class (bounded by the number of classes)."""
    if not values:
        return F.lit(default)
    m = F.create_map(*sum([[F.lit(k), F.lit(v)] for k, v in values.items() if k is not None], []))
    return F.coalesce(F.element_at(m, F.col(label)), F.lit(default))


def _cuts(df: DataFrame, label: str | None, seed: int, salt: str, id_col: str, sizes: dict) -> tuple:
    """(hash column, {class: hashes}): for each class, the largest hash among its first ``size`` rows in hash
    order, -1 for none. Without a label the one class is None."""
    h = uniform_hash(id_col, seed, salt)
    by = [] if label is None else [label]
    wants = {(() if label is None else (c,)): [n - 1 for n in s] for c, s in sizes.items() if label is None or c is not None}
    hashes = df.select(*by, h.alias("_h")).persist()  # each pass that narrows the cuts reads them
    found = values_at(hashes, "_h", wants, by)
    hashes.unpersist()
    return h, {(g[0] if g else None): [-1 if v is None else v for v in vals] for g, vals in found.items()}


def _at(label: str | None, cuts: dict, i: int):
    """The i-th cut of a row's class (-1 for a null class)."""
    return F.lit(cuts[None][i]) if label is None else _by_class(label, {c: v[i] for c, v in cuts.items()}, -1)


def _sizes(df: DataFrame, label: str | None) -> dict:
    return {None: df.count()} if label is None else class_counts(df, label)


def split_data(df: DataFrame, label: str = "Class", test_size: float = 0.2,
               val_size: float = 0.0, seed: int = 42, stratify: bool = True,
               id_col: str = "row_id") -> DataFrame:
    """Add ``split`` in {train, val, test}.

    Per class: the first ``ceil(test_size * n)`` rows in hash order are test;
    with ``val_size > 0`` the next ``ceil(val_size / (1 - test_size) * rest)``
    are validation.
    """
    by = label if stratify else None
    counts = _sizes(df, by)
    val_adj = val_size / (1 - test_size) if val_size > 0 else 0.0
    sizes = {}
    for c, n in counts.items():
        test = math.ceil(test_size * n)
        sizes[c] = [test, test + (math.ceil(val_adj * (n - test)) if val_size > 0 else 0)]
    h, cuts = _cuts(df, by, seed, "", id_col, sizes)
    split = F.when(h <= _at(by, cuts, 0), F.lit("test")).when(h <= _at(by, cuts, 1), F.lit("val")).otherwise(F.lit("train"))
    return df.withColumn("split", split)


def stratified_kfold(df: DataFrame, label: str = "Class", k: int = 5, seed: int = 42,
                     id_col: str = "row_id") -> DataFrame:
    """Add ``fold``: each class in hash order is cut into k parts, the first ``n mod k`` one row larger."""
    counts = _sizes(df, label)
    ends = {c: [(f + 1) * (n // k) + min(f + 1, n % k) for f in range(k - 1)] for c, n in counts.items()}
    h, cuts = _cuts(df, label, seed, "fold", id_col, ends)
    fold = sum(((h > _at(label, cuts, f)).cast("int") for f in range(k - 1)), F.lit(0))
    return df.withColumn("fold", fold)


def random_under(df: DataFrame, label: str = "Class", seed: int = 42,
                 sampling_strategy: float | None = None, id_col: str = "row_id") -> DataFrame:
    """Keep all minority rows and ``int(n_min / strategy)`` rows of every other class."""
    strategy = 1.0 if sampling_strategy is None else sampling_strategy
    counts = {c: n for c, n in class_counts(df, label).items() if c is not None}
    if not counts:
        return df.limit(0)
    n_min = min(counts.values())
    minority = min((c for c in counts), key=lambda c: (counts[c], c))
    h, cuts = _cuts(df, label, seed, "under", id_col, {c: [n if c == minority else min(n, int(n_min / strategy))] for c, n in counts.items()})
    return df.where(h <= _at(label, cuts, 0))
