"""Class-imbalance resampling on top of the exact kNN join.

Randomness is a hash of (row id, draw number, seed), so the synthetic rows
do not depend on partitioning or re-execution. Synthetic rows get negative
ids ``-(1 + rank + n_min * j)`` so they never collide with real ones.

* SMOTE: every minority row gets floor(n_new / n_min) draws, the first
  n_new mod n_min rows in hash order one more (exact total); a draw picks
  one of the row's k minority neighbours and a gap in [0, 1).
* ADASYN: draws per row proportional to the share of majority rows among
  its k neighbours over all rows, rint(ratio * n_new).
* NearMiss-3, Tomek links, ENN: kNN joins, then aggregates and anti joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import unit_uniform, uniform_hash
from ..session import cut_lineage
from .knn import knn_join
from .quantiles import order_statistics
from .ranking import hash_rank
from .split import class_counts, random_under


def _minority_majority(counts: dict):
    mino = min(counts, key=lambda c: (counts[c], c))
    majo = max(counts, key=lambda c: (counts[c], -c if isinstance(c, (int, float)) else 0))
    return mino, majo


def top_n_by(df: DataFrame, key: str, n: int, id_col: str = "row_id",
             descending: bool = True) -> DataFrame:
    """Exactly n rows with the largest (or smallest) key, ties by smaller id.

    Uses exact order statistics (no global sort + limit into one partition).
    """
    total = df.count()
    if n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    rank = total - n if descending else n - 1
    t = order_statistics(df, key, [rank])[(key,)][0]
    strict = (F.col(key) > F.lit(t)) if descending else (F.col(key) < F.lit(t))
    n_strict = df.where(strict).count()
    ties = df.where(F.col(key) == F.lit(t))
    need = n - n_strict
    tid = order_statistics(ties, id_col, [need - 1])[(id_col,)][0]
    return df.where(strict).unionByName(ties.where(F.col(id_col) <= F.lit(tid)))


DRAW_BLOCK = 100_000


def _draws(ranked: DataFrame, m, id_col: str, features) -> DataFrame:
    """(row_id, _rank, features, j) for j in [0, m): one row may own millions of draws
    (tiny minority, huge majority), so the expansion is cut into blocks of at
    most DRAW_BLOCK draws that are hash-partitioned before being exploded."""
    d = ranked.select(id_col, "_rank", *features, m.cast("long").alias("_m")).where(F.col("_m") > 0)
    nblk = F.ceil(F.col("_m") / F.lit(DRAW_BLOCK)).cast("long")
    blocks = d.select(id_col, "_rank", *features, "_m", F.explode(F.sequence(F.lit(0).cast("long"), nblk - 1)).alias("_blk"))
    blocks = blocks.repartition(id_col, "_blk")
    lo = F.col("_blk") * F.lit(DRAW_BLOCK)
    hi = F.least(lo + F.lit(DRAW_BLOCK), F.col("_m")) - 1
    return blocks.select(id_col, "_rank", *features, F.explode(F.sequence(lo, hi)).alias("j"))


def _synthesize(base: DataFrame, draws: DataFrame, nbrs: DataFrame, features, label: str,
                cls, k_eff: int, seed: int, n_min: int, id_col: str) -> DataFrame:
    """draws: (row_id, _rank, features, j). Pick neighbour and gap by hash; interpolate."""
    key = F.concat_ws(":", F.col(id_col).cast("string"), F.col("j").cast("string"))
    d = draws.withColumn("_pick", (F.pmod(uniform_hash(key, seed, "nn"), F.lit(k_eff)) + 1).cast("int")) \
        .withColumn("_gap", unit_uniform(key, seed, "gap"))
    d = d.join(nbrs.select(F.col("q_id").alias(id_col), F.col("rank").alias("_pick"), "r_v"),
               on=[id_col, "_pick"])
    new = [(F.col(f) + F.col("_gap") * (F.col("r_v")[i] - F.col(f))).alias(f)
           for i, f in enumerate(features)]
    sid = (-(F.lit(1) + F.col("_rank") + F.lit(n_min) * F.col("j"))).cast("long").alias(id_col)
    return d.select(sid, *new, F.lit(cls).cast(base.schema[label].dataType).alias(label))


def smote(df: DataFrame, features, label: str = "Class", k: int = 5, seed: int = 42,
          sampling_strategy: float | None = None, id_col: str = "row_id", **knn_kw) -> DataFrame:
    """Original rows plus synthetic minority rows up to strategy x majority count."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df.select(id_col, *features, label)
    mino, majo = _minority_majority(counts)
    strategy = 1.0 if sampling_strategy is None else sampling_strategy
    n_min = counts[mino]
    n_new = int(strategy * counts[majo]) - n_min
    base = df.select(id_col, *features, label)
    # rows with a null feature stay but seed nothing; the others make up the whole number
    # (written once: it is read by the count, both sides of the kNN join and the ranks, and features may be long expressions)
    minority = cut_lineage(base.where(F.col(label) == F.lit(mino))).dropna(subset=list(features))
    n_min = minority.count()
    k_eff = min(k, n_min - 1)
    if n_new <= 0 or k_eff < 1:
        return base
    nbrs = knn_join(minority, minority, features, k_eff, id_col, exclude_self=True,
                    with_vectors=True, **knn_kw)
    ranked = hash_rank(minority.withColumn("_h", uniform_hash(id_col, seed, "smote")),
                       [], "_h", id_col, "_rank", n_rows=n_min)
    per, extra = divmod(n_new, n_min)
    m = F.lit(per) + (F.col("_rank") < F.lit(extra)).cast("int")
    draws = _draws(ranked, m, id_col, features)
    syn = _synthesize(base, draws, nbrs, features, label, mino, k_eff, seed, n_min, id_col)
    return base.unionByName(syn)


def adasyn(df: DataFrame, features, label: str = "Class", k: int = 5, seed: int = 42,
           sampling_strategy: float | None = None, id_col: str = "row_id", **knn_kw) -> DataFrame:
    counts = class_counts(df, label)
    base = df.select(id_col, *features, label)
    if len(counts) < 2:
        return base
    mino, majo = _minority_majority(counts)
    strategy = 1.0 if sampling_strategy is None else sampling_strategy
    n_min = counts[mino]
    n_new = int(strategy * counts[majo]) - n_min
    # rows with a null feature stay but seed nothing
    # (written once: it is read by the count, both sides of the kNN join and the ranks, and features may be long expressions)
    minority = cut_lineage(base.where(F.col(label) == F.lit(mino))).dropna(subset=list(features))
    n_min = minority.count()
    k_eff = min(k, n_min - 1)
    if n_new <= 0 or k_eff < 1:
        return base
    around = knn_join(minority, base, features, k, id_col, ref_cols=[label], exclude_self=True, **knn_kw)
    # majority share among the k neighbours, normalised over all minority rows:
    # kept as integer counts so the normalisation is exact
    cnt = around.groupBy("q_id").agg(F.count_if(F.col(label) != F.lit(mino)).alias("_c"))
    total = cnt.agg(F.sum("_c")).first()[0] or 0
    if total == 0:
        raise ValueError("No neighbours belong to the majority class; ADASYN cannot weight rows.")
    gen = cnt.select(F.col("q_id").alias(id_col),
                     F.rint(F.col("_c").cast("double") * F.lit(float(n_new)) / F.lit(float(total)))
                     .cast("long").alias("_m"))
    ranked = hash_rank(minority.withColumn("_h", uniform_hash(id_col, seed, "adasyn")),
                       [], "_h", id_col, "_rank", n_rows=n_min).join(gen, on=id_col)
    draws = _draws(ranked, F.col("_m"), id_col, features)
    nbrs = knn_join(minority, minority, features, k_eff, id_col, exclude_self=True,
                    with_vectors=True, **knn_kw)
    syn = _synthesize(base, draws, nbrs, features, label, mino, k_eff, seed, n_min, id_col)
    return base.unionByName(syn)


def nearmiss3(df: DataFrame, features, label: str = "Class", n_neighbors: int = 3,
              n_neighbors_ver3: int = 3, sampling_strategy: float | None = None,
              id_col: str = "row_id", **knn_kw) -> DataFrame:
    """Keep majority rows near the minority, then those farthest on average from it."""
    counts = class_counts(df, label)
    base = df.select(id_col, *features, label)
    if len(counts) < 2:
        return base
    mino, majo = _minority_majority(counts)
    strategy = 1.0 if sampling_strategy is None else sampling_strategy
    n_keep = int(counts[mino] / strategy)
    minority = base.where(F.col(label) == F.lit(mino))
    majority = base.where(F.col(label) != F.lit(mino))
    near = knn_join(minority, majority, features, n_neighbors_ver3, id_col, **knn_kw)
    cand = near.select(F.col("r_id").alias(id_col)).distinct().join(majority, on=id_col)
    far = knn_join(cand, minority, features, n_neighbors, id_col, **knn_kw)
    # written once: each pass that looks for the cut reads it
    score = cut_lineage(far.groupBy("q_id").agg(F.avg("dist").alias("_avg")).withColumnRenamed("q_id", id_col))
    chosen = top_n_by(score, "_avg", n_keep, id_col, descending=True).select(id_col)
    return minority.unionByName(majority.join(chosen, on=id_col, how="left_semi"))


def tomek_pairs(df: DataFrame, features, label: str = "Class", id_col: str = "row_id",
                **knn_kw) -> DataFrame:
    """Rows in a Tomek link: mutual nearest neighbours of different classes."""
    base = df.select(id_col, *features, label)
    nn = knn_join(base, base, features, 1, id_col, ref_cols=[label], exclude_self=True, **knn_kw) \
        .select("q_id", "r_id", F.col(label).alias("_rl"))
    # of a mutual pair, each row's label is its neighbour's neighbour label
    back = nn.select(F.col("q_id").alias("r_id"), F.col("r_id").alias("q_id"), F.col("_rl").alias("_ql"))
    links = nn.join(back, on=["q_id", "r_id"]).where(F.col("_ql") != F.col("_rl"))
    return links.select(F.col("q_id").alias(id_col), F.col("_ql").alias(label))


def tomek_links(df: DataFrame, features, label: str = "Class", strategy: str = "auto",
                id_col: str = "row_id", **knn_kw) -> DataFrame:
    """Drop link members: of every class but the minority ('auto') or all ('all')."""
    base = df.select(id_col, *features, label)
    links = tomek_pairs(base, features, label, id_col, **knn_kw)
    if strategy == "auto":
        mino, _ = _minority_majority(class_counts(base, label))
        links = links.where(F.col(label) != F.lit(mino))
    return base.join(links.select(id_col), on=id_col, how="left_anti")


def enn(df: DataFrame, features, label: str = "Class", k: int = 3, strategy: str = "auto",
        id_col: str = "row_id", **knn_kw) -> DataFrame:
    """Edited nearest neighbours ('all' rule): drop rows whose k neighbours are
    not all of their own class (only non-minority classes under 'auto')."""
    base = df.select(id_col, *features, label)
    nn = knn_join(base, base, features, k, id_col, ref_cols=[label], exclude_self=True, **knn_kw)
    around = nn.groupBy(F.col("q_id").alias(id_col)).agg(F.min(label).alias("_least"), F.max(label).alias("_most"))
    keep = F.col("_least").isNull() | ((F.col("_least") == F.col(label)) & (F.col("_most") == F.col(label))) | F.col(label).isNull()
    if strategy == "auto":
        mino, _ = _minority_majority(class_counts(base, label))
        keep = keep | (F.col(label) == F.lit(mino))
    return base.join(around, on=id_col, how="left").where(keep).drop("_least", "_most")


def smote_tomek(df, features, label="Class", seed=42, sampling_strategy=None, id_col="row_id", **kw):
    # the rows are written once: each pass of the kNN join would draw them anew
    s = cut_lineage(smote(df, features, label, seed=seed, sampling_strategy=sampling_strategy, id_col=id_col, **kw))
    return tomek_links(s, features, label, "all", id_col, **kw)


def smote_enn(df, features, label="Class", seed=42, sampling_strategy=None, id_col="row_id", **kw):
    # the rows are written once: each pass of the kNN join would draw them anew
    s = cut_lineage(smote(df, features, label, seed=seed, sampling_strategy=sampling_strategy, id_col=id_col, **kw))
    return enn(s, features, label, 3, "all", id_col, **kw)


METHODS = ("none", "smote", "adasyn", "random_under", "nearmiss", "smote_tomek", "smote_enn")


@dataclass
class ResampleResult:
    data: DataFrame
    before: dict
    after: dict


def handle_imbalance(df: DataFrame, features, label: str = "Class", method: str | None = "smote",
                     seed: int = 42, sampling_strategy: float | None = None,
                     id_col: str = "row_id", count: bool = True, **kw) -> ResampleResult:
    """Dispatch by method name; ``none`` (or None) passes rows through."""
    m = "none" if method is None else method.lower()
    if m not in METHODS:
        raise ValueError(f"no resampling method {method!r}; there are {', '.join(METHODS)}")
    before = class_counts(df, label) if count else {}
    if m == "none":
        out = df
    elif m == "smote":
        out = smote(df, features, label, seed=seed, sampling_strategy=sampling_strategy, id_col=id_col, **kw)
    elif m == "adasyn":
        out = adasyn(df, features, label, seed=seed, sampling_strategy=sampling_strategy, id_col=id_col, **kw)
    elif m == "random_under":
        out = random_under(df, label, seed, sampling_strategy, id_col)
    elif m == "nearmiss":
        out = nearmiss3(df, features, label, sampling_strategy=sampling_strategy, id_col=id_col, **kw)
    elif m == "smote_tomek":
        out = smote_tomek(df, features, label, seed, sampling_strategy, id_col, **kw)
    else:
        out = smote_enn(df, features, label, seed, sampling_strategy, id_col, **kw)
    after = class_counts(out, label) if count else {}
    return ResampleResult(out, before, after)
