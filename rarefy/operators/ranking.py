"""Exact ranks and prefix sums without a single-partition window.

``hash_rank``: rank of each row within a class when rows are ordered by a
uniform hash. The hash's top bits pick a bucket; bucket sizes are a small
aggregate (classes x 2^bits rows); their per-class running sums give each
bucket's offset; the rank inside a bucket is a window over
(class, bucket), i.e. many small partitions, never one per class.

``running_sums``: running sums over a table ordered by any key (the
distinct-score table of AUC / AP), range-partitioned by Spark.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import HASH_BITS
from ..session import cut_lineage


def _bucket_bits(n_rows: int, rows_per_bucket: int = 2000, max_bits: int = 20) -> int:
    if n_rows <= rows_per_bucket:
        return 0
    return min(max_bits, int(math.ceil(math.log2(n_rows / rows_per_bucket))))


def hash_rank(df: DataFrame, part_cols, h_col: str, tie_col: str,
              out: str = "rank", n_rows: int | None = None) -> DataFrame:
    """Add ``out``: 0-based rank within ``part_cols`` ordered by (h, tie)."""
    part_cols = list(part_cols)
    if n_rows is None:
        n_rows = df.count()
    bits = _bucket_bits(n_rows)
    bcol = F.shiftright(F.col(h_col), HASH_BITS - bits) if bits else F.lit(0)
    d = df.withColumn("_hb", bcol)
    counts = d.groupBy(*part_cols, "_hb").agg(F.count("*").alias("_hc"))
    wo = (Window.partitionBy(*part_cols) if part_cols else Window.partitionBy(F.lit(0))) \
        .orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_hc").over(wo), F.lit(0))) \
        .drop("_hc")
    wr = Window.partitionBy(*part_cols, "_hb").orderBy(h_col, tie_col)
    return (d.join(offsets, on=[*part_cols, "_hb"])
            .withColumn(out, F.col("_off") + F.row_number().over(wr) - 1)
            .drop("_hb", "_off"))


def running_sums(df: DataFrame, order_col: str, sum_cols, ascending: bool = True, prefix: str = "cum_",
                 n_parts: int | None = None, part_rows: int = 1_000_000, least_rows: int = 20_000) -> tuple[DataFrame, dict]:
    """Inclusive running sums of ``sum_cols`` in ``order_col`` order, and the whole sums.

    ``order_col`` must be distinct per row (aggregate ties first). The rows are
    range-partitioned once and written; the totals of the partitions (one row each)
    become offsets, and a window inside each partition adds the rest. ``df`` is
    computed once.
    """
    sum_cols, spark = list(sum_cols), df.sparkSession
    held = df.persist()
    n = held.count()
    # few rows need few partitions: each is a file and several tasks
    parts = n_parts or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // least_rows)), -(-n // part_rows))
    order = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    ranged = cut_lineage(held.repartitionByRange(parts, order).withColumn("_b", F.spark_partition_id()))
    held.unpersist()
    run, rows = [0] * len(sum_cols), []
    for r in ranged.groupBy("_b").agg(*[F.sum(c).alias(c) for c in sum_cols]).orderBy("_b").collect():
        rows.append((r["_b"], *run))
        run = [a + (r[c] or 0) for a, c in zip(run, sum_cols)]
    kinds = [ranged.select(F.sum(c)).dtypes[0][1] for c in sum_cols]
    rows = [(r[0], *[float(v) if k == "double" else v for v, k in zip(r[1:], kinds)]) for r in rows]
    offsets = spark.createDataFrame(rows, "_b int, " + ", ".join(f"_o_{c} {k}" for c, k in zip(sum_cols, kinds)))
    w = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(offsets), on="_b")  # one row per partition
    for c in sum_cols:
        out = out.withColumn(prefix + c, F.col(f"_o_{c}") + F.sum(c).over(w))
    return out.drop("_b", *[f"_o_{c}" for c in sum_cols]), dict(zip(sum_cols, run))


def ordered_cumsum(df: DataFrame, order_col: str, sum_cols, ascending: bool = True, **kw) -> DataFrame:
    """The running sums of ``running_sums`` alone."""
    return running_sums(df, order_col, sum_cols, ascending, **kw)[0]
