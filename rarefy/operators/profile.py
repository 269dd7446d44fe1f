"""Profiling: shape, types, describe, nulls, class balance, correlations,
densities and box statistics, all as aggregates (tables, not figures).

Wide one-pass aggregates (``df.agg`` over every column) are preferred to
unpivot + groupBy: they combine map-side into one row per partition, so
no column's values ever meet in a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .moments import co_moments, correlations
from .quantiles import exact_quantiles


def numeric_columns(df: DataFrame, exclude=("row_id",)) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def shape_head(df: DataFrame, order_col: str = "row_id", n: int = 5) -> DataFrame:
    """First n rows by key, with the table's row and column counts."""
    n_rows = df.count()
    return (df.orderBy(order_col).limit(n)
            .withColumn("n_rows", F.lit(n_rows).cast("long"))
            .withColumn("n_cols", F.lit(len(df.columns))))


def dtype_info(df: DataFrame) -> DataFrame:
    """Column, type name and non-null count (one aggregate pass)."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    spark = df.sparkSession
    data = [(i, f.name, f.dataType.simpleString(), int(row[f.name]))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(data, "position int, column string, dtype string, non_null long")


def null_counts(df: DataFrame) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "null_count")


def describe(df: DataFrame, cols=None, approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per numeric column."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    row = df.agg(*aggs).first()
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
    data = []
    for c in cols:
        qs = q[(c,)]
        data.append((c, int(row[f"{c}__n"]), row[f"{c}__mean"], row[f"{c}__std"],
                     row[f"{c}__min"], qs[0], qs[1], qs[2], row[f"{c}__max"]))
    return df.sparkSession.createDataFrame(
        data, "feature string, count long, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")


def class_distribution(df: DataFrame, label: str = "Class") -> DataFrame:
    """Counts per class and their percentage of all rows."""
    g = df.groupBy(label).agg(F.count("*").alias("n"))
    tot = Window.partitionBy(F.lit(1))  # over the per-class table (#classes rows)
    return g.withColumn("pct", F.col("n") * F.lit(100.0) / F.sum("n").over(tot))


def corr_pairs(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation of every pair i > j (lower triangle) in one aggregate; null where it isn't defined."""
    cols = list(cols)
    r = correlations(co_moments(df, cols))
    data = [(cols[i], cols[j], None if math.isnan(r[i, j]) else float(r[i, j])) for i in range(len(cols)) for j in range(i)]
    return df.sparkSession.createDataFrame(data, "feature_a string, feature_b string, corr double")


def corr_with_label(df: DataFrame, cols, label: str = "Class") -> DataFrame:
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c)
                   for c in cols]).first()
    data = [(c, row[c]) for c in cols]
    return df.sparkSession.createDataFrame(data, "feature string, corr double") \
        .withColumn("abs_corr", F.abs("corr"))


def corr_topk(df: DataFrame, cols, label: str = "Class", n: int = 10) -> DataFrame:
    """Top-n features by absolute correlation with the label (a top-k report)."""
    c = corr_with_label(df, cols, label).where(F.col("abs_corr").isNotNull())
    return c.orderBy(F.desc("abs_corr"), F.asc("feature")).limit(n)


def density_by_class(df: DataFrame, cols, label: str = "Class", bins: int = 50) -> DataFrame:
    """Histogram per feature and class plus a Gaussian kernel density.

    The kernel is evaluated on bin centres from the binned counts
    (Scott bandwidth ``std * n^(-1/5)`` of the class), an approximation of
    the exact per-row kernel sum whose cost does not grow with the rows.
    """
    cols = list(cols)
    rng = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__lo") for c in cols],
                 *[F.max(F.col(c).cast("double")).alias(f"{c}__hi") for c in cols]).first()
    tall = df.select(F.col(label), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([label], cols, "feature", "x").where(F.col("x").isNotNull())
    lo = F.element_at(F.create_map(*sum([[F.lit(c), F.lit(rng[f"{c}__lo"])] for c in cols], [])), F.col("feature"))
    hi = F.element_at(F.create_map(*sum([[F.lit(c), F.lit(rng[f"{c}__hi"])] for c in cols], [])), F.col("feature"))
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi > lo, F.least(F.floor((F.col("x") - lo) / width).cast("int"), F.lit(bins - 1))) \
        .otherwise(F.lit(0))
    t = tall.withColumn("lo", lo).withColumn("hi", hi).withColumn("bin", b)
    stats = t.groupBy("feature", label).agg(F.count("x").alias("n_class"),
                                            F.stddev_samp("x").alias("sd"))
    hist = t.groupBy("feature", label, "bin", "lo", "hi").agg(F.count("*").alias("n"))
    center = lambda i: F.col("lo") + (i.cast("double") + F.lit(0.5)) * (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    # per (feature, class) at most bins x bins pairs of a filled bin and a bin of the grid
    grid = (hist.select("feature", label, "lo", "hi").distinct().join(stats, on=["feature", label])
            .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
            .withColumn("bw", F.col("sd") * F.pow(F.col("n_class").cast("double"), F.lit(-0.2))).withColumn("x", center(F.col("bin"))))
    filled = hist.select("feature", label, F.col("bin").alias("_b"), F.col("n").alias("_n"), center(F.col("bin")).alias("_c"))
    z = (F.col("x") - F.col("_c")) / F.col("bw")
    out = (grid.join(filled, on=["feature", label]).groupBy("feature", label, "bin", "x", "bw", "n_class")
           .agg(F.sum(F.col("_n").cast("double") * F.exp(F.lit(-0.5) * (z * z))).alias("kde"),
                F.sum(F.when(F.col("_b") == F.col("bin"), F.col("_n")).otherwise(F.lit(0))).cast("long").alias("n")))
    norm = F.col("n_class").cast("double") * F.col("bw") * F.lit(math.sqrt(2.0 * math.pi))
    return out.select("feature", label, "bin", "x", "n", F.when(F.col("bw") > 0, F.col("kde") / norm).alias("density"))


def box_stats(df: DataFrame, cols, label: str = "Class", approx: bool = False) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier counts per feature and class."""
    cols = list(cols)
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by=[label], approx=approx)
    rows = [(k[0], k[1], v[0], v[1], v[2]) for k, v in q.items() if v[0] is not None]
    sch = T.StructType([T.StructField(label, df.schema[label].dataType),
                        T.StructField("feature", T.StringType()),
                        T.StructField("q1", T.DoubleType()), T.StructField("median", T.DoubleType()),
                        T.StructField("q3", T.DoubleType())])
    qdf = df.sparkSession.createDataFrame(rows, sch) \
        .withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lo_fence", F.col("q1") - F.lit(1.5) * F.col("iqr")) \
        .withColumn("hi_fence", F.col("q3") + F.lit(1.5) * F.col("iqr"))
    tall = df.select(F.col(label), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([label], cols, "feature", "x").where(F.col("x").isNotNull())
    # qdf has #classes x #features rows: a bounded broadcast
    j = tall.join(F.broadcast(qdf), on=[label, "feature"])
    agg = j.groupBy(label, "feature").agg(
        F.min(F.when(F.col("x") >= F.col("lo_fence"), F.col("x"))).alias("whisker_lo"),
        F.max(F.when(F.col("x") <= F.col("hi_fence"), F.col("x"))).alias("whisker_hi"),
        F.count_if((F.col("x") < F.col("lo_fence")) | (F.col("x") > F.col("hi_fence"))).alias("n_outliers"),
        F.count("*").alias("n"))
    return qdf.join(agg, on=[label, "feature"]).select(
        label, "feature", "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "n_outliers")
