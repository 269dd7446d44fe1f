"""Rows of model fits are dealt out evenly, and ensembles score each row once."""

from pyspark.sql import functions as F

from rarefy.operators import ensemble_fit as EF
from rarefy.operators.split import class_counts, split_data
from rarefy.plans.catalog_models import ModelData
from rarefy.session import SPREAD_LEAST, spread


def test_model_rows_of_one_partition_are_dealt_out(spark):
    n = SPREAD_LEAST + 2000
    tx = spark.range(n, numPartitions=1).select(
        F.col("id").alias("row_id"), (F.col("id") * 7.0).alias("Time"), (F.pmod(F.col("id") * 37, F.lit(1009)) + 0.5).alias("Amount"),
        (F.col("id") % 5 == 0).cast("int").alias("Class"))
    md = ModelData(spark, "unused", resample=None, tx=tx)
    cores = spark.sparkContext.defaultParallelism
    for rows in (md.train, md.test):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == cores and max(sizes) < 1.2 * sum(sizes) / cores
    # the same rows as before, on the same sides
    want = split_data(tx, "Class", 0.2, 0.0, 42)
    assert md.train.select("row_id").exceptAll(want.where("split = 'train'").select("row_id")).isEmpty()
    assert class_counts(md.train, "Class") == class_counts(want.where("split = 'train'"), "Class")
    assert class_counts(md.test, "Class") == class_counts(want.where("split = 'test'"), "Class")


def test_spread_keeps_rows_and_leaves_small_tables(spark):
    few = spark.range(100, numPartitions=3)
    assert spread(few, 100, "id").rdd.getNumPartitions() == 3
    rows = spark.range(SPREAD_LEAST).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"), "id")
    dealt = spread(rows, SPREAD_LEAST, "key", "id")
    assert dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()


def test_ensemble_scores_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def scored(x):
        seen.add(1)
        return (x % 10) / 10

    class Members:
        def transform(self, df, label):
            d = df.withColumn("score", F.udf(scored, "double")("row_id").cast("double"))
            return d.select("row_id", F.col(label).alias("label"), "score", (F.col("score") > 0.5).cast("int").alias("prediction"))

    df = spark.range(200, numPartitions=2).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("Class"))
    metrics, report, confusion = EF.evaluate_ensemble(Members(), df)
    assert seen.value == 200
    assert metrics.first()["accuracy"] is not None and report.count() == 5
    assert confusion.agg(F.sum(F.col("pred_0") + F.col("pred_1"))).first()[0] == 200


def test_running_sums_of_few_rows_take_few_partitions(spark):
    from rarefy.operators.ranking import running_sums
    rows = spark.range(1000).select(F.col("id").cast("double").alias("score"), F.lit(1).cast("long").alias("pos"))
    out, total = running_sums(rows, "score", ["pos"])
    assert total == {"pos": 1000}
    assert out.where(F.col("cum_pos") != F.col("score") + 1).isEmpty()
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() == 1
