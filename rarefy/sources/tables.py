"""Transaction sources.

The reference reads one CSV with columns ``Time, V1..V28, Amount, Class``.
Here the same row shape is read from CSV / Parquet with an explicit schema
(no inference pass), and three views map the driver's tables onto it:

* ``tx_events``  events: row_id=event_id, Time=seconds since the first
  event, Amount=value, Class=(event_type='error').
* ``tx_vectors`` embeddings: row_id=vec_id, V1..V64=embedding[0..63],
  Class=(label=0).
* ``tx_lines``   lineitem: Amount=l_extendedprice, V1..V4=quantity,
  discount, tax, linenumber; Class=(returnflag='R'). No row key.
* ``scored``     tx_events with a fixed arithmetic score (ties on purpose).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The transaction row contract (column order of the input file).
CONTRACT = ["Time"] + [f"V{i}" for i in range(1, 29)] + ["Amount"]
LABEL = "Class"
#: components of an embedding, all of them features of ``tx_vectors``
VECTOR_SIZE = 64

TX_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in CONTRACT]
    + [T.StructField(LABEL, T.IntegerType(), True)]
)

_V_RE = re.compile(r"^V[0-9]+$")


def v_columns(df: DataFrame) -> list[str]:
    """Original component columns (``V<number>`` only, not ``V1_x_V2``)."""
    return [c for c in df.columns if _V_RE.match(c)]


def feature_columns(df: DataFrame, exclude=("row_id", LABEL)) -> list[str]:
    """Numeric columns usable as model inputs."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads is there."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def scan_transactions(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Load a transaction file with the fixed schema; fail if it is missing.

    CSV is read with a header and the explicit schema; Parquet keeps its own
    schema. A ``row_id`` column is added when the file has none.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no transaction file under {path}")
    if fmt == "csv":
        df = spark.read.schema(TX_SCHEMA).option("header", True).csv(path)
    else:
        df = spark.read.parquet(path)
    if "row_id" not in df.columns:
        # monotonically_increasing_id is stable for a fixed file split layout
        df = df.withColumn("row_id", F.monotonically_increasing_id())
    return df


def align_schema(df: DataFrame, contract=CONTRACT, keep=("row_id", LABEL)) -> DataFrame:
    """Add contract columns that are missing as 0.0 and fix their order."""
    cols = [F.col(c) for c in keep if c in df.columns]
    cols += [(F.col(c).cast("double") if c in df.columns else F.lit(0.0)).alias(c)
             for c in contract]
    return df.select(*cols)


def _ntz_micros(col: str):
    # events.ts is TIMESTAMP_NTZ: difference to the epoch, no time zone involved
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")


def fit_t0(ev: DataFrame) -> int:
    """First event time in microseconds (one scalar, fitted once)."""
    return ev.agg(F.min(_ntz_micros("ts")).alias("t0")).first()["t0"]


def events_to_tx(ev: DataFrame, t0: int) -> DataFrame:
    """Map raw events onto the transaction row (a projection; works on streams)."""
    us = _ntz_micros("ts")
    return ev.select(
        F.col("event_id").alias("row_id"),
        ((us - F.lit(t0)).cast("double") / F.lit(1000000.0)).alias("Time"),
        F.col("value").alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias(LABEL),
    )


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return events_to_tx(ev, fit_t0(ev))


def tx_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("row_id"),
        *[F.col("embedding")[i].cast("double").alias(f"V{i + 1}") for i in range(VECTOR_SIZE)],
        (F.col("label") == 0).cast("int").alias(LABEL),
    )


def tx_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_quantity").alias("V1"),
        F.col("l_discount").alias("V2"),
        F.col("l_tax").alias("V3"),
        F.col("l_linenumber").cast("double").alias("V4"),
        F.col("l_extendedprice").alias("Amount"),
        (F.col("l_returnflag") == "R").cast("int").alias(LABEL),
    )


def fixed_score(amount_col="Amount"):
    """Fixed arithmetic score in [0, 1), floored to two places so ties occur."""
    a = F.col(amount_col)
    return F.floor(F.lit(100.0) * a / (a + F.lit(50.0))) / F.lit(100.0)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = tx_events(spark, sf_dir)
    return tx.select("row_id", F.col(LABEL).alias("label"),
                     fixed_score().alias("score"))
