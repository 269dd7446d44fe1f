"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(cpus: int | None = None, app: str = "rarefy",
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Local session for tests, bench and the job runner."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = SparkSession.builder.master(f"local[{n}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
    b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read ``spark.checkpoint.dir`` (or the context's directory) from the
    session. Only when neither is set (local tests) a private folder is
    created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="rarefy-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: fewer rows than this stay in the partitions they are in, and dealt rows come in partitions of about the other at most
SPREAD_LEAST, SPREAD_ROWS = 50_000, 250_000


def spread(df, n: int, *keys):
    """``df`` of about ``n`` rows, dealt out evenly by hash of ``keys``, so that all cores share the work on it.

    A small file is one or two partitions however many rows it has, and what a join adds comes in others of
    any size; a model that is fitted in hundreds of short jobs waits for the largest one in each of them."""
    if n < SPREAD_LEAST:
        return df
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(cores * -(-n // (cores * SPREAD_ROWS)), *keys)


#: rows of a partition of fits side by side: at least, at most
PART_ROWS, PART_MOST = 20_000, 500_000


def parts_side_by_side(n: int, cores: int, parallelism: int) -> int:
    """Partitions of n rows that ``parallelism`` fits work on side by side. A fit is many short jobs, whose tasks cost
    more than few rows, so the fits share the cores and each has only twice its part of them, unless partitions grow too large."""
    return max(1, -(-n // PART_MOST), min(-(-n // PART_ROWS), -(-2 * cores // max(1, parallelism))))


_SHIPPED = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rarefy`` importable on executors (like ``--py-files``).

    Pandas UDFs of this package run in executor Python workers, which do
    not see the driver's ``sys.path``. The package is zipped once per
    application and added with ``addPyFile``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="rarefy-pkg-"), "rarefy.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("rarefy", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
