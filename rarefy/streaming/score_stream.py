"""Score transactions as they arrive (Structured Streaming).

``readStream`` over the source folder with a fixed schema -> the same
projection that batch scoring uses (fitted statistics re-applied as
literals, no aggregation, so the query is stateless) -> ``transform`` of
the saved model -> risk band -> append to a Parquet sink. The checkpoint
location makes the sink exactly-once across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import risk_band


def scored_view(model, rows: DataFrame) -> DataFrame:
    out = model.transform(rows)
    return out.select("row_id", "score", "prediction",
                      risk_band("score", "prediction").alias("risk_band"))


def stream_score(spark: SparkSession, source: str, schema, prepare, model, sink: str,
                 checkpoint: str, available_now: bool = True, max_files_per_trigger: int | None = None,
                 file_glob: str | None = None):
    """Start the scoring stream; returns the StreamingQuery.

    ``prepare(df) -> df`` maps source rows to raw transactions or model inputs (projection
    only). A model with a feature stage aligns them itself (``align_schema``).
    With ``available_now`` the query processes what is there and stops. Started again with
    the same checkpoint it goes on after the files it has committed, so a stream that was
    stopped at any point gives each row once.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    src = reader.parquet(source)
    out = scored_view(model, prepare(src))
    w = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
