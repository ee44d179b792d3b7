"""Structured Streaming use of the row-wise operators.

Cleaning, endpoint rules, scorecards, logit and locked scoring are pure
projections, so they run unchanged on a streaming DataFrame; whole-table
checks (findings) run per micro-batch through ``foreachBatch``.  Episodes
arriving as files are joined to a static dimension table (stream-static
join) and written with exactly-once file sinks and a checkpoint.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir


def file_stream(spark: SparkSession, path_glob: str, like: DataFrame,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream with the schema of a batch table (no inference)."""
    r = spark.readStream.schema(like.schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path_glob)


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> str:
    """Run a stream to completion of the available input (availableNow)
    into a Parquet table under the shared checkpoint folder; returns the
    table path."""
    spark = stream.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    q: StreamingQuery = (stream.writeStream.format("parquet").outputMode(mode)
                         .option("checkpointLocation", os.path.join(base, "_checkpoint"))
                         .option("path", os.path.join(base, "data"))
                         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return os.path.join(base, "data")


def findings_per_batch(stream: DataFrame, findings: Callable[[DataFrame], DataFrame], name: str) -> str:
    """Whole-table checks on each micro-batch (foreachBatch), appended with
    the batch id to a findings table; returns its path."""
    spark = stream.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    out = os.path.join(base, "data")

    def each(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql import functions as F
        findings(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(out)

    q = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", os.path.join(base, "_checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out
