"""Sources and sinks.

Parquet between stages (typed, column-pruned, partition-pruned); CSV and
JSON only at the edges.  Intermediate tables go under the session's shared
checkpoint folder, never a machine-local path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..specs import PREDICTION_ID_COLUMNS

_NEVER = "\u0001"   # a null marker that cannot occur in text, so '' stays ''


def read_raw(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with every value kept as text; no NA inference (an
    empty field is the empty string, 'NA' is the text 'NA')."""
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("nullValue", _NEVER).option("emptyValue", "")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(path)


def write_raw(df: DataFrame, path: str) -> None:
    """Edge CSV writer that keeps text exactly (spaces, empty strings)."""
    (df.write.mode("overwrite").option("header", True).option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ("split",)) -> None:
    """Typed Parquet, partitioned (by period) so readers prune."""
    w = df.write.mode("overwrite")
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def read_stage(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Reload with the written (or a fixed) schema, no re-inference."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def prediction_frame(df: DataFrame, observed: Column | str, probability: Column | str,
                     id_columns: Sequence[str] = PREDICTION_ID_COLUMNS, **extra) -> DataFrame:
    """The id columns that exist, then observed, probability and extras
    (columns or literals)."""
    ids = [c for c in id_columns if c in df.columns]
    col = lambda c: F.col(c) if isinstance(c, str) else c
    extras = [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in extra.items()]
    return df.select(*ids, col(observed).alias("observed"),
                     col(probability).cast("double").alias("probability"), *extras)


def metrics_long(df: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """S6 layout: one row per (ids..., metric, value) from a wide metric row."""
    metric_cols = [c for c in df.columns if c not in id_columns]
    return df.select(*id_columns, F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metric_cols])))


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics as JSON lines, sorted keys, NaN allowed (undefined = null)."""
    df.coalesce(1).write.mode("overwrite").json(path)
