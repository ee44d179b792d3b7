"""Source/sink and streaming queries (S1, S2, S4-S6, streaming forms)."""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import functions as F

from ..operators import clean, labels, score, split
from ..session import scratch_path
from ..sources import io
from ..streaming import stream
from . import fixtures as fx
from .catalog import CLEAN_SQL, COMPOSITE_LABEL_SQL, _finding_sql, _score_sql, _split_case, cleaned_intake
from .metric_queries import BUNDLE_SQL, PREDS_SQL_CTE, q_binary_metrics
from .registry import STANDIN_SPLIT, register
from ..specs import SCORECARD_C


def _tag(sf_dir: str) -> str:
    return hashlib.md5(os.path.abspath(sf_dir).encode()).hexdigest()[:10]


def _run_tag(sf_dir: str) -> str:
    """A fresh name per streaming run: a stream's sink and checkpoint belong
    to one run, so a later run never reads an earlier run's output."""
    return f"{_tag(sf_dir)}_{uuid.uuid4().hex[:12]}"


@register("raw_csv_intake", fx.with_ctes(CLEAN_SQL, "raw"))
def q_raw_csv_intake(spark, sf_dir):
    """S1 + C1-C4: the all-text intake written as CSV and read back with no
    NA inference (blanks, 'NA' text and padding survive), then cleaned."""
    path = scratch_path(spark, f"raw_csv_{_tag(sf_dir)}")
    io.write_raw(fx.raw_intake(spark, sf_dir), path)
    raw = io.read_raw(spark, path, [n for n, _ in fx.RAW_COLUMNS])
    return clean.clean_columns(raw, fx.RAW_NUMERIC, fx.RAW_BINARY, fx.RAW_TRACKED)


@register("partitioned_stage", fx.with_ctes(
    "SELECT split, count(*) AS n_rows, count(DISTINCT study_patient_id) AS patients FROM "
    "(SELECT " + _split_case("index_year") + " AS split, study_patient_id FROM registry) "
    "WHERE split = 'temporal' GROUP BY split", "registry"))
def q_partitioned_stage(spark, sf_dir):
    """S4 + S2: the split registry written as Parquet partitioned by period
    and re-read for the temporal period only (partition pruning)."""
    path = scratch_path(spark, f"registry_split_{_tag(sf_dir)}")
    io.write_stage(split.split_temporal(fx.registry(spark, sf_dir), STANDIN_SPLIT), path)
    later = io.read_stage(spark, path).filter(F.col("split") == "temporal")
    return later.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.countDistinct("study_patient_id").alias("patients"))


@register("prediction_frame", f"WITH {PREDS_SQL_CTE}\n"
          "SELECT study_patient_id, study_case_id, index_year, observed, probability, "
          "'formula' AS model_key FROM preds")
def q_prediction_frame(spark, sf_dir):
    """Id columns that exist + observed + probability + model key."""
    return io.prediction_frame(fx.predictions(spark, sf_dir), "observed", "probability", model_key="formula")


@register("metrics_long", "WITH b AS (" + BUNDLE_SQL.replace("\n", " ") + ") "
          "SELECT split, metric, value FROM (UNPIVOT (SELECT split, "
          "CAST(COLUMNS(* EXCLUDE (split)) AS DOUBLE) FROM b) ON COLUMNS(* EXCLUDE (split)) "
          "INTO NAME metric VALUE value)")
def q_metrics_long(spark, sf_dir):
    """S6 layout: the metric bundle as (split, metric, value) rows."""
    return io.metrics_long(q_binary_metrics(spark, sf_dir), ["split"])


@register("stream_scored_episodes", fx.with_ctes(
    f"SELECT {COMPOSITE_LABEL_SQL} AS derived_high_complexity_case, {_score_sql(SCORECARD_C)} AS pcoma_c_score, "
    "count(*) AS n FROM registry GROUP BY ALL", "registry"))
def q_stream_scored_episodes(spark, sf_dir):
    """Streaming form: line items arrive as a file stream, join the static
    orders table, get the composite label (E1) and the scorecard (K1) with
    the same operators as batch, and land in a Parquet sink (availableNow);
    the sink is then summarised."""
    li = fx.table(spark, sf_dir, "lineitem")
    s = stream.file_stream(spark, os.path.join(sf_dir, "lineitem*.parquet"), li)
    reg = fx.registry_from(s, fx.table(spark, sf_dir, "orders"))
    scored = score.score_c(labels.composite_label(reg)).select(
        "study_case_id", "derived_high_complexity_case", "pcoma_c_score")
    path = stream.run_to_table(scored, f"scored_{_run_tag(sf_dir)}")
    out = spark.read.parquet(path)
    return out.groupBy("derived_high_complexity_case", "pcoma_c_score").agg(F.count(F.lit(1)).alias("n"))


@register("stream_binary_findings", fx.with_ctes(" UNION ALL ".join(
    _finding_sql("binary_domain", c,
                 f"count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) IS NOT NULL AND TRY_CAST({c} AS DOUBLE) NOT IN (0, 1))",
                 "raw") for c in fx.RAW_BINARY), "raw").replace(" AS n FROM (SELECT", " AS n, CAST(0 AS BIGINT) AS batch_id FROM (SELECT"))
def q_stream_binary_findings(spark, sf_dir):
    """Streaming form of a whole-table check: the C3 domain check run per
    micro-batch with foreachBatch (one batch per input file here)."""
    od = fx.table(spark, sf_dir, "orders")
    s = stream.file_stream(spark, os.path.join(sf_dir, "orders*.parquet"), od)
    raw = s.selectExpr(*fx._exprs(fx.RAW_COLUMNS, fx._DAYS_SPARK))
    path = stream.findings_per_batch(raw, lambda b: clean.binary_findings(b, fx.RAW_BINARY),
                                     f"binary_findings_{_run_tag(sf_dir)}")
    return spark.read.parquet(path)
