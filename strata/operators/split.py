"""Time-gated development / temporal split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import num
from ..specs import SplitSpec
from .validate import _finding, _long, check_group_overlap, union_findings

DEVELOPMENT, TEMPORAL = "development", "temporal"


def _split_of(year, spec: SplitSpec):
    return (F.when(year.between(spec.development_start_year, spec.development_end_year), DEVELOPMENT)
            .when(year.between(spec.temporal_start_year, spec.temporal_end_year), TEMPORAL))


def split_temporal(df: DataFrame, spec: SplitSpec, year_col: str = "index_year",
                   policy: str = "by_row", group_col: str = "study_patient_id",
                   out: str = "split") -> DataFrame:
    """Label each row with its period.

    ``by_row`` (T1): the row's own year decides; rows in neither period get
    null and entities may cross (see :func:`split_findings`).
    ``by_group`` (T2): every row of an entity takes the period of the
    entity's first year, so the two sides are disjoint by construction.
    The per-entity minimum is a partial aggregate + join (skew-safe: a hot
    entity is pre-aggregated map-side, AQE splits a skewed join partition).
    """
    year = num(df, year_col)
    if policy == "by_row":
        return df.withColumn(out, _split_of(year, spec))
    if policy != "by_group":
        raise ValueError(f"unknown policy {policy}")
    first = df.groupBy(group_col).agg(F.min(year).alias("__first_year"))
    return (df.join(first, group_col, "left")
            .withColumn(out, _split_of(F.col("__first_year"), spec))
            .drop("__first_year"))


def split_findings(df: DataFrame, spec: SplitSpec, year_col: str = "index_year",
                   group_col: str = "study_patient_id", split_col: str = "split") -> DataFrame:
    """T1 checks: rows outside both periods, crossing entities, counts."""
    labelled = df if split_col in df.columns else split_temporal(df, spec, year_col)
    row = labelled.agg(
        F.count(F.when(F.col(split_col).isNull(), 1)).alias("outside"),
        F.count(F.when(F.col(split_col) == DEVELOPMENT, 1)).alias("development"),
        F.count(F.when(F.col(split_col) == TEMPORAL, 1)).alias("temporal"))
    checks = [_finding("outside_periods", year_col, F.col("outside"))]
    if spec.enforce_counts:
        for k, v in (("development", spec.expected_development_n),
                     ("temporal", spec.expected_temporal_n)):
            if v is not None:
                diff = F.col(k) - F.lit(v)
                checks.append(_finding("split_counts", k, diff, diff != 0))
    return union_findings(_long(row, checks), check_group_overlap(df, group_col, year_col, spec))
