"""Survival queries: censored C-index (R13) and the landmark cohort
summary (M12) on the registry stand-in, with DuckDB oracles (the C-index
oracle is an independent brute-force inequality self-join on distinct
points, fine at the oracle's scale)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels, split, survival
from . import fixtures as fx
from .catalog import SURV_TIME_SQL, _split_case
from .metric_queries import round_doubles
from .registry import STANDIN_SPLIT, d6, register

RISK_SQL = "(age_years + 10 * pcoa_incorporated_neck) / 100.0"


def survival_predictions(spark, sf_dir):
    """Eligible episodes with their survival fields and a formula risk."""
    reg = split.split_temporal(labels.survival_fields(fx.registry(spark, sf_dir)), STANDIN_SPLIT)
    return (reg.filter(F.col("pcoma_o_time_days").isNotNull())
            .select("study_case_id", "study_patient_id", "split",
                    F.col("pcoma_o_time_days").alias("time"), F.col("pcoma_o_event").alias("event"),
                    F.expr(RISK_SQL).cast("double").alias("risk")))


CINDEX_SQL = fx.with_ctes(
    "SELECT p.split, CAST(sum(p.ne + p.nc) AS BIGINT) AS n, CAST(sum(p.ne) AS BIGINT) AS events, "
    "CAST(max(dd.comparable) AS DECIMAL(38,0)) AS comparable, CAST(max(cc.conc) AS DECIMAL(38,0)) AS concordant, "
    "CAST(max(cc.ties) AS DECIMAL(38,0)) AS tied_risk, "
    + d6("max(cc.conc + 0.5 * cc.ties) / max(dd.comparable)") + " AS c_index "
    "FROM pts p JOIN cc USING (split) JOIN dd USING (split) GROUP BY p.split", "registry").replace(
    "\nSELECT p.split",
    ",\ns AS (SELECT " + _split_case("index_year") + " AS split, "
    f"({SURV_TIME_SQL}) AS t, cn3_complete_recovery_12m AS e, {RISK_SQL} AS r0 FROM registry),\n"
    "pts AS (SELECT split, CAST(t AS DOUBLE) AS t, round(CAST(r0 AS DOUBLE) / 1e-8) * 1e-8 AS r, "
    "CAST(sum(e) AS DOUBLE) AS ne, CAST(sum(1 - e) AS DOUBLE) AS nc FROM s WHERE t IS NOT NULL GROUP BY ALL),\n"
    "cc AS (SELECT a.split, "
    "sum(CASE WHEN b.t > a.t AND b.r < a.r THEN a.ne * (b.ne + b.nc) "
    "WHEN b.t = a.t AND b.r < a.r THEN a.ne * b.nc ELSE 0 END) AS conc, "
    "sum(CASE WHEN b.t > a.t AND b.r = a.r THEN a.ne * (b.ne + b.nc) "
    "WHEN b.t = a.t AND b.r = a.r THEN a.ne * b.nc ELSE 0 END) AS ties "
    "FROM pts a JOIN pts b ON a.split = b.split AND b.t >= a.t AND b.r <= a.r WHERE a.ne > 0 GROUP BY a.split),\n"
    "dd AS (SELECT a.split, sum(a.ne * (CASE WHEN b.t > a.t THEN b.ne + b.nc ELSE b.nc END)) AS comparable "
    "FROM pts a JOIN pts b ON a.split = b.split AND b.t >= a.t WHERE a.ne > 0 GROUP BY a.split)\n"
    "SELECT p.split", 1)


@register("concordance_index", CINDEX_SQL)
def q_concordance_index(spark, sf_dir):
    """Censored C-index per period (exact, no pair loop)."""
    s = survival_predictions(spark, sf_dir)
    return round_doubles(survival.concordance_index(s, ["split"], "time", "event", "risk"))


@register("landmark_summary", fx.with_ctes(
    "SELECT " + _split_case("index_year") + " AS split, count(*) AS n, "
    "CAST(sum(1 - cn3_complete_recovery_12m) AS BIGINT) AS events FROM registry "
    "WHERE preop_cn3_palsy = 1 GROUP BY 1", "registry"))
def q_landmark_summary(spark, sf_dir):
    """Eligible rows and 12-month non-recovery events per period."""
    reg = split.split_temporal(labels.survival_fields(fx.registry(spark, sf_dir)), STANDIN_SPLIT)
    return survival.landmark_summary(reg, ["split"], "derived_cn3_nonrecovery_12m")
