"""Recalibration (M13) and split-conformal prediction sets.

Nothing is fitted on the later period: the calibrator and the conformal
quantile come from development out-of-fold rows and are applied unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import logit
from ..specs import CONFORMAL_ALPHA
from .kernels import materialize, value_at_ranks
from .metrics import attach


# ---------------------------------------------------------------------------
# Conformal
# ---------------------------------------------------------------------------

def nonconformity(df: DataFrame, label: str = "observed", prob: str = "probability",
                  out: str = "nonconformity") -> DataFrame:
    """1 - probability of the true class."""
    p = F.col(prob).cast("double")
    true_p = F.when(F.col(label) == 1, p).otherwise(F.lit(1.0) - p)
    return df.withColumn(out, F.lit(1.0) - true_p)


def conformal_quantile(scores: DataFrame, by: Sequence[str] = (), score: str = "nonconformity",
                       alpha: float = CONFORMAL_ALPHA) -> DataFrame:
    """level = min(1, ceil((n+1)(1-alpha))/n); the order statistic at
    0-based index ceil(level (n-1)) (numpy ``method='higher'``), found on
    the distinct-score histogram (no global sort).  Returns (by..., n, qhat)."""
    by = list(by)
    hist = materialize(scores.groupBy(*by, F.col(score).cast("double").alias("__s"))
                       .agg(F.count(F.lit(1)).alias("__c")))
    n = hist.groupBy(*by).agg(F.sum("__c").alias("n"))
    level = F.least(F.lit(1.0), F.ceil((F.col("n") + 1) * F.lit(1.0 - alpha)) / F.col("n"))
    targets = n.select(*by, "n", F.ceil(level * (F.col("n") - 1)).alias("target_rank"))
    q = value_at_ranks(hist, by, "__s", "__c", targets)
    return q.select(*by, "n", F.col("value").alias("qhat"))


def prediction_sets(df: DataFrame, qhat: DataFrame | float, prob: str = "probability",
                    by: Sequence[str] = ()) -> DataFrame:
    """Class c is in the set if 1 - p_c <= qhat; an empty set takes the
    more probable class (tie -> class 0)."""
    if isinstance(qhat, (int, float)):
        rows = df.withColumn("__q", F.lit(float(qhat)))
    else:
        q = qhat.select(*by, F.col("qhat").alias("__q"))
        if not by:
            # one row whatever came in: an aggregate, so the planner knows the side's size
            q = q.agg(F.max("__q").alias("__q"))
        rows = attach(df, q, by)
    p1 = F.col(prob).cast("double")
    p0 = F.lit(1.0) - p1
    inc0 = (F.lit(1.0) - p0) <= F.col("__q")
    inc1 = (F.lit(1.0) - p1) <= F.col("__q")
    empty = ~(inc0 | inc1)
    inc0f = inc0 | (empty & (p0 >= p1))
    inc1f = inc1 | (empty & (p1 > p0))
    return (rows.withColumn("include_class_0", inc0f.cast("int"))
            .withColumn("include_class_1", inc1f.cast("int"))
            .withColumn("prediction_set_size", (inc0f.cast("int") + inc1f.cast("int")))
            .drop("__q"))


def coverage_summary(sets: DataFrame, by: Sequence[str] = (), label: str = "observed",
                     alpha: float = CONFORMAL_ALPHA) -> DataFrame:
    """U4: n, coverage, mean set size, nominal coverage."""
    covered = F.when(F.col(label) == 0, F.col("include_class_0")).otherwise(F.col("include_class_1"))
    return sets.groupBy(*by).agg(
        F.count(F.lit(1)).alias("temporal_n"),
        F.avg(covered.cast("double")).alias("temporal_coverage"),
        F.avg(F.col("prediction_set_size").cast("double")).alias("average_prediction_set_size"),
    ).withColumn("nominal_coverage", F.lit(1.0 - alpha))


# ---------------------------------------------------------------------------
# Logistic recalibration
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Recalibrator:
    intercept: float
    slope: float
    iterations: int

    def expr(self, prob: str) -> Column:
        z = F.lit(self.intercept) + F.lit(self.slope) * logit(prob)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def apply(self, df: DataFrame, prob: str = "probability",
              out: str = "calibrated_probability") -> DataFrame:
        return df.withColumn(out, self.expr(prob))


def fit_recalibrator(df: DataFrame, label: str = "observed", prob: str = "probability",
                     C: float = 1e6, max_iter: int = 100, tol: float = 1e-10) -> Recalibrator:
    """y ~ a + b * logit(p) by Newton's method; each iteration is one
    distributed aggregate of the gradient and the 2x2 Hessian (the driver
    only sees five numbers).  L2 penalty 1/(2C) on the slope, none on the
    intercept (the study's C = 1e6 makes it negligible)."""
    x = logit(prob)
    base = df.select(x.alias("x"), F.col(label).cast("double").alias("y")).cache()
    a, b = 0.0, 0.0
    it = 0
    try:
        for it in range(1, max_iter + 1):
            mu = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) + F.lit(b) * F.col("x"))))
            w = mu * (F.lit(1.0) - mu)
            r = base.agg(F.sum(F.col("y") - mu).alias("g0"), F.sum((F.col("y") - mu) * F.col("x")).alias("g1"),
                         F.sum(w).alias("h00"), F.sum(w * F.col("x")).alias("h01"),
                         F.sum(w * F.col("x") * F.col("x")).alias("h11")).first()
            g0, g1 = r.g0, r.g1 - b / C
            h00, h01, h11 = r.h00, r.h01, r.h11 + 1.0 / C
            det = h00 * h11 - h01 * h01
            if det <= 0 or math.isnan(det):
                break
            da = (h11 * g0 - h01 * g1) / det
            db = (h00 * g1 - h01 * g0) / det
            a, b = a + da, b + db
            if abs(da) < tol and abs(db) < tol:
                break
    finally:
        base.unpersist()
    return Recalibrator(a, b, it)
