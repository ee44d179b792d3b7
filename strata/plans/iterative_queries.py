"""Queries for the custom iterative fits (rows-only: no SQL equivalent)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, iterative, metrics, survival
from ..operators.encode import FoldSafeEncoder
from ..specs import MODEL_SPECS
from .metric_queries import round_doubles
from .model_queries import _periods
from .registry import register


@register("cox_ph")
def q_cox_ph(spark, sf_dir):
    """Cox proportional hazards (Efron ties) on the development
    period's eligible episodes, numeric covariates only; coefficients, SEs,
    whether the fit converged, and the C-index of the linear predictor on both
    periods."""
    dev, later = _periods(spark, sf_dir)
    spec = MODEL_SPECS["pcoma_o_aft"]
    num = [f for f in spec.features if f not in spec.categorical]
    def rows(df):
        r = clean.eligible_rows(df, spec.eligibility_column, spec.time_column)
        return r.filter(F.col(spec.event_column).isNotNull())
    enc = FoldSafeEncoder(num, scale=True).fit(rows(dev))
    p = len(enc.feature_names)
    keep = [F.col(spec.time_column).alias("time"), F.col(spec.event_column).alias("event")]
    d_dev = iterative.design(enc.transform_vector(rows(dev).select("*", *keep), keep=["time", "event"]),
                             "features", p, ["time", "event"])
    fit = iterative.fit_cox(d_dev, "time", "event", p)
    d_tmp = iterative.design(enc.transform_vector(rows(later).select("*", *keep), keep=["time", "event"]),
                             "features", p, ["time", "event"])
    both = (d_dev.withColumn("split", F.lit("development")).unionByName(d_tmp.withColumn("split", F.lit("temporal")))
            .withColumn("risk", fit.linear_predictor(p)))
    c = survival.concordance_index(both, ["split"], "time", "event", "risk").select("split", "c_index")
    coefs = spark.createDataFrame(
        [(n, float(b), float(s), float(b / s), float(fit.loglik), int(fit.iterations), bool(fit.converged))
         for n, b, s in zip(enc.feature_names, fit.coef, fit.se)],
        "feature string, coef double, se double, z double, loglik double, iterations int, converged boolean")
    dev_c = c.filter(F.col("split") == "development").select(F.col("c_index").alias("c_index_development"))
    tmp_c = c.filter(F.col("split") == "temporal").select(F.col("c_index").alias("c_index_temporal"))
    return round_doubles(metrics.attach(metrics.attach(coefs, dev_c, []), tmp_c, []))


@register("ordinal_logit")
def q_ordinal_logit(spark, sf_dir):
    """M6-M8 + R17: proportional-odds logit fitted on the development
    period (scaled features, first category dropped, constants dropped),
    seven-slot probabilities (M7), locked scoring of the later period (M8),
    ordinal metric bundle per period, and whether the fit converged."""
    dev, later = _periods(spark, sf_dir)
    spec = MODEL_SPECS["pcoma_e_ordinal"]
    def rows(df):
        r = clean.eligible_rows(df, spec.eligibility_column, spec.target)
        return r.filter(F.col(spec.target).between(0, 6))
    num = [f for f in spec.features if f not in spec.categorical]
    enc = FoldSafeEncoder(num, spec.categorical, scale=True, drop_first=True, drop_constant=True).fit(rows(dev))
    p = len(enc.feature_names)
    y = F.col(spec.target).cast("int").alias("y")
    d_dev = iterative.design(enc.transform_vector(rows(dev).select("*", y), keep=["y"]), "features", p, ["y"])
    fit = iterative.fit_ordered_logit(d_dev, "y", p)
    out = None
    for name, frame in (("development", d_dev), ("temporal", iterative.design(
            enc.transform_vector(rows(later).select("*", y), keep=["y"]), "features", p, ["y"]))):
        probs = frame.select("y", *fit.probability_columns(p))
        probs = iterative.expand_probabilities(probs, fit.classes).withColumn("split", F.lit(name))
        out = probs if out is None else out.unionByName(probs)
    bundle = metrics.ordinal_metric_bundle(out, ["split"], "y", [f"prob_mrs_{k}" for k in range(7)])
    return round_doubles(bundle).withColumn("converged", F.lit(bool(fit.converged)))
