"""Classification, ordinal and decision metrics.

Every metric takes ``by`` grouping columns (model, split, fold, replicate,
...), so one job evaluates many models or resamples, and an optional
``weight`` column (cluster-bootstrap weights).  Rank metrics run on the
distinct-score histogram (a partial aggregate: a hot score value is one
row) plus the bucketed prefix-sum kernel; no O(n^2) pair loop and no
single-task global sort.  Undefined ratios are null (the reference's NaN).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import DECISION_CURVE_THRESHOLDS
from .kernels import exact_quantiles, materialize, prefix_sums


def attach(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join a per-group result onto rows of the same groups; with no
    grouping both sides are keyed by one constant (one-row side)."""
    if by:
        return a.join(b, list(by), "inner")
    return a.withColumn("__g", F.lit(0)).join(b.withColumn("__g", F.lit(0)), "__g").drop("__g")


def _w(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1).cast("bigint")


def checked_score(score: str, label: str | None = None) -> Column:
    """The score as a double; raises at run time on a null or NaN score or,
    where a label is given, on one that is not 0 or 1."""
    s = F.col(score).cast("double")
    ok = s.isNotNull() & ~F.isnan(s)
    if label is not None:
        ok = ok & F.coalesce(F.col(label).cast("double").isin(0.0, 1.0), F.lit(False))
    return F.when(ok, s).otherwise(F.raise_error(F.lit(f"{score}: a null or NaN score, or a label outside its domain")).cast("double"))


def score_histogram(df: DataFrame, by: Sequence[str], label: str, score: str,
                    weight: str | None = None) -> DataFrame:
    """(by..., score) -> pos, neg (weighted counts).  A null or NaN score, or a
    label other than 0 and 1, has no rank: the job fails instead of leaving
    the row out of some counts and not of others."""
    w, y = _w(weight), F.col(label)
    return (df.groupBy(*by, checked_score(score, label).alias("score"))
            .agg(F.sum(F.when(y == 1, w).otherwise(0)).alias("pos"),
                 F.sum(F.when(y == 0, w).otherwise(0)).alias("neg")))


def class_totals(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    return hist.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))


def auc_ap(df: DataFrame, by: Sequence[str], label: str, score: str,
           weight: str | None = None) -> DataFrame:
    """R6 ROC AUC (ties count 1/2) and R7 average precision (step-wise,
    no interpolation) per group.  Null when a class is absent."""
    by = list(by)
    hist = materialize(score_histogram(df, by, label, score, weight))
    cum = prefix_sums(hist, by, "score", ["pos", "neg"], prefix="lt_", materialized=True)
    tot = class_totals(hist, by)
    j = attach(cum, tot, by)
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    auc_term = F.col("pos") * (F.col("lt_neg") + 0.5 * F.col("neg"))
    ap_term = (F.col("pos") / P) * ((P - F.col("lt_pos")) / (P + N - F.col("lt_pos") - F.col("lt_neg")))
    res = j.groupBy(*by, "P", "N").agg(F.sum(auc_term).alias("__auc"), F.sum(ap_term).alias("__ap"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return res.select(*by, F.when(both, F.col("__auc") / (P * N)).alias("roc_auc"),
                      F.when(F.col("P") > 0, F.col("__ap")).alias("pr_auc"))


def youden_threshold(df: DataFrame, by: Sequence[str], label: str, score: str,
                     weight: str | None = None) -> DataFrame:
    """Among thresholds {0} U distinct scores U {1}, the lowest one that
    maximises sensitivity + specificity - 1 (predicted = score >= t; an
    empty class contributes 0 here)."""
    by = list(by)
    hist = score_histogram(df, by, label, score, weight)
    groups = hist.select(*by).distinct()
    ends = groups.select(*by, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("score"),
                         F.lit(0).cast(hist.schema["pos"].dataType).alias("pos"),
                         F.lit(0).cast(hist.schema["neg"].dataType).alias("neg"))
    cand = materialize(hist.unionByName(ends).groupBy(*by, "score").agg(F.sum("pos").alias("pos"),
                                                                         F.sum("neg").alias("neg")))
    cum = prefix_sums(cand, by, "score", ["pos", "neg"], prefix="lt_", materialized=True)
    tot = class_totals(cand, by)
    j = attach(cum, tot, by)
    sens = F.when(F.col("P") > 0, (F.col("P") - F.col("lt_pos")) / F.col("P")).otherwise(0.0)
    spec = F.when(F.col("N") > 0, F.col("lt_neg") / F.col("N")).otherwise(0.0)
    j = j.withColumn("__j", sens + spec - F.lit(1.0))
    # max J, then the smallest threshold: max_by over (J, -threshold)
    return j.groupBy(*by).agg(F.max_by("score", F.struct(F.col("__j"), -F.col("score")))
                              .alias("threshold"))


def _confusion_aggs(label: str, score: str, thr: Column, weight: str | None) -> list[Column]:
    w, y = _w(weight), F.col(label)
    pred = F.col(score) >= thr
    return [F.sum(F.when(pred & (y == 1), w).otherwise(0)).alias("tp"),
            F.sum(F.when(~pred & (y == 0), w).otherwise(0)).alias("tn"),
            F.sum(F.when(pred & (y == 0), w).otherwise(0)).alias("fp"),
            F.sum(F.when(~pred & (y == 1), w).otherwise(0)).alias("fn")]


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a.cast("double") / b.cast("double"))


def confusion_metrics(tp: Column, tn: Column, fp: Column, fn: Column) -> list[Column]:
    """R2-R5 from confusion counts."""
    tp, tn, fp, fn = (c.cast("double") for c in (tp, tn, fp, fn))
    sens, spec = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    ba = (F.when((tp + fn > 0) & (tn + fp > 0), (sens + spec) / 2)
          .when(tp + fn > 0, sens).otherwise(spec))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    mcc = F.when(den > 0, (tp * tn - fp * fn) / den).otherwise(0.0)
    return [sens.alias("sensitivity"), spec.alias("specificity"), _ratio(tp, tp + fp).alias("ppv"),
            _ratio(tn, tn + fn).alias("npv"), ba.alias("balanced_accuracy"), f1.alias("f1"),
            mcc.alias("mcc")]


def binary_metric_bundle(df: DataFrame, by: Sequence[str], label: str, score: str,
                         thresholds: DataFrame | float | None = None,
                         weight: str | None = None) -> DataFrame:
    """N, events, threshold, AUC, AP, Brier, R1-R5.

    ``thresholds``: a constant, a DataFrame ``(by..., threshold)`` (e.g. the
    development Youden threshold applied to a later period), or None for
    the Youden threshold of each group itself.
    """
    by = list(by)
    if thresholds is None:
        thresholds = youden_threshold(df, by, label, score, weight)
    if isinstance(thresholds, (int, float)):
        rows = df.withColumn("threshold", F.lit(float(thresholds)))
    else:
        keys = [c for c in thresholds.columns if c != "threshold"]
        # one threshold per group: a small side (AQE broadcasts it at runtime)
        rows = attach(df, thresholds, keys)
    w, y = _w(weight), F.col(label)
    p = F.col(score).cast("double")
    row_level = rows.groupBy(*by).agg(
        F.sum(w).alias("n"), F.sum(F.when(y == 1, w).otherwise(0)).alias("events"),
        F.first("threshold").alias("threshold"),
        (F.sum(w * (p - y) * (p - y)) / F.sum(w)).alias("brier"),
        *_confusion_aggs(label, score, F.col("threshold"), weight))
    ranks = auc_ap(df, by, label, score, weight)
    out = attach(row_level, ranks, by)
    return out.select(*by, "n", "events", "threshold", "roc_auc", "pr_auc", "brier",
                      *confusion_metrics(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn")),
                      "tp", "tn", "fp", "fn")


def roc_points(df: DataFrame, by: Sequence[str], label: str, score: str,
               weight: str | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (predicted = score >= t),
    and the origin, at a null threshold (nothing is predicted)."""
    by = list(by)
    hist = materialize(score_histogram(df, by, label, score, weight))
    cum = prefix_sums(hist, by, "score", ["pos", "neg"], prefix="lt_", materialized=True)
    tot = class_totals(hist, by)
    j = attach(cum, tot, by)
    origin = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return j.select(*by, F.col("score").alias("threshold"),
                    _ratio(F.col("N") - F.col("lt_neg"), F.col("N")).alias("fpr"),
                    _ratio(F.col("P") - F.col("lt_pos"), F.col("P")).alias("tpr")).unionByName(origin)


def calibration_curve(df: DataFrame, by: Sequence[str], label: str, score: str,
                      n_bins: int = 10) -> DataFrame:
    """Quantile bins (linear-interpolated edges); bin = number of inner
    edges strictly below p; empty bins dropped; mean p and mean y per bin."""
    by = list(by)
    probs = [i / n_bins for i in range(1, n_bins)]
    edges = (exact_quantiles(df, by, score, probs)
             .groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("q", "quantile"))).alias("__e"))
             .select(*by, F.transform("__e", lambda s: s["quantile"]).alias("__edges")))
    rows = attach(df, edges, by)
    p = F.col(score).cast("double")
    binned = rows.withColumn("bin", F.size(F.filter("__edges", lambda e: e < p)))
    return binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"),
                                          F.avg(p).alias("mean_predicted"),
                                          F.avg(F.col(label).cast("double")).alias("fraction_positive"))


def decision_curve(df: DataFrame, by: Sequence[str], label: str, score: str,
                   thresholds: Sequence[float] = DECISION_CURVE_THRESHOLDS) -> DataFrame:
    """Net benefit TP/n - FP/n * t/(1-t) of the model, of treating all,
    and of treating none, at each threshold; one aggregate over the score
    histogram with two conditional sums per threshold (no fan-out)."""
    by = list(by)
    hist = score_histogram(df, by, label, score)
    aggs = [F.sum("pos").alias("P"), F.sum("neg").alias("N")]
    for i, t in enumerate(thresholds):
        aggs += [F.sum(F.when(F.col("score") >= t, F.col("pos")).otherwise(0)).alias(f"tp{i}"),
                 F.sum(F.when(F.col("score") >= t, F.col("neg")).otherwise(0)).alias(f"fp{i}")]
    wide = hist.groupBy(*by).agg(*aggs)
    long = wide.select(*by, "P", "N", F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, t in enumerate(thresholds)])))
    n = (F.col("P") + F.col("N")).cast("double")
    odds = F.col("threshold") / (F.lit(1.0) - F.col("threshold"))
    return long.select(*by, "threshold",
                       (F.col("tp") / n - F.col("fp") / n * odds).alias("net_benefit"),
                       (F.col("P") / n - F.col("N") / n * odds).alias("net_benefit_all"),
                       F.lit(0.0).alias("net_benefit_none"))


def brier(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """R8."""
    p, y = F.col(score).cast("double"), F.col(label).cast("double")
    return df.groupBy(*by).agg(F.avg((p - y) * (p - y)).alias("brier"))


# ---------------------------------------------------------------------------
# Ordinal metrics
# ---------------------------------------------------------------------------

def expected_score(probs: Sequence[str]) -> Column:
    out = F.lit(0.0)
    for k, c in enumerate(probs):
        out = out + F.lit(float(k)) * F.col(c)
    return out


def argmax_class(probs: Sequence[str]) -> Column:
    """Argmax, ties -> lowest class (first position of the maximum)."""
    arr = F.array(*[F.col(c) for c in probs])
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def ranked_probability_score_row(label: str, probs: Sequence[str]) -> Column:
    """R15 per row: sum over k < K-1 of (CDF_pred_k - 1[y <= k])^2 / (K-1)."""
    K = len(probs)
    cdf, total = F.lit(0.0), F.lit(0.0)
    for k in range(K - 1):
        cdf = cdf + F.col(probs[k])
        obs = F.when(F.col(label) <= k, 1.0).otherwise(0.0)
        total = total + (cdf - obs) * (cdf - obs)
    return total / F.lit(float(K - 1))


def ordinal_concordance(df: DataFrame, by: Sequence[str], label: str, score: str,
                        n_classes: int) -> DataFrame:
    """Over pairs with different y, concordant + 1/2 score ties, over
    comparable pairs; Somers' Dxy = 2c - 1.  Per distinct score a class
    histogram; prefix sums of each class count give, for every row, the
    lower-score rows of each class (O(n log n), no pair loop)."""
    by = list(by)
    y = F.col(label)
    hist = df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        *[F.sum(F.when(y == k, 1).otherwise(0)).alias(f"n{k}") for k in range(n_classes)])
    cols = [f"n{k}" for k in range(n_classes)]
    cum = prefix_sums(hist, by, "score", cols, prefix="lt_")  # materializes the histogram
    # doubles before multiplying: a product of two counts need not fit a bigint
    conc, ties = F.lit(0.0), F.lit(0.0)
    for b in range(n_classes):
        lower = sum((F.col(f"lt_n{a}").cast("double") for a in range(b)), F.lit(0.0))
        conc = conc + F.col(f"n{b}").cast("double") * lower
        for a in range(b):
            ties = ties + F.col(f"n{a}").cast("double") * F.col(f"n{b}").cast("double")
    per = cum.groupBy(*by).agg(F.sum(conc).alias("__c"),
                               F.sum(ties).alias("__t"),
                               *[F.sum(c).alias(f"N{k}") for k, c in enumerate(cols)])
    comparable = F.lit(0.0)
    for b in range(n_classes):
        for a in range(b):
            comparable = comparable + F.col(f"N{a}").cast("double") * F.col(f"N{b}")
    c = F.when(comparable > 0, (F.col("__c") + 0.5 * F.col("__t")) / comparable)
    return per.select(*by, c.alias("ordinal_concordance"), (2 * c - 1).alias("somers_dxy"))


def quadratic_weighted_kappa(df: DataFrame, by: Sequence[str], label: str, predicted: str) -> DataFrame:
    """Weights (i-j)^2 on positions in the sorted union of observed and
    predicted labels.  One confusion aggregate (K x K rows per group); the
    label positions come from the group's sorted distinct labels (a window
    over that small table), and sum w*E expands to marginal moments, so
    there is no join and no pair table."""
    from pyspark.sql import Window
    by = list(by)
    conf = df.groupBy(*by, F.col(label).alias("__y"), F.col(predicted).alias("__p")).agg(
        F.count(F.lit(1)).alias("__o"))
    part = by if by else [F.lit(0)]
    levels = F.array_sort(F.array_distinct(F.flatten(
        F.collect_set(F.array(F.col("__y"), F.col("__p"))).over(Window.partitionBy(*part)))))
    c = conf.withColumn("__lv", levels)
    py = (F.array_position("__lv", F.col("__y")) - 1).cast("double")
    pp = (F.array_position("__lv", F.col("__p")) - 1).cast("double")
    o = F.col("__o").cast("double")
    agg = c.groupBy(*by).agg(
        F.sum(o).alias("n"), F.sum(o * (py - pp) * (py - pp)).alias("wo"),
        F.sum(o * py * py).alias("r2"), F.sum(o * pp * pp).alias("c2"),
        F.sum(o * py).alias("r1"), F.sum(o * pp).alias("c1"))
    we = (F.col("n") * F.col("r2") + F.col("n") * F.col("c2") - 2 * F.col("r1") * F.col("c1")) / F.col("n")
    return agg.select(*by, F.when(we != 0, 1 - F.col("wo") / we).alias("quadratic_weighted_kappa"))


def ordinal_metric_bundle(df: DataFrame, by: Sequence[str], label: str, probs: Sequence[str]) -> DataFrame:
    """N, concordance, Somers' Dxy, QWK, RPS, mean absolute ordinal error."""
    if len(probs) != 7:
        raise ValueError("ordinal probabilities must have seven columns (classes 0-6)")
    by = list(by)
    scored = (df.select(*by, label, *probs)
              .withColumns({"__es": expected_score(probs), "__am": argmax_class(probs)}))
    row = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(ranked_probability_score_row(label, probs)).alias("ranked_probability_score"),
        F.avg(F.abs(F.col(label) - F.col("__am")).cast("double")).alias("average_absolute_ordinal_error"))
    conc = ordinal_concordance(scored, by, label, "__es", len(probs))
    qwk = quadratic_weighted_kappa(scored, by, label, "__am")
    return attach(attach(row, conc, by), qwk, by)
