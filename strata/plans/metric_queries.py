"""Metric queries (R*) on the prediction stand-ins, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.exprs import r6
from ..operators import metrics
from ..specs import DECISION_CURVE_THRESHOLDS
from . import fixtures as fx
from .registry import d6, register


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def _preds(spark, sf_dir):
    return fx.predictions(spark, sf_dir)


# --- shared DuckDB building blocks ------------------------------------------

def hist_sql(by: str, source: str = "preds", label: str = "observed", score: str = "probability") -> str:
    return (f"SELECT {by}, CAST({score} AS DOUBLE) AS score, "
            f"CAST(sum(CASE WHEN {label} = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos, "
            f"CAST(sum(CASE WHEN {label} = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS neg "
            f"FROM {source} GROUP BY {by}, CAST({score} AS DOUBLE)")


def cum_sql(by: str, source: str, cols=("pos", "neg")) -> str:
    w = f"(PARTITION BY {by} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"SELECT *, " + ", ".join(f"coalesce(sum({c}) OVER {w}, 0) AS lt_{c}" for c in cols) + f" FROM {source}"


PREDS_SQL_CTE = f"preds AS ({fx.PREDICTIONS_SQL})"

RANK_CTES = (
    f"hist AS ({hist_sql('split')}),\n"
    f"cum AS ({cum_sql('split', 'hist')}),\n"
    "tot AS (SELECT split, sum(pos) AS P, sum(neg) AS N FROM hist GROUP BY split),\n"
    "rk AS (SELECT split, CASE WHEN P > 0 AND N > 0 THEN sum(pos * (lt_neg + 0.5 * neg)) / (P * N) END AS roc_auc, "
    "CASE WHEN P > 0 THEN sum((pos / P) * ((P - lt_pos) / (P + N - lt_pos - lt_neg))) END AS pr_auc "
    "FROM cum JOIN tot USING (split) GROUP BY split, P, N)")


def youden_sql(by: str | None, where: str = "TRUE") -> str:
    """CTEs ending in ``yd(by..., threshold)``."""
    b = by or "'_all' AS g"
    bk = by or "g"
    return (
        f"yh AS (SELECT {b}, CAST(probability AS DOUBLE) AS score, "
        "CAST(sum(CASE WHEN observed = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos, "
        "CAST(sum(CASE WHEN observed = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS neg "
        f"FROM preds WHERE {where} GROUP BY ALL),\n"
        f"yc AS (SELECT {bk}, score, sum(pos) AS pos, sum(neg) AS neg FROM ("
        f"SELECT {bk}, score, pos, neg FROM yh UNION ALL "
        f"SELECT DISTINCT {bk}, CAST(0.0 AS DOUBLE), 0.0, 0.0 FROM yh UNION ALL "
        f"SELECT DISTINCT {bk}, CAST(1.0 AS DOUBLE), 0.0, 0.0 FROM yh) GROUP BY {bk}, score),\n"
        f"ycum AS ({cum_sql(bk, 'yc')}),\n"
        f"ytot AS (SELECT {bk}, sum(pos) AS P, sum(neg) AS N FROM yc GROUP BY {bk}),\n"
        f"yj AS (SELECT {bk}, score, (CASE WHEN P > 0 THEN (P - lt_pos) / P ELSE 0.0 END) "
        "+ (CASE WHEN N > 0 THEN lt_neg / N ELSE 0.0 END) - 1.0 AS j "
        f"FROM ycum JOIN ytot USING ({bk})),\n"
        f"yd AS (SELECT {bk}, score AS threshold FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {bk} ORDER BY j DESC, score ASC) AS rn FROM yj) WHERE rn = 1)")


def confusion_sql(tp="tp", tn="tn", fp="fp", fn="fn") -> str:
    tp, tn, fp, fn = (f"CAST({c} AS DOUBLE)" for c in (tp, tn, fp, fn))
    sens = f"CASE WHEN {tp} + {fn} <> 0 THEN {tp} / ({tp} + {fn}) END"
    spec = f"CASE WHEN {tn} + {fp} <> 0 THEN {tn} / ({tn} + {fp}) END"
    return ", ".join([
        d6(sens) + " AS sensitivity", d6(spec) + " AS specificity",
        d6(f"CASE WHEN {tp} + {fp} <> 0 THEN {tp} / ({tp} + {fp}) END") + " AS ppv",
        d6(f"CASE WHEN {tn} + {fn} <> 0 THEN {tn} / ({tn} + {fn}) END") + " AS npv",
        d6(f"CASE WHEN {tp} + {fn} > 0 AND {tn} + {fp} > 0 THEN ({sens} + {spec}) / 2 "
           f"WHEN {tp} + {fn} > 0 THEN {sens} ELSE {spec} END") + " AS balanced_accuracy",
        d6(f"CASE WHEN 2 * {tp} + {fp} + {fn} > 0 THEN 2 * {tp} / (2 * {tp} + {fp} + {fn}) ELSE 0.0 END") + " AS f1",
        d6(f"CASE WHEN sqrt(({tp} + {fp}) * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn})) > 0 "
           f"THEN ({tp} * {tn} - {fp} * {fn}) / sqrt(({tp} + {fp}) * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn})) "
           "ELSE 0.0 END") + " AS mcc"])


# --- binary metrics -----------------------------------------------------------

BUNDLE_SQL = (
    f"WITH {PREDS_SQL_CTE},\n{RANK_CTES},\n{youden_sql(None, 'split = ' + repr('development'))},\n"
    "rows_ AS (SELECT split, count(*) AS n, CAST(sum(observed) AS BIGINT) AS events, "
    "(SELECT threshold FROM yd) AS threshold, "
    "sum((probability - observed) * (probability - observed)) / count(*) AS brier, "
    "CAST(count(*) FILTER (WHERE probability >= (SELECT threshold FROM yd) AND observed = 1) AS BIGINT) AS tp, "
    "CAST(count(*) FILTER (WHERE probability < (SELECT threshold FROM yd) AND observed = 0) AS BIGINT) AS tn, "
    "CAST(count(*) FILTER (WHERE probability >= (SELECT threshold FROM yd) AND observed = 0) AS BIGINT) AS fp, "
    "CAST(count(*) FILTER (WHERE probability < (SELECT threshold FROM yd) AND observed = 1) AS BIGINT) AS fn "
    "FROM preds GROUP BY split)\n"
    f"SELECT split, n, events, {d6('threshold')} AS threshold, {d6('roc_auc')} AS roc_auc, "
    f"{d6('pr_auc')} AS pr_auc, {d6('brier')} AS brier, {confusion_sql()}, tp, tn, fp, fn "
    "FROM rows_ JOIN rk USING (split)")


@register("binary_metrics", BUNDLE_SQL)
def q_binary_metrics(spark, sf_dir):
    """R18 (flagship): Youden threshold fitted on the development period,
    applied unchanged to both periods; exact AUC, AP, Brier, R1-R5."""
    p = _preds(spark, sf_dir)
    thr = metrics.youden_threshold(p.filter(F.col("split") == "development"), [], "observed", "probability")
    return round_doubles(metrics.binary_metric_bundle(p, ["split"], "observed", "probability", thr))


@register("auc_ap", f"WITH {PREDS_SQL_CTE},\n{RANK_CTES}\n"
                    f"SELECT split, {d6('roc_auc')} AS roc_auc, {d6('pr_auc')} AS pr_auc FROM rk")
def q_auc_ap(spark, sf_dir):
    """R6 + R7 per period (ties: 1/2; AP without interpolation)."""
    return round_doubles(metrics.auc_ap(_preds(spark, sf_dir), ["split"], "observed", "probability"))


@register("youden_threshold", f"WITH {PREDS_SQL_CTE},\n{youden_sql('split')}\n"
                              f"SELECT split, {d6('threshold')} AS threshold FROM yd")
def q_youden(spark, sf_dir):
    """R9 per period."""
    return round_doubles(metrics.youden_threshold(_preds(spark, sf_dir), ["split"], "observed", "probability"))


@register("roc_points", f"WITH {PREDS_SQL_CTE},\n{RANK_CTES}\n"
                        f"SELECT split, {d6('score')} AS threshold, {d6('(N - lt_neg) / N')} AS fpr, "
                        f"{d6('(P - lt_pos) / P')} AS tpr FROM cum JOIN tot USING (split) "
                        "UNION ALL SELECT split, CAST(NULL AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM tot")
def q_roc_points(spark, sf_dir):
    """R10."""
    return round_doubles(metrics.roc_points(_preds(spark, sf_dir), ["split"], "observed", "probability"))


_QS = "[" + ", ".join(str(i / 10) for i in range(1, 10)) + "]"


@register("calibration_curve", (
    f"WITH {PREDS_SQL_CTE},\n"
    f"edges AS (SELECT split, quantile_cont(probability, {_QS}) AS e FROM preds GROUP BY split),\n"
    "b AS (SELECT p.split, CAST(len(list_filter(e, lambda x: x < p.probability)) AS INTEGER) AS bin, "
    "p.probability, p.observed FROM preds p JOIN edges USING (split))\n"
    f"SELECT split, bin, count(*) AS n, {d6('avg(probability)')} AS mean_predicted, "
    f"{d6('avg(observed)')} AS fraction_positive FROM b GROUP BY split, bin"))
def q_calibration_curve(spark, sf_dir):
    """10 quantile bins with exact interpolated edges."""
    return round_doubles(metrics.calibration_curve(_preds(spark, sf_dir), ["split"], "observed", "probability"))


_TS = "[" + ", ".join(repr(t) for t in DECISION_CURVE_THRESHOLDS) + "]"


@register("decision_curve", (
    f"WITH {PREDS_SQL_CTE},\n"
    f"t AS (SELECT CAST(unnest({_TS}) AS DOUBLE) AS threshold),\n"
    "c AS (SELECT split, threshold, CAST(count(*) AS DOUBLE) AS n, "
    "CAST(count(*) FILTER (WHERE probability >= threshold AND observed = 1) AS DOUBLE) AS tp, "
    "CAST(count(*) FILTER (WHERE probability >= threshold AND observed = 0) AS DOUBLE) AS fp, "
    "CAST(sum(observed) AS DOUBLE) AS tot_pos, CAST(count(*) - sum(observed) AS DOUBLE) AS tot_neg "
    "FROM preds, t GROUP BY split, threshold)\n"
    f"SELECT split, {d6('threshold')} AS threshold, "
    f"{d6('tp / n - fp / n * (threshold / (CAST(1.0 AS DOUBLE) - threshold))')} AS net_benefit, "
    f"{d6('tot_pos / n - tot_neg / n * (threshold / (CAST(1.0 AS DOUBLE) - threshold))')} AS net_benefit_all, "
    "CAST(0.0 AS DOUBLE) AS net_benefit_none FROM c"))
def q_decision_curve(spark, sf_dir):
    """Net benefit at thresholds 0.10-0.30."""
    return round_doubles(metrics.decision_curve(_preds(spark, sf_dir), ["split"], "observed", "probability"))


# --- ordinal metrics (7 classes) ---------------------------------------------

K = 7
PROBS = [f"prob_mrs_{k}" for k in range(K)]


def _w(k: int) -> str:
    return (f"(1 + (l_partkey + {k} * l_suppkey) % 7 "
            f"+ CASE WHEN l_linenumber - 1 = {k} THEN 4 ELSE 0 END)")


_W = "(" + " + ".join(_w(k) for k in range(K)) + ")"
ORDINAL_EXPRS = (
    "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' "
    "|| CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS study_case_id",
    "l_returnflag AS grp",
    "CAST(l_linenumber - 1 AS INT) AS observed_mrs",
    *[f"CAST({_w(k)} AS DOUBLE) / CAST({_W} AS DOUBLE) AS prob_mrs_{k}" for k in range(K)],
)
ORDINAL_SQL = "SELECT " + ", ".join(ORDINAL_EXPRS) + " FROM lineitem"


def ordinal_predictions(spark, sf_dir):
    # staged: class weights, their total, then the ratios (each expensive
    # expression is computed once per row instead of being inlined 7 times)
    li = fx.table(spark, sf_dir, "lineitem")
    w = li.selectExpr(*ORDINAL_EXPRS[:3], *[f"{_w(k)} AS __w{k}" for k in range(K)])
    w = w.withColumn("__W", sum((F.col(f"__w{k}") for k in range(1, K)), F.col("__w0")))
    return w.select(*[F.col(c) for c in ("study_case_id", "grp", "observed_mrs")],
                    *[(F.col(f"__w{k}").cast("double") / F.col("__W").cast("double")).alias(f"prob_mrs_{k}")
                      for k in range(K)])


def _ordinal_sql() -> str:
    es = "(CAST(0.0 AS DOUBLE)" + "".join(f" + CAST({k}.0 AS DOUBLE) * prob_mrs_{k}" for k in range(K)) + ")"
    best = "greatest(" + ", ".join(PROBS) + ")"
    am = "CASE " + " ".join(f"WHEN prob_mrs_{k} = {best} THEN {k}" for k in range(K)) + " END"
    cdf = []
    acc = "CAST(0.0 AS DOUBLE)"
    terms = []
    for k in range(K - 1):
        acc = f"({acc} + prob_mrs_{k})"
        terms.append(f"({acc} - CASE WHEN observed_mrs <= {k} THEN 1.0 ELSE 0.0 END) * "
                     f"({acc} - CASE WHEN observed_mrs <= {k} THEN 1.0 ELSE 0.0 END)")
    rps = "(CAST(0.0 AS DOUBLE) + " + " + ".join(terms) + f") / CAST({K - 1}.0 AS DOUBLE)"
    del cdf
    lt = ", ".join(f"coalesce(sum(n{k}) OVER w, 0) AS lt_n{k}" for k in range(K))
    conc = " + ".join(f"n{b} * (0" + "".join(f" + lt_n{a}" for a in range(b)) + ")" for b in range(K))
    ties = " + ".join(f"n{a} * n{b}" for b in range(K) for a in range(b)) or "0"
    comp = " + ".join(f"N{a} * N{b}" for b in range(K) for a in range(b))
    return (
        f"WITH o AS ({ORDINAL_SQL}),\n"
        f"s AS (SELECT *, {es} AS es, {am} AS am, {rps} AS rps FROM o),\n"
        "h AS (SELECT grp, es AS score, " + ", ".join(
            f"CAST(sum(CASE WHEN observed_mrs = {k} THEN 1 ELSE 0 END) AS DOUBLE) AS n{k}" for k in range(K))
        + " FROM s GROUP BY grp, es),\n"
        f"hc AS (SELECT *, {lt} FROM h WINDOW w AS (PARTITION BY grp ORDER BY score "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),\n"
        f"cc AS (SELECT grp, sum({conc}) AS c, sum({ties}) AS t, "
        + ", ".join(f"sum(n{k}) AS N{k}" for k in range(K)) + " FROM hc GROUP BY grp),\n"
        f"conc AS (SELECT grp, (c + 0.5 * t) / ({comp}) AS cidx FROM cc),\n"
        "conf AS (SELECT grp, observed_mrs AS y, am AS p, CAST(count(*) AS DOUBLE) AS o FROM s GROUP BY ALL),\n"
        "lab AS (SELECT DISTINCT grp, v FROM (SELECT grp, y AS v FROM conf UNION ALL SELECT grp, p AS v FROM conf)),\n"
        "pos AS (SELECT grp, v, CAST(dense_rank() OVER (PARTITION BY grp ORDER BY v) - 1 AS DOUBLE) AS ps FROM lab),\n"
        "cj AS (SELECT c.grp, c.o, a.ps AS py, b.ps AS pp FROM conf c JOIN pos a ON a.grp = c.grp AND a.v = c.y "
        "JOIN pos b ON b.grp = c.grp AND b.v = c.p),\n"
        "qa AS (SELECT grp, sum(o) AS n, sum(o * (py - pp) * (py - pp)) AS wo, sum(o * py * py) AS r2, "
        "sum(o * pp * pp) AS c2, sum(o * py) AS r1, sum(o * pp) AS c1 FROM cj GROUP BY grp),\n"
        "qw AS (SELECT grp, 1 - wo / ((n * r2 + n * c2 - 2 * r1 * c1) / n) AS qwk FROM qa),\n"
        "r AS (SELECT grp, count(*) AS n, avg(rps) AS rps, avg(CAST(abs(observed_mrs - am) AS DOUBLE)) AS mae "
        "FROM s GROUP BY grp)\n"
        f"SELECT grp, n, {d6('rps')} AS ranked_probability_score, {d6('mae')} AS average_absolute_ordinal_error, "
        f"{d6('cidx')} AS ordinal_concordance, {d6('2 * cidx - 1')} AS somers_dxy, "
        f"{d6('qwk')} AS quadratic_weighted_kappa FROM r JOIN conc USING (grp) JOIN qw USING (grp)")


@register("ordinal_metrics", _ordinal_sql())
def q_ordinal_metrics(spark, sf_dir):
    """7-class metric bundle per group."""
    o = ordinal_predictions(spark, sf_dir)
    return round_doubles(metrics.ordinal_metric_bundle(o, ["grp"], "observed_mrs", PROBS))
