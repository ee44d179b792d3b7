"""Queries for conformal sets, recalibration, grouped resampling and the
fold-safe encoder, with DuckDB oracles where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import hash_order
from ..operators import clean, labels, metrics, replicates, resample, split, uncertainty
from ..operators.bijection import bijection_constants, position_sql
from ..operators.encode import FoldSafeEncoder
from ..specs import (CONFORMAL_ALPHA, GLOBAL_SEED, LEARNING_CURVE_FRACTIONS, MODEL_SPECS, N_BOOTSTRAP,
                     N_PERMUTATIONS)
from . import fixtures as fx
from .metric_queries import PREDS_SQL_CTE, cum_sql, round_doubles
from .registry import STANDIN_SPLIT, d6, register
from .catalog import ORD_ELIG_SQL, ORD_LABEL_SQL


def md5_key(seed, salt, *keys) -> str:
    parts = ", ".join([f"'{seed}'", f"'{salt}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"('0x' || substr(md5(concat_ws(':', {parts})), 1, 12))::BIGINT"


def _dev(spark, sf_dir):
    return fx.predictions(spark, sf_dir).filter(F.col("split") == "development")


# ---------------------------------------------------------------------------
# Conformal
# ---------------------------------------------------------------------------

_A = repr(1.0 - CONFORMAL_ALPHA)
CONFORMAL_CTES = (
    f"WITH {PREDS_SQL_CTE},\n"
    "cal AS (SELECT 1.0 - CASE WHEN observed = 1 THEN probability ELSE 1.0 - probability END AS s "
    "FROM preds WHERE split = 'development'),\n"
    f"nn AS (SELECT count(*) AS n FROM cal),\n"
    f"idx AS (SELECT n, ceil(least(CAST(1.0 AS DOUBLE), ceil((n + 1) * CAST({_A} AS DOUBLE)) / n) * (n - 1)) AS r FROM nn),\n"
    "q AS (SELECT s AS qhat FROM (SELECT s, row_number() OVER (ORDER BY s) - 1 AS rk FROM cal) WHERE rk = (SELECT r FROM idx)),\n"
    "t AS (SELECT study_case_id, observed, probability, 1.0 - probability AS p0, probability AS p1, "
    "(SELECT qhat FROM q) AS qh FROM preds WHERE split = 'temporal'),\n"
    "f AS (SELECT *, (1.0 - p0) <= qh AS i0, (1.0 - p1) <= qh AS i1 FROM t),\n"
    "g AS (SELECT study_case_id, observed, "
    "CAST(i0 OR (NOT (i0 OR i1) AND p0 >= p1) AS INTEGER) AS include_class_0, "
    "CAST(i1 OR (NOT (i0 OR i1) AND p1 > p0) AS INTEGER) AS include_class_1 FROM f)\n")


def _conformal_sets(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    cal = uncertainty.nonconformity(p.filter(F.col("split") == "development"))
    q = uncertainty.conformal_quantile(cal)
    later = p.filter(F.col("split") == "temporal")
    return uncertainty.prediction_sets(later, q), q


@register("conformal_quantile", CONFORMAL_CTES + f"SELECT (SELECT n FROM nn) AS n, {d6('qhat')} AS qhat FROM q")
def q_conformal_quantile(spark, sf_dir):
    """U1 + U2: split-conformal quantile of development nonconformity."""
    _, q = _conformal_sets(spark, sf_dir)
    return round_doubles(q)


@register("prediction_sets", CONFORMAL_CTES +
          "SELECT study_case_id, include_class_0, include_class_1, "
          "include_class_0 + include_class_1 AS prediction_set_size FROM g")
def q_prediction_sets(spark, sf_dir):
    """U3 on the later period with the development quantile."""
    sets, _ = _conformal_sets(spark, sf_dir)
    return sets.select("study_case_id", "include_class_0", "include_class_1", "prediction_set_size")


@register("conformal_coverage", CONFORMAL_CTES +
          "SELECT count(*) AS temporal_n, "
          + d6("avg(CASE WHEN observed = 0 THEN include_class_0 ELSE include_class_1 END)") + " AS temporal_coverage, "
          + d6("avg(include_class_0 + include_class_1)") + " AS average_prediction_set_size, "
          + d6(_A) + " AS nominal_coverage FROM g")
def q_conformal_coverage(spark, sf_dir):
    """U4."""
    sets, _ = _conformal_sets(spark, sf_dir)
    return round_doubles(uncertainty.coverage_summary(sets))


@register("recalibration")
def q_recalibration(spark, sf_dir):
    """Logistic recalibration fitted on development predictions,
    applied to the later period; Brier before and after (rows-only check:
    the fit is an iterative Newton solve)."""
    p = fx.predictions(spark, sf_dir)
    rc = uncertainty.fit_recalibrator(p.filter(F.col("split") == "development"))
    cal = rc.apply(p)
    out = cal.groupBy("split").agg(
        F.avg((F.col("probability") - F.col("observed")) ** 2).alias("raw_brier"),
        F.avg((F.col("calibrated_probability") - F.col("observed")) ** 2).alias("recalibrated_brier"))
    return round_doubles(out.withColumn("recalibration_intercept", F.lit(rc.intercept))
                         .withColumn("recalibration_slope", F.lit(rc.slope)))


# ---------------------------------------------------------------------------
# Grouped resampling
# ---------------------------------------------------------------------------

FOLD_CTES = (
    f"WITH {PREDS_SQL_CTE},\n"
    "dev AS (SELECT * FROM preds WHERE split = 'development'),\n"
    "g AS (SELECT study_patient_id, sum(observed) AS n_pos, count(*) - sum(observed) AS n_neg, "
    f"{md5_key(GLOBAL_SEED, 'fold', 'study_patient_id')} AS h FROM dev GROUP BY study_patient_id),\n"
    "fo AS (SELECT study_patient_id, CAST((row_number() OVER (ORDER BY n_pos, n_neg, h, study_patient_id) - 1) % 5 "
    "AS INTEGER) AS fold FROM g)\n")


@register("stratified_group_folds", FOLD_CTES + "SELECT study_patient_id, fold FROM fo")
def q_group_folds(spark, sf_dir):
    """G1: 5 stratified group folds (seed 2024) over development patients."""
    return resample.stratified_group_folds(_dev(spark, sf_dir), "study_patient_id", "observed")


@register("fold_balance", FOLD_CTES +
          "SELECT fold, count(DISTINCT study_patient_id) AS n_groups, count(*) AS n_rows, "
          "CAST(sum(observed) AS BIGINT) AS positives FROM dev JOIN fo USING (study_patient_id) GROUP BY fold")
def q_fold_balance(spark, sf_dir):
    """G1 balance: groups, rows and positives per fold."""
    d = resample.assign_folds(_dev(spark, sf_dir), "study_patient_id", "observed")
    return d.groupBy("fold").agg(F.countDistinct("study_patient_id").alias("n_groups"),
                                 F.count(F.lit(1)).alias("n_rows"),
                                 F.sum("observed").cast("bigint").alias("positives"))


@register("oof_target_encoding", FOLD_CTES.rstrip("\n") + ",\n"
          "r AS (SELECT d.*, fo.fold FROM dev d JOIN fo USING (study_patient_id)),\n"
          "pf AS (SELECT priority, fold, sum(observed) AS s, count(*) AS c FROM r GROUP BY ALL),\n"
          "pt AS (SELECT priority, sum(s) AS ts, sum(c) AS tc FROM pf GROUP BY priority)\n"
          "SELECT r.study_case_id, r.fold, "
          + d6("CASE WHEN tc - c > 0 THEN (ts - s) / (tc - c) END")
          + " AS oof_probability FROM r JOIN pf USING (priority, fold) JOIN pt USING (priority)")
def q_oof_target_encoding(spark, sf_dir):
    """G2 with a model fitted on training folds only: each row's prediction is
    the positive rate of its category among the other folds' rows (one pass:
    category totals minus the row's own fold)."""
    d = resample.assign_folds(_dev(spark, sf_dir), "study_patient_id", "observed")
    per = d.groupBy("priority", "fold").agg(F.sum("observed").alias("s"), F.count(F.lit(1)).alias("c"))
    tot = per.groupBy("priority").agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    pred = (per.join(tot, "priority")
            .select("priority", "fold", F.when(F.col("tc") - F.col("c") > 0,
                                               (F.col("ts") - F.col("s")) / (F.col("tc") - F.col("c")))
                    .alias("oof_probability")))
    oof = d.join(pred, ["priority", "fold"]).select("study_case_id", "fold", "oof_probability")
    return round_doubles(oof)


@register("oof_check")
def q_oof_check(spark, sf_dir):
    """G2 invariant: every eligible row predicted exactly once; plus the
    group-in-one-fold invariant of G1."""
    dev = _dev(spark, sf_dir)
    oof = q_oof_target_encoding(spark, sf_dir)
    d = resample.assign_folds(dev, "study_patient_id", "observed")
    return resample.oof_findings(oof, dev, "study_case_id").unionByName(
        resample.fold_findings(d, "study_patient_id"))


N_BOOT_Q = N_BOOTSTRAP


def _boot_weights(spark, sf_dir):
    return resample.cluster_bootstrap(_dev(spark, sf_dir), "study_patient_id", "observed", N_BOOT_Q)


BOOT_CTES = (
    f"WITH {PREDS_SQL_CTE},\n"
    "dev AS (SELECT * FROM preds WHERE split = 'development'),\n"
    f"gi AS (SELECT study_patient_id, row_number() OVER (ORDER BY {md5_key(GLOBAL_SEED, 'group', 'study_patient_id')}, "
    "study_patient_id) - 1 AS group_idx FROM (SELECT DISTINCT study_patient_id FROM dev)),\n"
    "ng AS (SELECT count(*) AS G FROM gi),\n"
    "dr AS (SELECT r // (SELECT G FROM ng) AS rep, r % (SELECT G FROM ng) AS draw "
    f"FROM range(0, {N_BOOT_Q} * (SELECT G FROM ng)) t(r)),\n"
    f"w AS (SELECT rep, {md5_key(GLOBAL_SEED, 'draw', 'rep', 'draw')} % (SELECT G FROM ng) AS group_idx, "
    "count(*) AS weight FROM dr GROUP BY ALL),\n"
    "bw AS (SELECT rep, study_patient_id, weight FROM w JOIN gi USING (group_idx))\n")


@register("bootstrap_weights", BOOT_CTES + "SELECT rep, study_patient_id, weight FROM bw")
def q_bootstrap_weights(spark, sf_dir):
    """2000 patient-cluster bootstrap replicates as (rep, patient, weight)."""
    return _boot_weights(spark, sf_dir)


@register("bootstrap_auc", BOOT_CTES.replace(
    "bw AS (SELECT rep, study_patient_id, weight FROM w JOIN gi USING (group_idx))\n",
    "bw AS (SELECT rep, study_patient_id, weight FROM w JOIN gi USING (group_idx)),\n"
    "h AS (SELECT rep, CAST(probability AS DOUBLE) AS score, "
    "CAST(sum(weight * observed) AS DOUBLE) AS pos, CAST(sum(weight * (1 - observed)) AS DOUBLE) AS neg "
    "FROM dev JOIN bw USING (study_patient_id) GROUP BY ALL),\n"
    f"c AS ({cum_sql('rep', 'h')}),\n"
    "tt AS (SELECT rep, sum(pos) AS P, sum(neg) AS N FROM h GROUP BY rep)\n")
    + f"SELECT rep, {d6('sum(pos * (lt_neg + 0.5 * neg)) / (P * N)')} AS roc_auc "
      "FROM c JOIN tt USING (rep) GROUP BY rep, P, N")
def q_bootstrap_auc(spark, sf_dir):
    """U5 metric-only mode: weighted AUC of the fixed score in each of the 2000
    replicates, by one scan with a weight vector per patient."""
    return round_doubles(replicates.bootstrap_aucs(_dev(spark, sf_dir), "study_patient_id", "observed", "probability",
                                                   N_BOOT_Q, GLOBAL_SEED).select("rep", "roc_auc"))


N_PERM_Q = N_PERMUTATIONS

_PERM = bijection_constants(GLOBAL_SEED, "perm")
#: rows ranked once; the walk sends (rank, replicate) to a place, the last places are the positives'
PERM_CTES = (
    f"WITH RECURSIVE {PREDS_SQL_CTE},\n"
    "dev AS (SELECT * FROM preds WHERE split = 'development'),\n"
    f"rk AS (SELECT study_case_id, observed, probability, row_number() OVER (ORDER BY {md5_key(GLOBAL_SEED, 'perm:key', 'study_case_id')}, "
    "study_case_id) - 1 AS r FROM dev),\n"
    "dims AS (SELECT count(*) AS n, CAST(sum(observed) AS BIGINT) AS p, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM dev),\n"
    "dim AS (SELECT *, (n + a - 1) // a AS c FROM dims),\n"
    "walk AS (SELECT r, b, a, c, n, p, y FROM ("
    + position_sql(f"SELECT r, b, a, c, n, p, r AS x FROM rk, dim, range(0, {N_PERM_Q}) t(b)", _PERM)
    + ") UNION ALL SELECT r, b, a, c, n, p, y FROM ("
    + position_sql("SELECT r, b, a, c, n, p, y AS x FROM walk WHERE y >= n", _PERM) + ")),\n"
    "pl AS (SELECT b, study_case_id, probability, CASE WHEN y >= n - p THEN 1 ELSE 0 END AS observed_permuted "
    "FROM walk JOIN rk USING (r) WHERE y < n)\n")


@register("permuted_labels", PERM_CTES + "SELECT study_case_id, count(*) AS replicates, CAST(sum(observed_permuted) AS BIGINT) AS times_positive, "
          "CAST(sum(b * observed_permuted) AS BIGINT) AS replicate_sum FROM pl GROUP BY study_case_id")
def q_permuted_labels(spark, sf_dir):
    """1000 global label permutations of the development rows; per row the replicates
    that make it positive, as their number and sum."""
    return replicates.permuted_positives(_dev(spark, sf_dir), "study_case_id", "observed", N_PERM_Q, GLOBAL_SEED)


@register("permutation_test", PERM_CTES.rstrip("\n") + ",\n"
    "x AS (SELECT b, observed_permuted AS observed, probability FROM pl "
    "UNION ALL SELECT -1 AS b, observed, probability FROM dev),\n"
    "h AS (SELECT b, CAST(probability AS DOUBLE) AS score, CAST(sum(observed) AS DOUBLE) AS pos, "
    "CAST(sum(1 - observed) AS DOUBLE) AS neg FROM x GROUP BY ALL),\n"
    f"c AS ({cum_sql('b', 'h')}),\n"
    "tt AS (SELECT b, sum(pos) AS P, sum(neg) AS N FROM h GROUP BY b),\n"
    "a AS (SELECT b, sum(pos * (lt_neg + 0.5 * neg)) / (P * N) AS auc FROM c JOIN tt USING (b) GROUP BY b, P, N)\n"
    + "SELECT " + d6("(SELECT auc FROM a WHERE b = -1)") + " AS baseline_auc, count(*) AS permutations, "
    + d6("(count(*) FILTER (WHERE auc >= (SELECT auc FROM a WHERE b = -1)) + 1) / (count(*) + 1)") + " AS p_value, "
    + d6("avg(auc)") + " AS permuted_auc_mean, " + d6("stddev_samp(auc)") + " AS permuted_auc_sd FROM a WHERE b >= 0")
def q_permutation_test(spark, sf_dir):
    """U6 metric-only mode: AUC of the fixed score against each of 1000 permuted
    label vectors, p = (#{perm >= base} + 1) / (B + 1)."""
    dev = _dev(spark, sf_dir)
    perms = replicates.permutation_aucs(dev, "study_case_id", "observed", "probability", N_PERM_Q, GLOBAL_SEED)
    base = metrics.auc_ap(dev, [], "observed", "probability").select(F.col("roc_auc").alias("base"))
    perms = perms.select(F.col("replicate").alias("b"), F.col("roc_auc").alias("auc"))
    out = metrics.attach(perms, base, []).agg(
        F.first("base").alias("baseline_auc"), F.count(F.lit(1)).alias("permutations"),
        ((F.count(F.when(F.col("auc") >= F.col("base"), 1)) + 1) / (F.count(F.lit(1)) + 1)).alias("p_value"),
        F.avg("auc").alias("permuted_auc_mean"), F.stddev_samp("auc").alias("permuted_auc_sd"))
    return round_doubles(out)


_FR = "(VALUES " + ", ".join(f"({f!r})" for f in LEARNING_CURVE_FRACTIONS) + ") v(fraction)"


@register("learning_curve_subsets", (
    f"WITH {PREDS_SQL_CTE},\n"
    "dev AS (SELECT * FROM preds WHERE split = 'development'),\n"
    "g AS (SELECT study_patient_id, sum(observed) AS n_pos, count(*) - sum(observed) AS n_neg FROM dev GROUP BY 1),\n"
    f"gi AS (SELECT *, row_number() OVER (ORDER BY {md5_key(GLOBAL_SEED, 'group', 'study_patient_id')}, "
    "study_patient_id) - 1 AS group_idx FROM g),\n"
    "ng AS (SELECT count(*) AS G FROM gi),\n"
    f"fr AS (SELECT CAST(fraction AS DOUBLE) AS fraction, greatest(2, CAST(ceil(CAST(fraction AS DOUBLE) * (SELECT G FROM ng)) AS BIGINT)) AS n_f FROM {_FR})\n"
    "SELECT fraction, n_f AS n_groups, CAST(sum(n_pos + n_neg) AS BIGINT) AS n_rows, CAST(sum(n_pos) AS BIGINT) AS positives, "
    "sum(n_pos) > 0 AND sum(n_pos) < sum(n_pos + n_neg) AS usable FROM fr JOIN gi ON gi.group_idx < fr.n_f "
    "GROUP BY fraction, n_f"))
def q_learning_curve_subsets(spark, sf_dir):
    """Nested patient subsets at 20/40/60/80/100 %."""
    return resample.nested_group_subsets(_dev(spark, sf_dir), "study_patient_id", "observed")


# ---------------------------------------------------------------------------
# Fold-safe encoder
# ---------------------------------------------------------------------------

_E = MODEL_SPECS["pcoma_e_binary"]
_E_NUM = [f for f in _E.features if f not in _E.categorical]


def _model_rows(spark, sf_dir):
    reg = labels.thresholded_ordinal_label(fx.registry(spark, sf_dir))
    reg = clean.eligible_rows(reg, _E.eligibility_column, _E.target)
    return split.split_temporal(reg, STANDIN_SPLIT)


def _encoder_sql() -> str:
    imp = {c: f"coalesce(CAST({c} AS DOUBLE), (SELECT med_{c} FROM st))" for c in _E_NUM}
    ind = {c: f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END" for c in ("baseline_mrs", "acha_distance_from_neck_mm")}
    feats = [(f"numeric__{c}", imp[c]) for c in _E_NUM] + \
            [(f"numeric__missingindicator_{c}", e) for c, e in ind.items()]
    stats = ", ".join([f"median({c}) AS med_{c}" for c in _E_NUM])
    sc = ", ".join([f"avg({e}) AS m_{n}, stddev_pop({e}) AS s_{n}" for n, e in feats])
    mode = ("(SELECT rupture_status FROM dev WHERE rupture_status IS NOT NULL GROUP BY 1 "
            "ORDER BY count(*) DESC, rupture_status ASC LIMIT 1)")
    cols = [d6(f"({e} - (SELECT m_{n} FROM sc)) / (SELECT CASE WHEN s_{n} > 0 THEN s_{n} ELSE 1.0 END FROM sc)")
            + f" AS {n}" for n, e in feats]
    for cat in ("Ruptured", "Unruptured"):
        cols.append(f"CAST(CASE WHEN coalesce(rupture_status, {mode}) = '{cat}' THEN 1.0 ELSE 0.0 END AS DOUBLE) "
                    f"AS categorical__rupture_status_{cat}")
    return fx.with_ctes(
        f"SELECT study_case_id, {', '.join(cols)} FROM m WHERE NOT (index_year BETWEEN 1995 AND 1998)",
        "registry").replace(
        "\nSELECT study_case_id",
        f",\nm AS (SELECT * FROM registry WHERE {ORD_ELIG_SQL} = 1 AND ({ORD_LABEL_SQL}) IS NOT NULL),\n"
        "dev AS (SELECT * FROM m WHERE index_year BETWEEN 1995 AND 1998),\n"
        f"st AS (SELECT {stats} FROM dev),\n"
        f"sc AS (SELECT {sc} FROM dev)\nSELECT study_case_id", 1)


@register("fold_safe_encoding", _encoder_sql())
def q_fold_safe_encoding(spark, sf_dir):
    """Encoder fitted on development rows (exact medians, indicators
    for columns with gaps, mode imputation, sorted one-hot, population-sd
    scaling), applied unchanged to the later period."""
    rows = _model_rows(spark, sf_dir)
    enc = FoldSafeEncoder(_E_NUM, _E.categorical, scale=True).fit(rows.filter(F.col("split") == "development"))
    out = enc.transform(rows.filter(F.col("split") == "temporal"), keep=["study_case_id"])
    return round_doubles(out)



# each training fold's encoder, from one histogram

_ENC_FOLD = f"({md5_key(GLOBAL_SEED, 'encoder', 'study_patient_id')} % 5)"


def _fold_encoder_sql() -> str:
    def part(name, value, median, imputed, having):
        return (f"SELECT scheme AS fold, '{name}' AS feature, count(*) AS n_rows, {median} AS median, "
                f"{d6(f'avg({imputed})')} AS mean, {d6(f'stddev_pop({imputed})')} AS sd, CAST(NULL AS BOOLEAN) AS is_mode "
                f"FROM t GROUP BY scheme HAVING {having}")
    parts = []
    meds = ", ".join(f"median(CAST({c} AS DOUBLE)) OVER (PARTITION BY scheme) AS med_{c}" for c in _E_NUM)
    for c in _E_NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(part(f"numeric__{c}", c, d6(f"median({x})"), f"coalesce({x}, med_{c})", f"count({c}) > 0"))
        parts.append(part(f"numeric__missingindicator_{c}", c, "CAST(NULL AS DOUBLE)",
                          f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END", f"count({c}) > 0 AND count({c}) < count(*)"))
    for c in _E.categorical:
        parts.append(f"SELECT scheme AS fold, 'categorical__{c}_' || {c} AS feature, max(n) AS n_rows, NULL AS median, NULL AS mean, "
                     f"NULL AS sd, row_number() OVER (PARTITION BY scheme ORDER BY count(*) DESC, {c}) = 1 AS is_mode "
                     f"FROM t WHERE {c} IS NOT NULL GROUP BY scheme, {c}")
    return fx.with_ctes("SELECT * FROM answer", "registry").replace(
        "\nSELECT * FROM answer",
        f",\ndev AS (SELECT *, {_ENC_FOLD} AS own FROM registry WHERE {ORD_ELIG_SQL} = 1 AND ({ORD_LABEL_SQL}) IS NOT NULL "
        "AND index_year BETWEEN 1995 AND 1998),\n"
        "t AS (SELECT d.*, f.scheme, count(*) OVER (PARTITION BY scheme) AS n, " + meds +
        " FROM dev d, (SELECT CAST(unnest(range(-1, 5)) AS INTEGER) AS scheme) f WHERE f.scheme <> d.own)\n" + "\nUNION ALL ".join(parts), 1)


@register("fold_encoder_statistics", _fold_encoder_sql())
def q_fold_encoder_statistics(spark, sf_dir):
    """P1-P4 for M1: what the encoder of every training fold learns (the fold's own rows
    held out; fold -1: all rows): medians, means and sds of numerics and indicators,
    levels and mode of the category, all from one scan."""
    rows = _model_rows(spark, sf_dir).filter(F.col("split") == "development")
    rows = rows.withColumn("fold", F.pmod(hash_order(GLOBAL_SEED, "encoder", F.col("study_patient_id")), F.lit(5)))
    folds, whole = FoldSafeEncoder(_E_NUM, _E.categorical, scale=True).fit_folds(rows, "fold", 5)
    out = []
    for f, e in [*enumerate(folds), (-1, whole)]:
        medians = {f"numeric__{c}": m for c, m in e.medians.items()}
        out += [(f, n, e.n_rows, medians.get(n), m, e.sds[n], None) for n, m in e.means.items()]
        out += [(f, f"categorical__{c}_{v}", e.n_rows, None, None, None, v == e.modes[c])
                for c in e.categorical for v in e.categories[c]]
    return round_doubles(spark.createDataFrame(
        out, "fold int, feature string, n_rows long, median double, mean double, sd double, is_mode boolean"))
