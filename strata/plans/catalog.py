"""Registered queries: one Spark plan and one DuckDB oracle per operator.

``QUERIES[name](spark, sf_dir) -> DataFrame`` reads the driver tables under
``sf_dir`` (whole tables) and runs one operator of the library on them;
``ORACLE[name]`` is the same computation in DuckDB SQL over the same
tables.  Doubles are rounded to 6 places on both sides, counts are BIGINT,
flags INTEGER, and every output column carries the same alias.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import r6
from ..operators import clean, labels, score, split, validate
from ..specs import (COMPANION_SUFFIX, IDENTIFIER_COLUMNS, MISSING_CODES, SCORECARD_C,
                     SCORECARD_E, SCORECARD_O, SCORECARD_R_PROVISIONAL, MODEL_SPECS, SplitSpec)
from . import fixtures as fx
from .registry import ORACLE, QUERIES, STANDIN_SPLIT, d6, register  # noqa: F401

_CODES_SQL = "(" + ", ".join(f"'{c}'" for c in MISSING_CODES) + ")"
_d6 = d6


# ---------------------------------------------------------------------------
# Cleaning (C1-C4), intake scans
# ---------------------------------------------------------------------------

def _clean_sql_cols() -> list[str]:
    out, comps = [], []
    for name, _ in fx.RAW_COLUMNS:
        t = f"trim({name})"
        code = f"({t} IN {_CODES_SQL})"
        base = f"CASE WHEN {code} OR {t} = '' THEN NULL ELSE {name} END"
        if name in fx.RAW_NUMERIC:
            out.append(f"TRY_CAST({base} AS DOUBLE) AS {name}")
        elif name in fx.RAW_BINARY:
            d = f"TRY_CAST({base} AS DOUBLE)"
            out.append(f"CASE WHEN {d} IN (0, 1) THEN CAST({d} AS INTEGER) END AS {name}")
        else:
            out.append(f"NULLIF(trim({base}), '') AS {name}")
        if name in fx.RAW_TRACKED:
            comps.append(f"CASE WHEN {code} THEN {t} END AS {name}{COMPANION_SUFFIX}")
    return out + comps


CLEAN_SQL = "SELECT " + ", ".join(_clean_sql_cols()) + " FROM raw"


def cleaned_intake(spark, sf_dir):
    return clean.clean_columns(fx.raw_intake(spark, sf_dir), fx.RAW_NUMERIC, fx.RAW_BINARY,
                               fx.RAW_TRACKED)


@register("clean_intake", fx.with_ctes(CLEAN_SQL, "raw"))
def q_clean_intake(spark, sf_dir):
    """Codes kept in companions, blanks/junk -> null, typed columns."""
    return cleaned_intake(spark, sf_dir)


@register("missing_code_scan", fx.with_ctes(
    "SELECT variable, code, count(*) AS n, CASE WHEN starts_with(code, 'MISS_') OR variable IN ("
    + ", ".join(f"'{c}'" for c in IDENTIFIER_COLUMNS + ("index_case_flag",))
    + ") THEN 'error' ELSE 'info' END AS severity FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS variable, trim({n}) AS code FROM raw" for n, _ in fx.RAW_COLUMNS)
    + f") WHERE code IN {_CODES_SQL} OR starts_with(code, 'MISS_') GROUP BY variable, code", "raw"))
def q_missing_code_scan(spark, sf_dir):
    """Code-like cells per column in one explode pass."""
    return validate.scan_missing_codes(fx.raw_intake(spark, sf_dir))


@register("missingness_report", fx.with_ctes(
    "SELECT variable, n, missing_n, " + _d6("missing_n / n") + " AS missing_fraction FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS variable, count(*) AS n, count(*) - count({n}) AS missing_n FROM cleaned"
                         for n, _ in fx.RAW_COLUMNS) + ")",
    "raw").replace("\nSELECT variable", f",\ncleaned AS ({CLEAN_SQL})\nSELECT variable", 1))
def q_missingness_report(spark, sf_dir):
    """V11 on the cleaned intake (companions excluded)."""
    rep = validate.missingness_report(cleaned_intake(spark, sf_dir))
    return rep.select("variable", "n", "missing_n", r6("missing_fraction").alias("missing_fraction"))


def _finding_sql(name, variable, n_expr, source, bad=None):
    bad = bad or "n > 0"
    return (f"SELECT '{name}' AS finding, CASE WHEN {bad} THEN 'error' ELSE 'ok' END AS severity, "
            f"'{variable}' AS variable, CAST(n AS BIGINT) AS n FROM (SELECT {n_expr} AS n FROM {source})")


def _validate_sql() -> str:
    s = STANDIN_SPLIT
    parts = [_finding_sql("not_blank", c, f"count(*) FILTER (WHERE coalesce(trim({c}), '') = '')", "raw")
             for c in ("study_patient_id", "study_case_id", "aneurysm_id", "procedure_id")]
    parts.append(_finding_sql("unique_key", "study_case_id", "count(*)",
                              "(SELECT study_case_id FROM raw GROUP BY 1 HAVING count(*) > 1)"))
    parts.append(_finding_sql("flag_domain", "index_case_flag",
                              "count(*) FILTER (WHERE NOT coalesce(TRY_CAST(index_case_flag AS DOUBLE) IN (0, 1), false))",
                              "raw"))
    y = "TRY_CAST(index_year AS DOUBLE)"
    parts.append(_finding_sql("range_missing", "index_year", f"count(*) FILTER (WHERE {y} IS NULL)", "raw"))
    parts.append(_finding_sql("range_outside", "index_year",
                              f"count(*) FILTER (WHERE NOT ({y} BETWEEN {s.development_start_year} AND {s.temporal_end_year}))",
                              "raw"))
    parts.append(_finding_sql("range_non_integer", "index_year", f"count(*) FILTER (WHERE {y} <> floor({y}))", "raw"))
    parts.append(_finding_sql("group_overlap", "study_patient_id", "count(*)", _overlap_sql("raw", y)))
    return " UNION ALL ".join(parts)


def _overlap_sql(source: str, y: str) -> str:
    s = STANDIN_SPLIT
    return (f"(SELECT study_patient_id FROM {source} GROUP BY 1 HAVING "
            f"max(CASE WHEN {y} BETWEEN {s.development_start_year} AND {s.development_end_year} THEN 1 ELSE 0 END) = 1 AND "
            f"max(CASE WHEN {y} BETWEEN {s.temporal_start_year} AND {s.temporal_end_year} THEN 1 ELSE 0 END) = 1)")


@register("validate_intake", fx.with_ctes(_validate_sql(), "raw"))
def q_validate_intake(spark, sf_dir):
    """V3-V6, V8 on the raw intake as one findings table."""
    return validate.validate_registry(fx.raw_intake(spark, sf_dir), STANDIN_SPLIT)


@register("expected_counts", fx.with_ctes(
    " UNION ALL ".join(
        _finding_sql("expected_counts", k, f"{expr} - {v}", "raw", "n <> 0")
        for k, expr, v in (
            ("total", "count(*)", 15000),
            ("development", "count(*) FILTER (WHERE TRY_CAST(index_year AS DOUBLE) BETWEEN 1995 AND 1998)", 8500),
            ("temporal", "count(*) FILTER (WHERE TRY_CAST(index_year AS DOUBLE) BETWEEN 1999 AND 2001)", 6500))),
    "raw"))
def q_expected_counts(spark, sf_dir):
    """V7 (strict mode) against fixed expected counts."""
    spec = SplitSpec(1995, 1998, 1999, 2001, 15000, 8500, 6500, True)
    return validate.check_expected_counts(fx.raw_intake(spark, sf_dir), "index_year", spec)


@register("binary_domain", fx.with_ctes(" UNION ALL ".join(
    _finding_sql("binary_domain", c,
                 f"count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) IS NOT NULL AND TRY_CAST({c} AS DOUBLE) NOT IN (0, 1))",
                 "raw") for c in fx.RAW_BINARY), "raw"))
def q_binary_domain(spark, sf_dir):
    """C3 strict check: parsed numbers outside 0/1."""
    return clean.binary_findings(fx.raw_intake(spark, sf_dir), fx.RAW_BINARY)


@register("group_key_check", fx.with_ctes(_finding_sql(
    "group_key", "study_patient_id",
    "count(*) FILTER (WHERE study_patient_id IS NULL OR trim(study_patient_id) = '')", "registry"), "registry"))
def q_group_key_check(spark, sf_dir):
    """C8."""
    return clean.group_findings(fx.registry(spark, sf_dir), "study_patient_id")


# ---------------------------------------------------------------------------
# Time-gated split
# ---------------------------------------------------------------------------

def _split_case(y: str) -> str:
    s = STANDIN_SPLIT
    return (f"CASE WHEN {y} BETWEEN {s.development_start_year} AND {s.development_end_year} THEN 'development' "
            f"WHEN {y} BETWEEN {s.temporal_start_year} AND {s.temporal_end_year} THEN 'temporal' END")


@register("split_by_group", fx.with_ctes(
    "SELECT r.study_case_id, r.study_patient_id, r.index_year, " + _split_case("g.first_year") + " AS split "
    "FROM registry r JOIN (SELECT study_patient_id, min(CAST(index_year AS DOUBLE)) AS first_year "
    "FROM registry GROUP BY 1) g USING (study_patient_id)", "registry"))
def q_split_by_group(spark, sf_dir):
    """Every episode of a patient takes the period of the first year."""
    df = split.split_temporal(fx.registry(spark, sf_dir), STANDIN_SPLIT, policy="by_group")
    return df.select("study_case_id", "study_patient_id", "index_year", "split")


@register("split_findings", fx.with_ctes(
    _finding_sql("outside_periods", "index_year",
                 "count(*) FILTER (WHERE (" + _split_case("index_year") + ") IS NULL)", "registry")
    + " UNION ALL "
    + _finding_sql("group_overlap", "study_patient_id", "count(*)", _overlap_sql("registry", "index_year")),
    "registry"))
def q_split_findings(spark, sf_dir):
    """T1 checks: rows outside both periods; patients crossing the boundary."""
    return split.split_findings(fx.registry(spark, sf_dir), STANDIN_SPLIT)


@register("split_counts", fx.with_ctes(
    "SELECT " + _split_case("index_year") + " AS split, count(*) AS n, "
    "count(DISTINCT study_patient_id) AS patients FROM registry GROUP BY 1", "registry"))
def q_split_counts(spark, sf_dir):
    """Rows and patients per period."""
    df = split.split_temporal(fx.registry(spark, sf_dir), STANDIN_SPLIT)
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                   F.countDistinct("study_patient_id").alias("patients"))


# ---------------------------------------------------------------------------
# Endpoint rules
# ---------------------------------------------------------------------------

COMPOSITE_COUNT_SQL = (
    "(pcoma_c_exposure_component + pcoma_c_reconstruction_component"
    " + CASE WHEN temporary_clip_cumulative_sec > 600 THEN 1 ELSE 0 END"
    " + CASE WHEN clip_reposition_count >= 3 THEN 1 ELSE 0 END"
    " + flow_rescue_manoeuvre_flag + rupture_escalation_flag)")
COMPOSITE_LABEL_SQL = (
    f"CASE WHEN {COMPOSITE_COUNT_SQL} >= 2 OR clip_reposition_count >= 3 "
    "OR flow_rescue_manoeuvre_flag = 1 THEN 1 ELSE 0 END")


@register("composite_label", fx.with_ctes(
    f"SELECT study_case_id, CAST({COMPOSITE_COUNT_SQL} AS INTEGER) AS pcoma_c_component_count, "
    f"{COMPOSITE_LABEL_SQL} AS derived_high_complexity_case FROM registry", "registry"))
def q_composite_label(spark, sf_dir):
    """E1."""
    df = labels.composite_label(fx.registry(spark, sf_dir))
    return df.select("study_case_id", "pcoma_c_component_count", "derived_high_complexity_case")


ADJ_SQL = (
    "CASE WHEN new_postop_dwi_lesion_flag IS NULL OR new_postop_ct_hypodensity_flag IS NULL "
    "OR ischaemia_mechanism_indeterminate_flag = 1 THEN NULL "
    "WHEN (((new_postop_dwi_lesion_flag = 1 OR new_postop_ct_hypodensity_flag = 1) "
    "AND lesion_anatomically_concordant_flag = 1) OR new_postop_ischaemic_deficit_flag = 1) "
    "AND NOT (preexisting_infarct_flag = 1 OR delayed_cerebral_ischaemia_flag = 1 "
    "OR vasospasm_related_infarct_flag = 1 OR venous_infarction_flag = 1 "
    "OR nonprocedural_embolic_lesion_flag = 1) THEN 1 ELSE 0 END")


@register("adjudicated_label", fx.with_ctes(
    f"SELECT study_case_id, {ADJ_SQL} AS derived_procedure_related_ischemia_flag FROM registry", "registry"))
def q_adjudicated_label(spark, sf_dir):
    """E2 (rows the rule cannot decide stay null)."""
    df = labels.adjudicated_label(fx.registry(spark, sf_dir))
    return df.select("study_case_id", "derived_procedure_related_ischemia_flag")


SURV_TIME_SQL = (
    "CASE WHEN preop_cn3_palsy = 1 AND cn3_complete_recovery_12m = 1 "
    "AND time_to_complete_recovery_days > 0 AND time_to_complete_recovery_days <= 365 "
    "THEN time_to_complete_recovery_days "
    "WHEN preop_cn3_palsy = 1 AND cn3_complete_recovery_12m = 0 THEN least(365.0, "
    "CASE WHEN cn3_last_assessment_days > 0 THEN cn3_last_assessment_days END, "
    "CASE WHEN death_before_cn3_recovery = 1 AND death_time_days > 0 THEN death_time_days END) END")
SURVIVAL_SQL = (
    f"SELECT study_case_id, CASE WHEN ({SURV_TIME_SQL}) IS NOT NULL THEN cn3_complete_recovery_12m END "
    f"AS pcoma_o_event, {_d6(SURV_TIME_SQL)} AS pcoma_o_time_days, "
    "CASE WHEN preop_cn3_palsy = 1 THEN 1 - cn3_complete_recovery_12m END AS derived_cn3_nonrecovery_12m "
    "FROM registry")


@register("survival_fields", fx.with_ctes(SURVIVAL_SQL, "registry"))
def q_survival_fields(spark, sf_dir):
    """E3 + E4: event, time in (0, 365], landmark label."""
    df = labels.survival_fields(fx.registry(spark, sf_dir))
    return df.select("study_case_id", "pcoma_o_event", r6("pcoma_o_time_days").alias("pcoma_o_time_days"),
                     "derived_cn3_nonrecovery_12m")


ORD_ELIG_SQL = "CASE WHEN mrs_90d_assessment_day BETWEEN 76 AND 104 THEN 1 ELSE 0 END"
ORD_LABEL_SQL = (f"CASE WHEN {ORD_ELIG_SQL} = 1 AND mrs_90d BETWEEN 0 AND 6 "
                 "THEN CASE WHEN mrs_90d > 2 THEN 1 ELSE 0 END END")


@register("ordinal_label", fx.with_ctes(
    f"SELECT study_case_id, {ORD_ELIG_SQL} AS mrs_90d_window_eligible_flag, "
    f"{ORD_LABEL_SQL} AS derived_poor_outcome_90d FROM registry", "registry"))
def q_ordinal_label(spark, sf_dir):
    """E5."""
    df = labels.thresholded_ordinal_label(fx.registry(spark, sf_dir))
    return df.select("study_case_id", "mrs_90d_window_eligible_flag", "derived_poor_outcome_90d")


@register("label_concordance", fx.with_ctes(
    "SELECT 'derived_high_complexity_case' AS variable, (SELECT count(*) FROM m) AS n_mismatch, "
    "(SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT k FROM m ORDER BY k LIMIT 10)) AS first_keys",
    "registry").replace(
        "\nSELECT 'derived",
        f",\nm AS (SELECT study_case_id AS k FROM registry WHERE derived_high_complexity_case <> {COMPOSITE_LABEL_SQL})"
        "\nSELECT 'derived", 1))
def q_label_concordance(spark, sf_dir):
    """Supplied vs rule-derived label; count and first 10 row keys."""
    df = labels.composite_label(fx.registry(spark, sf_dir))
    return labels.label_concordance(df, "derived_high_complexity_case__supplied",
                                    "derived_high_complexity_case", "study_case_id")


@register("endpoint_audit", fx.with_ctes(
    "SELECT split, CAST(count(*) AS BIGINT) AS n_rows, v.variable, CAST(sum(v.known) AS BIGINT) AS non_null FROM ("
    "SELECT " + _split_case("index_year") + " AS split, "
    "[{'variable': 'pcoma_c_component_count', 'known': 1},"
    " {'variable': 'derived_high_complexity_case', 'known': 1},"
    f" {{'variable': 'derived_procedure_related_ischemia_flag', 'known': CASE WHEN ({ADJ_SQL}) IS NULL THEN 0 ELSE 1 END}},"
    f" {{'variable': 'pcoma_o_event', 'known': CASE WHEN ({SURV_TIME_SQL}) IS NULL THEN 0 ELSE 1 END}},"
    f" {{'variable': 'pcoma_o_time_days', 'known': CASE WHEN ({SURV_TIME_SQL}) IS NULL THEN 0 ELSE 1 END}},"
    " {'variable': 'derived_cn3_nonrecovery_12m', 'known': CASE WHEN preop_cn3_palsy = 1 THEN 1 ELSE 0 END},"
    " {'variable': 'mrs_90d_window_eligible_flag', 'known': 1},"
    f" {{'variable': 'derived_poor_outcome_90d', 'known': CASE WHEN ({ORD_LABEL_SQL}) IS NULL THEN 0 ELSE 1 END}}"
    "] AS vs FROM registry), UNNEST(vs) AS t(v) GROUP BY split, v.variable", "registry"))
def q_endpoint_audit(spark, sf_dir):
    """Non-null count of every derived column per period."""
    df = split.split_temporal(fx.registry(spark, sf_dir), STANDIN_SPLIT)
    return labels.endpoint_audit(df)


@register("endpoint_findings", fx.with_ctes(" UNION ALL ".join([
    _finding_sql("survival_palsy_domain", "preop_cn3_palsy", "0", "registry LIMIT 1"),
    _finding_sql("survival_event_missing", "cn3_complete_recovery_12m",
                 "count(*) FILTER (WHERE preop_cn3_palsy = 1 AND cn3_complete_recovery_12m IS NULL)", "registry"),
    _finding_sql("survival_event_time", "time_to_complete_recovery_days",
                 "count(*) FILTER (WHERE preop_cn3_palsy = 1 AND cn3_complete_recovery_12m = 1 AND NOT coalesce("
                 "time_to_complete_recovery_days > 0 AND time_to_complete_recovery_days <= 365, false))", "registry"),
    _finding_sql("ordinal_domain", "mrs_90d",
                 "count(*) FILTER (WHERE mrs_90d IS NOT NULL AND NOT (mrs_90d BETWEEN 0 AND 6))", "registry"),
]), "registry"))
def q_endpoint_findings(spark, sf_dir):
    """Rule violations of E3 and E5 as findings."""
    reg = fx.registry(spark, sf_dir)
    return validate.union_findings(labels.survival_findings(reg), labels.ordinal_findings(reg))


# ---------------------------------------------------------------------------
# Scorecards (K1-K5)
# ---------------------------------------------------------------------------

def _score_sql(rules) -> str:
    terms = []
    for c, op, v, pts in rules:
        op = "=" if op == "==" else op
        lit = f"'{v}'" if isinstance(v, str) else repr(v)
        terms.append(f"CASE WHEN coalesce({c} {op} {lit}, false) THEN {pts} ELSE 0 END")
    return "CAST(" + " + ".join(terms) + " AS INTEGER)"


@register("score_c", fx.with_ctes(
    f"SELECT study_case_id, {_score_sql(SCORECARD_C)} AS pcoma_c_score FROM registry "
    "WHERE index_year BETWEEN 1999 AND 2001", "registry"))
def q_score_c(spark, sf_dir):
    """K1 on the temporal period."""
    df = split.split_temporal(fx.registry(spark, sf_dir), STANDIN_SPLIT).filter(F.col("split") == "temporal")
    return score.score_c(df).select("study_case_id", "pcoma_c_score")


@register("score_o", fx.with_ctes(
    f"SELECT study_case_id, {_score_sql(SCORECARD_O)} AS pcoma_o_score FROM registry "
    "WHERE index_year BETWEEN 1995 AND 1998 AND preop_cn3_palsy = 1", "registry"))
def q_score_o(spark, sf_dir):
    """K2 on the development period, palsy = 1."""
    df = split.split_temporal(fx.registry(spark, sf_dir), STANDIN_SPLIT).filter(F.col("split") == "development")
    return score.score_o(df).select("study_case_id", "pcoma_o_score")


@register("score_e", fx.with_ctes(
    f"SELECT study_case_id, {_score_sql(SCORECARD_E)} AS pcoma_e_score FROM registry "
    f"WHERE index_year BETWEEN 1999 AND 2001 AND ({ORD_LABEL_SQL}) IS NOT NULL", "registry"))
def q_score_e(spark, sf_dir):
    """K3 on the temporal period, rows with a known label."""
    df = split.split_temporal(fx.registry(spark, sf_dir), STANDIN_SPLIT).filter(F.col("split") == "temporal")
    return score.score_e(labels.thresholded_ordinal_label(df)).select("study_case_id", "pcoma_e_score")


@register("score_r_provisional", fx.with_ctes(
    f"SELECT study_case_id, {_score_sql(SCORECARD_R_PROVISIONAL)} AS pcoma_r_score_provisional FROM registry",
    "registry"))
def q_score_r_provisional(spark, sf_dir):
    """K5 (provisional weights)."""
    return score.score_r_provisional(fx.registry(spark, sf_dir)).select("study_case_id", "pcoma_r_score_provisional")


# ---------------------------------------------------------------------------
# Derived columns and model frames
# ---------------------------------------------------------------------------

@register("derive_ratio", fx.with_ctes(
    "SELECT study_case_id, " + _d6(
        "coalesce(p1_diameter_mm, CASE WHEN pcoa_diameter_mm > 0 THEN aspect_ratio / pcoa_diameter_mm END)")
    + " AS p1_diameter_mm FROM registry", "registry"))
def q_derive_ratio(spark, sf_dir):
    """Fill a missing value from a ratio of two others."""
    df = clean.derive_ratio(fx.registry(spark, sf_dir), "p1_diameter_mm", "aspect_ratio", "pcoa_diameter_mm")
    return df.select("study_case_id", r6("p1_diameter_mm").alias("p1_diameter_mm"))


_E_SPEC = MODEL_SPECS["pcoma_e_binary"]


@register("model_frame", fx.with_ctes(
    "SELECT study_case_id, study_patient_id, " + ", ".join(
        _d6(f) + f" AS {f}" if f in ("age_years", "acha_distance_from_neck_mm") else f for f in _E_SPEC.features)
    + f", {ORD_LABEL_SQL} AS derived_poor_outcome_90d FROM registry "
    f"WHERE {ORD_ELIG_SQL} = 1 AND ({ORD_LABEL_SQL}) IS NOT NULL", "registry"))
def q_model_frame(spark, sf_dir):
    """C6 + C7: eligible rows with a known target, ordered feature projection."""
    df = labels.thresholded_ordinal_label(fx.registry(spark, sf_dir))
    df = clean.eligible_rows(df, _E_SPEC.eligibility_column, _E_SPEC.target)
    df = clean.select_features(df, ["study_case_id", "study_patient_id"], list(_E_SPEC.features) + [_E_SPEC.target])
    return df.select(*[r6(c).alias(c) if c in ("age_years", "acha_distance_from_neck_mm") else F.col(c)
                       for c in df.columns])
