"""Specifications and presets.

Column names, thresholds and rules are parameters of the operators; the
values below are the study presets the operators ship with.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the study definition for equal results)
# ---------------------------------------------------------------------------

# Missing-reason codes, matched exactly (case-sensitive) after trimming.
MISSING_CODES = ("NA", "NR", "ND", "UA", "UNK", "UTA", "IND", "SRC", "LTFU")
# Prefix of codes that are code-like but not supported.
UNSUPPORTED_CODE_PREFIX = "MISS_"
# Suffix of the companion column that keeps the reason a value is missing.
COMPANION_SUFFIX = "__missing_code"

# Identifier columns of the registry (the first four must not be blank).
IDENTIFIER_COLUMNS = ("study_patient_id", "study_case_id", "aneurysm_id",
                      "procedure_id", "linked_original_case_id")
NON_BLANK_IDENTIFIERS = ("study_patient_id", "study_case_id", "aneurysm_id",
                         "procedure_id")
# Prediction-table id columns kept when present.
PREDICTION_ID_COLUMNS = ("study_patient_id", "study_case_id", "aneurysm_id",
                         "procedure_id", "index_year")

GLOBAL_SEED = 2024
OUTER_CV_SPLITS = 5
INNER_CV_SPLITS = 5
N_BOOTSTRAP = 2000
N_PERMUTATIONS = 1000
CONFORMAL_ALPHA = 0.10
LEARNING_CURVE_FRACTIONS = (0.20, 0.40, 0.60, 0.80, 1.00)
DECISION_CURVE_THRESHOLDS = tuple(round(0.10 + 0.01 * i, 2) for i in range(21))
LOGIT_EPS = 1e-6
RISK_TIE_TOL = 1e-8


@dataclass(frozen=True)
class SplitSpec:
    development_start_year: int = 1997
    development_end_year: int = 2020
    temporal_start_year: int = 2021
    temporal_end_year: int = 2026
    expected_total_n: int | None = 687
    expected_development_n: int | None = 564
    expected_temporal_n: int | None = 123
    enforce_counts: bool = True


@dataclass(frozen=True)
class ModelSpec:
    key: str
    target: str
    features: tuple[str, ...]
    eligibility_column: str | None = None
    kind: str = "binary"          # binary | survival | ordinal
    time_column: str | None = None
    event_column: str | None = None
    categorical: tuple[str, ...] = field(default_factory=tuple)


# Study model specifications (targets, eligibility, features).
MODEL_SPECS = {
    "pcoma_c": ModelSpec(
        "pcoma_c", "derived_high_complexity_case",
        ("neck_width_mm", "dome_to_neck_ratio", "pcoa_adherent_to_sac",
         "perforator_origin_from_p1", "parent_ica_curvature_deg",
         "pcoa_incorporated_neck", "aneurysm_max_diameter_mm", "aspect_ratio",
         "parent_ica_tortuosity_index", "distance_to_pcoa_ostium_mm",
         "cn3_grooving_present", "p1_diameter_mm")),
    "pcoma_r": ModelSpec(
        "pcoma_r", "derived_procedure_related_ischemia_flag",
        ("aspect_ratio", "neck_width_mm", "pcoa_incorporated_neck", "p1_diameter_mm",
         "pcoa_adherent_to_sac", "largest_perforator_diameter_mm",
         "pcoa_stretched_over_dome", "perforator_count_estimated",
         "acha_distance_from_neck_mm")),
    "pcoma_o_aft": ModelSpec(
        "pcoma_o_aft", "pcoma_o_time_days",
        ("preop_cn3_duration_days", "cn3_grooving_present",
         "preop_cn3_complete_or_partial", "neck_width_mm", "age_years",
         "pcoa_diameter_mm", "cn3_compression_grade", "preop_cn3_pupil_involvement"),
        eligibility_column="preop_cn3_palsy", kind="survival",
        time_column="pcoma_o_time_days", event_column="pcoma_o_event",
        categorical=("preop_cn3_complete_or_partial", "cn3_compression_grade")),
    "pcoma_o_landmark": ModelSpec(
        "pcoma_o_landmark", "derived_cn3_nonrecovery_12m",
        ("preop_cn3_duration_days", "cn3_grooving_present",
         "preop_cn3_complete_or_partial", "neck_width_mm", "age_years",
         "pcoa_diameter_mm", "cn3_compression_grade", "preop_cn3_pupil_involvement"),
        eligibility_column="preop_cn3_palsy",
        categorical=("preop_cn3_complete_or_partial", "cn3_compression_grade")),
    "pcoma_e_binary": ModelSpec(
        "pcoma_e_binary", "derived_poor_outcome_90d",
        ("rupture_status", "age_years", "preop_nihss_total", "baseline_mrs",
         "admission_gcs_total", "acha_distance_from_neck_mm", "hunt_hess_grade",
         "wfns_grade"),
        eligibility_column="mrs_90d_window_eligible_flag",
        categorical=("rupture_status",)),
    "pcoma_e_ordinal": ModelSpec(
        "pcoma_e_ordinal", "mrs_90d",
        ("rupture_status", "age_years", "preop_nihss_total", "baseline_mrs",
         "admission_gcs_total", "acha_distance_from_neck_mm", "hunt_hess_grade",
         "wfns_grade"),
        eligibility_column="mrs_90d_window_eligible_flag", kind="ordinal",
        categorical=("rupture_status",)),
}

# Scorecard presets: (column, comparison, threshold, points).
SCORECARD_C = (
    ("neck_width_mm", ">=", 4.5, 4),
    ("dome_to_neck_ratio", "<=", 1.91, 3),
    ("pcoa_adherent_to_sac", "==", 1, 3),
    ("perforator_origin_from_p1", "==", 1, 3),
    ("parent_ica_curvature_deg", ">=", 49.7, 3),
    ("pcoa_incorporated_neck", "==", 1, 3),
)
SCORECARD_O = (
    ("preop_cn3_duration_days", ">=", 68.8, 6),
    ("cn3_grooving_present", "==", 1, 5),
    ("preop_cn3_complete_or_partial", "==", "Complete", 4),
    ("neck_width_mm", ">=", 6.3, 3),
    ("age_years", ">=", 58.2, 2),
    ("pcoa_diameter_mm", "<=", 1.15, 2),
)
SCORECARD_E = (
    ("rupture_status", "==", "Ruptured", 6),
    ("age_years", ">=", 59.7, 4),
    ("preop_nihss_total", ">=", 4, 4),
    ("baseline_mrs", ">=", 1, 3),
    ("admission_gcs_total", "<=", 11, 3),
    ("acha_distance_from_neck_mm", "<=", 3.11, 2),
)
# Provisional ischaemia score (0-13); the final 0-17 weights are unresolved.
SCORECARD_R_PROVISIONAL = (
    ("aspect_ratio", "<=", 2.08, 2),
    ("neck_width_mm", ">=", 2.3, 2),
    ("pcoa_incorporated_neck", "==", 1, 2),
    ("p1_diameter_mm", "<=", 2.08, 2),
    ("pcoa_adherent_to_sac", "==", 1, 2),
    ("largest_perforator_diameter_mm", ">=", 1.2, 3),
)

# Composite complexity rule: duration and reposition cut-offs, min components.
COMPOSITE_DURATION_SEC = 600
COMPOSITE_REPOSITIONS = 3
COMPOSITE_MIN_COMPONENTS = 2
# Survival preset: administrative horizon in days.
SURVIVAL_HORIZON_DAYS = 365.0
# Ordinal preset: scale 0-6, poor outcome above 2, assessment window 76-104 days.
ORDINAL_MIN, ORDINAL_MAX, ORDINAL_CUT = 0, 6, 2
ASSESSMENT_WINDOW = (76, 104)

# Model hyper-parameters of the study presets.
BOOSTED_C_R = dict(iterations=1000, learning_rate=0.05, depth=6, max_bins=254)
BOOSTED_LANDMARK = dict(n_estimators=1000, max_depth=6, learning_rate=0.05,
                        subsample=0.8, colsample=0.8)
ELASTIC_NET = dict(C=100.0, l1_ratio=0.5, max_iter=5000)
