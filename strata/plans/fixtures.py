"""Stand-in cohort tables derived from the driver's TPC-H-like tables.

The study registry holds private rows, so the operators are exercised on
tables Spark derives from ``orders`` and ``lineitem``: one line item = one
treatment episode, the customer = the patient, the order year = the index
year.  Missing values and missing-reason codes are made by rules on the key.

Each derived column is one SQL expression that both Spark (``selectExpr``)
and DuckDB evaluate the same way, so the DuckDB oracle for every query can
start from the very same stand-in (``REGISTRY_SQL`` / ``RAW_SQL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Days between order and shipment, per dialect (the rest is shared SQL).
_DAYS_SPARK = "datediff(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE))"
_DAYS_DUCK = "datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"

# Registry stand-in: (column, shared SQL expression).  ``{days}`` is the
# per-dialect day difference.
REGISTRY_COLUMNS = (
    ("study_patient_id", "CAST(o_custkey AS STRING)"),
    # (order, line) repeats in this data; with part and supplier it is unique
    ("study_case_id", "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' "
                      "|| CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"),
    ("index_year", "CAST(year(o_orderdate) AS INT)"),
    ("age_years", "CAST(18 + l_partkey % 83 AS DOUBLE)"),
    ("sex_at_birth", "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END"),
    ("rupture_status", "CASE WHEN o_orderstatus = 'F' THEN 'Ruptured' ELSE 'Unruptured' END"),
    ("aneurysm_max_diameter_mm", "CAST(l_quantity / 2.0 + l_linenumber AS DOUBLE)"),
    ("neck_width_mm", "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_quantity / 5.0 AS DOUBLE) END"),
    ("dome_to_neck_ratio", "CAST(l_extendedprice / 25000.0 AS DOUBLE)"),
    ("aspect_ratio", "CAST(l_suppkey % 40 AS DOUBLE) / 10.0"),
    ("pcoa_diameter_mm", "CAST(o_custkey % 30 AS DOUBLE) / 10.0"),
    ("p1_diameter_mm", "CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE CAST(l_partkey % 50 AS DOUBLE) / 10.0 END"),
    ("pcoa_incorporated_neck", "CASE WHEN l_tax >= 0.04 THEN 1 ELSE 0 END"),
    ("pcoa_adherent_to_sac", "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"),
    ("pcoa_stretched_over_dome", "CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 0 END"),
    ("acha_distance_from_neck_mm", "CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(l_discount * 60.0 AS DOUBLE) END"),
    ("perforator_count_estimated", "CAST(l_suppkey % 7 AS DOUBLE)"),
    ("largest_perforator_diameter_mm", "CAST(l_tax * 25.0 AS DOUBLE)"),
    ("perforator_origin_from_p1", "CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END"),
    ("parent_ica_curvature_deg", "CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(l_discount * 1000.0 AS DOUBLE) END"),
    ("parent_ica_tortuosity_index", "CAST(l_partkey % 17 AS DOUBLE) / 4.0"),
    ("distance_to_pcoa_ostium_mm", "CAST(l_suppkey % 23 AS DOUBLE) / 3.0"),
    ("cn3_grooving_present", "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END"),
    ("cn3_compression_grade", "CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE substr(o_orderpriority, 1, 1) END"),
    ("preop_cn3_palsy", "CASE WHEN {days} > 0 THEN 1 ELSE 0 END"),
    ("preop_cn3_complete_or_partial", "CASE l_orderkey % 3 WHEN 0 THEN 'Complete' WHEN 1 THEN 'Partial' ELSE 'None' END"),
    ("preop_cn3_duration_days", "CAST(l_partkey % 120 AS DOUBLE)"),
    ("preop_cn3_pupil_involvement", "CASE WHEN l_partkey % 4 = 0 THEN 1 ELSE 0 END"),
    ("baseline_mrs", "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE CAST(o_custkey % 4 AS INT) END"),
    ("preop_nihss_total", "CAST(l_suppkey % 10 AS INT)"),
    ("admission_gcs_total", "CAST(3 + l_partkey % 13 AS INT)"),
    ("hunt_hess_grade", "CAST(l_partkey % 6 AS INT)"),
    ("wfns_grade", "CAST(l_suppkey % 6 AS INT)"),
    ("pcoma_c_exposure_component", "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END"),
    ("pcoma_c_reconstruction_component", "CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END"),
    ("temporary_clip_cumulative_sec", "CAST(l_extendedprice / 50.0 AS DOUBLE)"),
    ("clip_reposition_count", "CAST(l_linenumber - 1 AS INT)"),
    ("flow_rescue_manoeuvre_flag", "CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END"),
    ("rupture_escalation_flag", "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END"),
    ("derived_high_complexity_case", "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END"),
    ("new_postop_dwi_lesion_flag", "CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_tax >= 0.06 THEN 1 ELSE 0 END"),
    ("new_postop_ct_hypodensity_flag", "CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_discount <= 0.01 THEN 1 ELSE 0 END"),
    ("new_postop_ischaemic_deficit_flag", "CASE WHEN l_partkey % 9 = 0 THEN 1 ELSE 0 END"),
    ("lesion_anatomically_concordant_flag", "CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END"),
    ("preexisting_infarct_flag", "CASE WHEN l_suppkey % 17 = 0 THEN 1 ELSE 0 END"),
    ("delayed_cerebral_ischaemia_flag", "CASE WHEN l_partkey % 23 = 0 THEN 1 ELSE 0 END"),
    ("vasospasm_related_infarct_flag", "CASE WHEN o_custkey % 29 = 0 THEN 1 ELSE 0 END"),
    ("venous_infarction_flag", "CASE WHEN l_suppkey % 31 = 0 THEN 1 ELSE 0 END"),
    ("nonprocedural_embolic_lesion_flag", "CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END"),
    ("ischaemia_mechanism_indeterminate_flag", "CASE WHEN l_orderkey % 43 = 0 THEN 1 ELSE 0 END"),
    ("time_to_complete_recovery_days",
     "CASE WHEN l_linestatus = 'F' AND {days} BETWEEN 1 AND 365 THEN CAST({days} AS DOUBLE) ELSE NULL END"),
    ("cn3_last_assessment_days", "CAST({days} AS DOUBLE)"),
    ("cn3_complete_recovery_12m",
     "CASE WHEN l_linestatus = 'F' AND {days} BETWEEN 1 AND 365 THEN 1 ELSE 0 END"),
    ("death_before_cn3_recovery", "CASE WHEN l_suppkey % 13 = 0 THEN 1 ELSE 0 END"),
    ("death_time_days", "CAST(l_partkey % 400 AS DOUBLE)"),
    ("mrs_90d", "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber - 1 AS INT) END"),
    ("mrs_90d_assessment_day", "CAST(60 + l_partkey % 60 AS DOUBLE)"),
)

# Raw all-text intake stand-in (one row per order) with missing-reason codes,
# blanks, junk and out-of-domain values made by rules on the key.
RAW_COLUMNS = (
    ("study_patient_id", "CAST(o_custkey AS STRING)"),
    ("study_case_id", "CAST(o_orderkey AS STRING)"),
    ("aneurysm_id", "'A' || CAST(o_orderkey AS STRING)"),
    ("procedure_id", "CASE WHEN o_orderkey % 101 = 0 THEN '  ' ELSE 'P' || CAST(o_orderkey AS STRING) END"),
    ("linked_original_case_id", "CASE WHEN o_orderkey % 97 = 0 THEN 'NR' ELSE '' END"),
    ("index_case_flag",
     "CASE WHEN o_orderkey % 53 = 0 THEN '2' WHEN o_orderkey % 59 = 0 THEN 'x' "
     "WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END"),
    ("index_year", "CAST(year(o_orderdate) AS STRING)"),
    ("age_years",
     "CASE WHEN o_orderkey % 17 = 0 THEN 'NR' WHEN o_orderkey % 23 = 0 THEN ' NA ' "
     "WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 31 = 0 THEN 'abc' "
     "ELSE ' ' || CAST(18 + o_custkey % 80 AS STRING) END"),
    ("neck_width_mm",
     "CASE WHEN o_orderkey % 19 = 0 THEN 'UNK' WHEN o_orderkey % 47 = 0 THEN 'MISS_7' "
     "ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 1000 AS STRING) END"),
    ("pcoa_incorporated_neck",
     "CASE WHEN o_orderkey % 43 = 0 THEN 'UNK' WHEN o_orderkey % 61 = 0 THEN '3' "
     "WHEN o_orderpriority LIKE '1%' THEN '1' ELSE '0' END"),
    ("rupture_status",
     "CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN 'ND' "
     "WHEN o_orderstatus = 'F' THEN ' Ruptured' ELSE 'Unruptured ' END"),
    ("cn3_compression_grade",
     "CASE WHEN o_orderkey % 37 = 0 THEN 'NA' WHEN o_orderkey % 7 = 0 THEN 'na' ELSE o_orderpriority END"),
)
RAW_ID_COLUMNS = ("study_patient_id", "study_case_id", "aneurysm_id", "procedure_id",
                  "linked_original_case_id")
RAW_NUMERIC = ("index_year", "age_years", "neck_width_mm")
RAW_BINARY = ("index_case_flag", "pcoa_incorporated_neck")
RAW_TEXT = ("study_patient_id", "study_case_id", "aneurysm_id", "procedure_id",
            "linked_original_case_id", "rupture_status", "cn3_compression_grade")
RAW_TRACKED = ("linked_original_case_id", "index_case_flag", "age_years", "neck_width_mm",
               "pcoa_incorporated_neck", "rupture_status", "cn3_compression_grade")


def _exprs(columns, days: str):
    return [f"{expr.format(days=days)} AS {name}" for name, expr in columns]


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode-level stand-in: lineitem joined to its order (shuffle join on
    the order key; both sides grow with the data)."""
    return registry_from(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def registry_from(li: DataFrame, od: DataFrame) -> DataFrame:
    """Same stand-in from given frames (e.g. a line-item stream joined to
    the static orders table)."""
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return joined.selectExpr(*_exprs(REGISTRY_COLUMNS, _DAYS_SPARK))


def raw_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text intake stand-in, one row per order."""
    return table(spark, sf_dir, "orders").selectExpr(*_exprs(RAW_COLUMNS, _DAYS_SPARK))


def _cte(columns, source: str) -> str:
    return "SELECT " + ", ".join(_exprs(columns, _DAYS_DUCK)) + " FROM " + source


REGISTRY_SQL = _cte(REGISTRY_COLUMNS, "lineitem JOIN orders ON l_orderkey = o_orderkey")
RAW_SQL = _cte(RAW_COLUMNS, "orders")


def with_ctes(body: str, *names: str) -> str:
    """Prefix a DuckDB query with the stand-in CTEs it needs."""
    defs = {"registry": REGISTRY_SQL, "raw": RAW_SQL}
    parts = [f"{n} AS ({defs[n]})" for n in names]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary prediction stand-in on orders: a formula score with ties
    (3 decimals), the observed class, the entity and the period."""
    od = table(spark, sf_dir, "orders")
    return od.selectExpr(*PREDICTION_EXPRS)


PREDICTION_EXPRS = (
    "CAST(o_orderkey AS STRING) AS study_case_id",
    "CAST(o_custkey AS STRING) AS study_patient_id",
    "CAST(year(o_orderdate) AS INT) AS index_year",
    "CASE WHEN year(o_orderdate) <= 1998 THEN 'development' ELSE 'temporal' END AS split",
    "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS observed",
    "o_orderpriority AS priority",
    # integer numerator / 1000.0: identical IEEE result in both engines, many ties
    "CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 600 "
    "+ CASE WHEN o_orderstatus = 'F' THEN 250 ELSE 0 END "
    "+ CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 100 END AS DOUBLE) / 1000.0 AS probability",
)
PREDICTIONS_SQL = "SELECT " + ", ".join(PREDICTION_EXPRS) + " FROM orders"


def with_predictions(body: str) -> str:
    return f"WITH preds AS ({PREDICTIONS_SQL})\n{body}"
