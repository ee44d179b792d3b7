"""Endpoint rules: the reference's unit tests plus truth tables."""

import itertools

import pytest
from pyspark.sql import functions as F

from strata.operators import labels


def _rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_composite_rule_examples(spark):
    # two components; reposition >= 3; flow rescue -> all high complexity
    df = _rows(spark, [(1, 1, 0.0, 0, 0, 0), (0, 0, 0.0, 3, 0, 0), (0, 0, 0.0, 0, 1, 0)],
               "pcoma_c_exposure_component int, pcoma_c_reconstruction_component int, "
               "temporary_clip_cumulative_sec double, clip_reposition_count int, "
               "flow_rescue_manoeuvre_flag int, rupture_escalation_flag int")
    out = [r.derived_high_complexity_case for r in labels.composite_label(df).collect()]
    assert out == [1, 1, 1]


def test_composite_truth_table(spark):
    combos = list(itertools.product([0, 1], repeat=6))
    data = [(c1, c2, 601.0 if c3 else 600.0, 3 if c4 else 2, c5, c6) for c1, c2, c3, c4, c5, c6 in combos]
    df = _rows(spark, data, "pcoma_c_exposure_component int, pcoma_c_reconstruction_component int, "
                            "temporary_clip_cumulative_sec double, clip_reposition_count int, "
                            "flow_rescue_manoeuvre_flag int, rupture_escalation_flag int")
    got = [(r.pcoma_c_component_count, r.derived_high_complexity_case) for r in labels.composite_label(df).collect()]
    exp = [(sum(c), int(sum(c) >= 2 or c[3] == 1 or c[4] == 1)) for c in combos]
    assert got == exp


def test_missing_outcome_stays_missing(spark):
    df = _rows(spark, [(0,), (3,), (None,)], "mrs_90d int")
    out = [r.derived_poor_outcome_90d for r in labels.thresholded_ordinal_label(df).collect()]
    assert out == [0, 1, None]


def test_missing_sources_raise(spark):
    df = _rows(spark, [(0.0,)], "temporary_clip_cumulative_sec double")
    with pytest.raises(labels.EndpointDefinitionError):
        labels.composite_label(df)


def test_supplied_label_fallback(spark):
    df = _rows(spark, [(1,), (0,)], "derived_high_complexity_case int")
    out = [r.derived_high_complexity_case for r in labels.composite_label(df).collect()]
    assert out == [1, 0]


def test_adjudicated_null_patterns(spark):
    cols = labels.ADJUDICATED_SOURCES
    base = dict.fromkeys(cols, 0)
    cases = []
    # deficit alone -> 1; imaging+concordant -> 1; exclusion vetoes; indeterminate -> null; any null -> null
    for upd in ({"new_postop_ischaemic_deficit_flag": 1},
                {"new_postop_dwi_lesion_flag": 1, "lesion_anatomically_concordant_flag": 1},
                {"new_postop_ischaemic_deficit_flag": 1, "venous_infarction_flag": 1},
                {"new_postop_ischaemic_deficit_flag": 1, "ischaemia_mechanism_indeterminate_flag": 1},
                {"new_postop_ct_hypodensity_flag": None},
                {}):
        row = dict(base)
        row.update(upd)
        cases.append(tuple(row[c] for c in cols))
    df = _rows(spark, cases, ", ".join(f"{c} int" for c in cols))
    out = [r.derived_procedure_related_ischemia_flag for r in labels.adjudicated_label(df).collect()]
    assert out == [1, 1, 0, None, None, 0]


def test_survival_censoring_grid(spark):
    # palsy, event, recovery, last, died, death_time -> (event, time, nonrecovery)
    data = [(1, 1, 40.0, 50.0, 0, None), (1, 0, None, 200.0, 0, None), (1, 0, None, 500.0, 0, None),
            (1, 0, None, 200.0, 1, 90.0), (1, 0, None, -1.0, 0, None), (0, 1, 40.0, 50.0, 0, None),
            (1, 1, 400.0, 50.0, 0, None), (1, 0, None, 200.0, None, 10.0)]
    df = _rows(spark, data, "preop_cn3_palsy int, cn3_complete_recovery_12m int, "
                            "time_to_complete_recovery_days double, cn3_last_assessment_days double, "
                            "death_before_cn3_recovery int, death_time_days double")
    got = [(r.pcoma_o_event, r.pcoma_o_time_days, r.derived_cn3_nonrecovery_12m)
           for r in labels.survival_fields(df).collect()]
    assert got == [(1, 40.0, 0), (0, 200.0, 1), (0, 365.0, 1), (0, 90.0, 1), (0, 365.0, 1),
                   (None, None, None), (None, None, 0), (0, 200.0, 1)]
    f = {r.finding: r.n for r in labels.survival_findings(df).collect()}
    assert f["survival_event_time"] == 1


def test_label_concordance(spark):
    df = _rows(spark, [("a", 1, 0), ("b", 1, 1), ("c", 0, 1), ("d", None, 1)], "k string, s int, d int")
    r = labels.label_concordance(df, "s", "d", "k").first()
    assert (r.n_mismatch, r.first_keys) == (2, "a,c")


def test_label_concordance_reads_the_rows_once(spark, tmp_path):
    rows = [(None if k % 50 == 49 else f"k{k:03}", k % 2, 1 - k % 2) for k in range(200)] + [("k000", 0, 1)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = _rows(spark, rows, "k string, s int, d int").repartition(5).mapInArrow(count, "k string, s int, d int")
    r = labels.label_concordance(df, "s", "d", "k").first()
    assert (r.n_mismatch, r.first_keys) == (201, "k000,k000,k001,k002,k003,k004")      # null keys come first
    assert seen.value == len(rows)
