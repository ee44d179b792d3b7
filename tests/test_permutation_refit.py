"""The refit permutation test moves its rows once per permutation, not once per training fold."""

from strata.operators import models, validation


def test_a_permutation_joins_labels_once(spark, monkeypatch):
    spec = validation_spec()
    rows = spark.range(120).selectExpr(
        "cast(id as string) as study_case_id", "cast(id % 40 as string) as study_patient_id", "1 as e",
        "cast(id % 11 as double) as a", "concat('c', id % 3) as c", "cast(id % 11 + id % 3 > 6 as int) as y")
    joins = []
    real = validation._oof_auc

    def spy(encoded, estimator, *rest):
        joins.extend("Join" in x._jdf.queryExecution().optimizedPlan().toString() for x in encoded)
        assert not rest
        return real(encoded, estimator)

    monkeypatch.setattr(validation, "_oof_auc", spy)
    out = validation.permutation_test(rows, spec, models.elastic_net(max_iter=5), 2, k=2).first()
    assert joins == [False] * 6                      # base and two permutations, two folds each
    assert out.permutations == 2 and 0.5 < out.baseline_grouped_oof_auc <= 1 and out.permuted_auc_mean < out.baseline_grouped_oof_auc


def validation_spec():
    from dataclasses import replace

    from strata.specs import MODEL_SPECS
    return replace(MODEL_SPECS["pcoma_e_binary"], features=("a", "c"), categorical=("c",), target="y", eligibility_column="e")
