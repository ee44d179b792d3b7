"""Replicates solved together against fits of their own."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import many_fits, models, resample, validation
from strata.operators.encode import FoldSafeEncoder
from strata.operators.metrics import auc_ap
from strata.plans import validation_queries
from strata.specs import MODEL_SPECS, N_BOOTSTRAP, N_PERMUTATIONS

from .conftest import SF_SMALL

SPEC = replace(MODEL_SPECS["pcoma_e_binary"], features=("a", "b", "c"), categorical=("c",), target="y", eligibility_column="e")


@pytest.fixture(scope="module")
def cohort(spark):
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(700):
        a, b = float(rnd.integers(0, 40)) / 4 - 3, float(rnd.normal())
        c = ["u", "v", "w"][i % 3]
        y = int(rnd.random() < 1 / (1 + np.exp(-(0.4 * a - b + (c == "v")))))
        rows.append((f"k{i}", f"g{0 if i < 90 else i % 60}", 1, None if i % 7 == 0 else a, None if i % 11 == 3 else b,
                     None if i % 13 == 0 else c, y))
    return spark.createDataFrame(rows, "study_case_id string, study_patient_id string, e int, a double, b double, c string, y int").repartition(3)


def test_the_registered_refits_are_the_studys(spark, monkeypatch):
    seen = {}
    for name in ("bootstrap_optimism", "permutation_test"):
        monkeypatch.setattr(validation, name, lambda df, spec, est, n, name=name: seen.update({name: (est, n)}) or spark.range(1))
    validation_queries.q_bootstrap_optimism_refit(spark, SF_SMALL)
    validation_queries.q_permutation_test_refit(spark, SF_SMALL)
    assert [seen[k][1] for k in ("bootstrap_optimism", "permutation_test")] == [N_BOOTSTRAP, N_PERMUTATIONS]
    assert all(est(100).getMaxIter() == 5000 for est, _ in seen.values())


def test_l1_quadratic_meets_its_conditions():
    rnd = np.random.default_rng(1)
    m = rnd.normal(size=(40, 12, 6))
    a = np.einsum("ski,skj->sij", m, m) / 12
    b, l1 = rnd.normal(size=(40, 6)), np.repeat(rnd.random((40, 1)), 6, 1)
    l1[:, 0] = 0
    x = many_fits.l1_quadratic(a, b, l1, np.zeros((40, 6)))
    grad = np.einsum("sij,sj->si", a, x) - b
    assert (np.abs(grad) <= l1 + 1e-4).all() and np.abs(np.where(x != 0, grad + l1 * np.sign(x), 0)).max() < 1e-4
    assert (x == 0).any() and (x != 0).any()


def own_fit(train, score, estimator, encoder, weight=None):
    """AUCs by Spark's solver, on the training rows and on ``score``."""
    est = estimator(int(train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]))
    keep = ["label", weight] if weight else ["label"]
    rows = encoder.transform_vector(train, keep=keep)
    model = (est.setWeightCol(weight) if weight else est).fit(rows)
    both = []
    for df, w in ((rows, weight), (encoder.transform_vector(score, keep=["label"]), None)):
        both.append(auc_ap(validation._p1(model.transform(df)), [], "label", "probability", weight=w).first().roc_auc)
    return both


def test_bootstrap_refits_equal_fits_of_their_own(cohort, monkeypatch):
    monkeypatch.setattr(many_fits, "GROUP_ROWS", 40)                   # the large group is dealt over tasks
    monkeypatch.setattr(many_fits, "BLOCK_ROWS", 32)
    estimator = models.elastic_net(C=0.05)
    rows = models.model_rows(cohort, SPEC, "study_case_id", "study_patient_id").cache()
    encoder = FoldSafeEncoder(["a", "b"], ["c"])
    design = validation._many(rows, SPEC, estimator)
    apparent, found = many_fits.bootstrap_refits(rows, encoder, design, estimator.penalty, 5000, "study_patient_id", 4, resample.GLOBAL_SEED)
    weights = resample.cluster_bootstrap(rows.withColumn("label", F.col("label").cast("int")), "study_patient_id", "label", 4).cache()
    for rep, own, every in found[:1]:
        drawn = rows.join(weights.filter(F.col("rep") == rep), "study_patient_id")
        want = own_fit(drawn, rows, estimator, encoder.fit(drawn, "weight"), "weight")
        assert (own, every) == pytest.approx(want, abs=2e-4)
    assert len(found) == 4 and apparent > 0.6


def test_weighted_encoders_equal_the_encoders(cohort):
    rows = models.model_rows(cohort, SPEC, "study_case_id", "study_patient_id").withColumn("label", F.col("label").cast("int")).cache()
    encoder = FoldSafeEncoder(["a", "b"], ["c"])
    design = many_fits.Design.of(rows, ["a", "b"], ["c"])
    reps, groups, n = resample.valid_replicates(rows, "study_patient_id", "label", 3)
    packed = many_fits._with_vectors(rows, design, "study_patient_id", reps, groups, n, resample.GLOBAL_SEED)
    got = many_fits.weighted_encoders(packed, design, encoder)
    weights = resample.cluster_bootstrap(rows, "study_patient_id", "label", 3)
    for rep, model in zip(reps, got, strict=False):
        assert model == encoder.fit(rows.join(weights.filter(F.col("rep") == rep), "study_patient_id"), "weight")
    assert got[-1] == encoder.fit(rows)


def test_permutation_refits_equal_fits_of_their_own(cohort, monkeypatch):
    monkeypatch.setattr(many_fits, "BUCKET_ROWS", 100)                 # several score ranges
    monkeypatch.setattr(many_fits, "BLOCK_ROWS", 64)
    short, full = models.elastic_net(), models.elastic_net()
    short.penalty = None                                               # each one by Spark's solver
    want = validation.permutation_test(cohort, SPEC, short, 2, k=2).first()
    got = validation.permutation_test(cohort, SPEC, full, 2, k=2).first()
    assert got.permutations == 2 and got.p_value == want.p_value
    for name in ("baseline_grouped_oof_auc", "permuted_auc_mean", "permuted_auc_sd"):
        assert got[name] == pytest.approx(want[name], abs=5e-4)
