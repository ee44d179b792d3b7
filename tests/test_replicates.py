"""Bijections and vector-weighted AUC against brute force."""

import numpy as np
import pytest
from strata.operators import resample
from strata.operators.bijection import bijection_constants, halves, positions
from strata.operators.replicates import bootstrap_aucs, permutation_aucs, permuted_positives, vector_auc


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 997, 5000])
def test_every_replicate_is_a_permutation(n):
    a, c = halves(n)
    assert a * c >= n and a * a >= n > (a - 1) * (a - 1)
    got = positions(np.arange(n), np.arange(7), n, bijection_constants(2024, "x"))
    for b in range(7):
        assert sorted(got[:, b].tolist()) == list(range(n))


def test_permutations_look_random():
    n, reps = 400, 300
    got = positions(np.arange(n), np.arange(reps), n, bijection_constants(1, "y"))
    assert abs((got == np.arange(n)[:, None]).sum() / reps - 1) < 0.25          # fixed points: one per permutation
    assert np.abs(got.mean(axis=1) - (n - 1) / 2).max() < 5 * n / np.sqrt(12 * reps)
    corr = [np.corrcoef(got[:, b], got[:, b + 1])[0, 1] for b in range(50)]
    assert np.abs(np.mean(corr)) < 0.05


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_vector_auc_is_exact(spark, parts):
    rnd = np.random.default_rng(3)
    n, reps = 900, 270
    score = np.where(rnd.random(n) < 0.4, 0.5, rnd.integers(0, 60, n) / 60)       # a hot score and many ties
    label = rnd.integers(0, 2, n)
    rows = spark.createDataFrame([(float(s), int(y), k) for k, (s, y) in enumerate(zip(score, label))],
                                 "s double, y int, k long").repartition(parts)

    def weights(keys, which):
        return (keys[:, None] * 31 + which[None] * 17) % 4

    def expand(batch, which):
        y = batch.column("y").to_numpy()[:, None]
        w = weights(batch.column("k").to_numpy(), which)
        return w * y, w * (1 - y)

    got = {r.replicate: r.roc_auc for r in vector_auc(rows, "s", expand, reps).collect()}
    assert sorted(got) == list(range(reps))
    w = weights(np.arange(n), np.arange(reps))
    for b in range(0, reps, 29):
        p, q = w[:, b] * label, w[:, b] * (1 - label)
        wins = sum(p[i] * (q[score < score[i]].sum() + 0.5 * q[score == score[i]].sum()) for i in range(n) if p[i])
        assert got[b] == pytest.approx(wins / (p.sum() * q.sum()), abs=1e-12)


def auc(score, label, w):
    p, q = w * label, w * (1 - label)
    order = np.argsort(score, kind="stable")
    wins = 0.0
    for i in order:
        wins += p[i] * (q[score < score[i]].sum() + 0.5 * q[score == score[i]].sum())
    return wins / (p.sum() * q.sum())


@pytest.fixture(scope="module")
def scored(spark):
    rnd = np.random.default_rng(9)
    rows = [(f"k{i}", f"g{0 if i < 120 else i % 40}", int(rnd.integers(0, 2)), float(rnd.integers(0, 30)) / 30) for i in range(360)]
    return rows, spark.createDataFrame(rows, "key string, g string, y int, s double").repartition(5)


def test_bootstrap_aucs_equal_the_weights_of_each_replicate(scored):
    rows, df = scored
    weights = {}
    for r in resample.cluster_bootstrap(df, "g", "y", 12).collect():
        weights[r.rep, r.g] = r.weight
    got = {r.rep: r.roc_auc for r in bootstrap_aucs(df, "g", "y", "s", 12, resample.GLOBAL_SEED).collect()}
    s, y = np.array([r[3] for r in rows]), np.array([r[2] for r in rows])
    assert len(got) == 12
    for rep, value in got.items():
        assert value == pytest.approx(auc(s, y, np.array([weights.get((rep, r[1]), 0) for r in rows])), abs=1e-12)


def test_permutation_aucs_equal_permuted_labels(scored):
    rows, df = scored
    s = np.array([r[3] for r in rows])
    permuted = {(r.b, r.key): r.y_permuted for r in resample.permute_labels(df, "key", "y", 6).collect()}
    got = {r.replicate: r.roc_auc for r in permutation_aucs(df, "key", "y", "s", 6, resample.GLOBAL_SEED).collect()}
    for r in permuted_positives(df, "key", "y", 6, resample.GLOBAL_SEED).collect():
        hit = [b for b in range(6) if permuted[b, r.key]]
        assert (r.times_positive, r.replicate_sum) == (len(hit), sum(hit))
    for b, value in got.items():
        y = np.array([permuted[b, r[0]] for r in rows])
        assert y.sum() == sum(r[2] for r in rows)
        assert value == pytest.approx(auc(s, y, 1), abs=1e-12)


def test_permuted_column_with_many_values_is_joined(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(300)], "k int, v double")
    many = resample.permute_column(df, "k", "v", 3).collect()
    monkeypatch.setattr(resample, "MAX_LEVELS", 300)
    few = {(r.b, r.k): r.v_permuted for r in resample.permute_column(df, "k", "v", 3).collect()}
    for b in range(3):
        assert sorted(few[b, k] for k in range(300)) == sorted(float(i * i) for i in range(300))
        assert sorted(r.v_permuted for r in many if r.b == b) == sorted(float(i * i) for i in range(300))


def test_same_result_at_any_partitioning(scored):
    _, df = scored
    one = sorted(map(str, resample.permute_labels(df.coalesce(1), "key", "y", 4).collect()))
    assert one == sorted(map(str, resample.permute_labels(df.repartition(17), "key", "y", 4).collect()))


def test_weight_vectors_are_never_broadcast(spark, scored):
    _, df = scored
    plan = bootstrap_aucs(df, "g", "y", "s", 40, resample.GLOBAL_SEED)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "group_idx" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
