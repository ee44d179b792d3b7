"""Resampling invariants, the fold-safe encoder, conformal quantile."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import resample, uncertainty
from strata.operators.encode import FoldSafeEncoder


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(11)
    groups = rng.integers(0, 120, 900)
    y = (rng.random(900) < 0.3).astype(int)
    pdf = pd.DataFrame({"key": [f"k{i}" for i in range(900)], "g": [f"g{x}" for x in groups], "y": y})
    return spark.createDataFrame(pdf)


def test_folds_keep_groups_whole_and_balanced(grouped):
    d = resample.assign_folds(grouped, "g", "y", k=5)
    assert resample.fold_findings(d, "g").first().n == 0
    sizes = [r["count"] for r in d.groupBy("fold").agg(F.countDistinct("g").alias("count")).collect()]
    assert max(sizes) - min(sizes) <= len(sizes)  # round robin within each profile


def test_bootstrap_weights(grouped):
    w = resample.cluster_bootstrap(grouped, "g", "y", 7)
    G = grouped.select("g").distinct().count()
    per = {r.rep: r.s for r in w.groupBy("rep").agg(F.sum("weight").alias("s")).collect()}
    assert len(per) == 7 and all(v == G for v in per.values())


def test_permutation_is_a_permutation(grouped):
    p = resample.permute_labels(grouped, "key", "y", 3).toPandas()
    base = grouped.toPandas()
    for b, sub in p.groupby("b"):
        assert len(sub) == len(base) and sorted(sub.y_permuted) == sorted(base.y)
        assert sub.key.nunique() == len(base)


def test_nested_subsets(grouped):
    s = resample.nested_group_subsets(grouped, "g", "y").orderBy("fraction").toPandas()
    G = grouped.select("g").distinct().count()
    assert list(s.n_groups) == [max(2, math.ceil(f * G)) for f in (0.2, 0.4, 0.6, 0.8, 1.0)]
    assert (s.n_rows.diff().dropna() >= 0).all() and s.n_rows.iloc[-1] == 900
    small = resample.subset_rows(grouped, "g", 0.2)
    big = resample.subset_rows(grouped, "g", 0.4)
    assert small.join(big, "key", "left_anti").count() == 0


def test_encoder_fit_only_on_training_rows(spark):
    train = spark.createDataFrame(pd.DataFrame({"x": [1.0, 2.0, 4.0, 10.0, None], "c": ["b", "a", "b", None, "a"]}))
    model = FoldSafeEncoder(["x"], ["c"], scale=True).fit(train)
    assert model.medians["x"] == 3.0 and model.modes["c"] == "a"          # exact median, tie -> smallest
    assert model.categories["c"] == ["a", "b"] and model.indicators == ["x"]
    other = spark.createDataFrame(pd.DataFrame({"x": [100.0, None], "c": ["z", None]}))
    out = model.transform(other).toPandas()
    assert list(out["categorical__c_a"]) == [0.0, 1.0] and list(out["categorical__c_b"]) == [0.0, 0.0]
    # statistics do not move when other (validation) rows change
    again = FoldSafeEncoder(["x"], ["c"], scale=True).fit(train)
    assert again.to_json() == model.to_json()
    imp = np.array([1.0, 2.0, 4.0, 10.0, 3.0])
    assert model.means["numeric__x"] == pytest.approx(imp.mean())
    assert model.sds["numeric__x"] == pytest.approx(imp.std())                 # population sd


def test_conformal_quantile_index(spark):
    rng = np.random.default_rng(4)
    s = np.round(rng.random(564), 3)
    df = spark.createDataFrame(pd.DataFrame({"nonconformity": s}))
    q = uncertainty.conformal_quantile(df, alpha=0.10).first()
    n = 564
    level = min(1.0, np.ceil((n + 1) * (1 - 0.10)) / n)
    assert q.qhat == float(np.quantile(s, level, method="higher"))
    assert q.qhat == float(np.sort(s)[509])


def test_prediction_sets(spark):
    df = spark.createDataFrame(pd.DataFrame({"probability": [0.9, 0.5, 0.05], "observed": [1, 0, 1]}))
    out = uncertainty.prediction_sets(df, 0.2).toPandas()
    assert list(out.include_class_1) == [1, 0, 0] and list(out.include_class_0) == [0, 1, 1]
    assert list(out.prediction_set_size) == [1, 1, 1]


def test_permutation_importance_permutes_each_feature(spark):
    from strata.operators import explain
    rng = np.random.default_rng(8)
    n = 400
    pdf = pd.DataFrame({"key": [f"k{i}" for i in range(n)], "a": rng.normal(size=n), "b": rng.normal(size=n)})
    pdf["label"] = (pdf.a + 0.1 * rng.normal(size=n) > 0).astype(int)
    df = spark.createDataFrame(pdf)
    predict = lambda d: d.withColumn("probability", F.lit(1.0) / (1 + F.exp(-3 * F.col("a"))))
    out = {r.feature: r.mean_auc_drop for r in explain.permutation_importance(
        df, predict, ["a", "b"], "label", "key", n_repeats=3).collect()}
    assert out["a"] > 0.3 and abs(out["b"]) < 1e-12
