"""Model bundle persistence (S7), locked scoring (M2), logit (C9), sources."""

import math
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import clean, models
from strata.sources import io
from strata.specs import ModelSpec


@pytest.fixture(scope="module")
def cohort(spark):
    rng = np.random.default_rng(3)
    n = 600
    x = rng.normal(size=n)
    cat = rng.choice(["a", "b", "c"], n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.5 * x + (cat == "a"))))).astype(int)
    pdf = pd.DataFrame({"key": [f"r{i}" for i in range(n)], "grp": [f"g{i % 150}" for i in range(n)],
                        "x": np.where(rng.random(n) < 0.05, np.nan, x), "cat": cat, "y": y})
    return spark.createDataFrame(pdf).withColumn("x", F.when(F.isnan("x"), None).otherwise(F.col("x")))


def test_grouped_fit_save_load_and_score(spark, cohort):
    spec = ModelSpec("demo", "y", ("x", "cat"), categorical=("cat",))
    fit = models.train_grouped_binary(cohort, spec, models.elastic_net(), key="key", group="grp", scale=True)
    oof = fit.oof.toPandas()
    assert len(oof) == 600 and oof.key.is_unique and set(oof.fold) == set(range(5))
    assert fit.metrics.first().roc_auc > 0.7
    path = os.path.join(tempfile.mkdtemp(dir="/tmp"), "bundle")
    fit.bundle.save(path)
    loaded = models.BinaryBundle.load(spark, path)
    a = models.score_locked(cohort, fit.bundle, key="key", group="grp")[0].orderBy("key").toPandas()
    b = models.score_locked(cohort, loaded, key="key", group="grp")[0].orderBy("key").toPandas()
    assert np.allclose(a.probability, b.probability) and loaded.threshold == fit.bundle.threshold


def test_logit_clip(spark):
    df = spark.createDataFrame(pd.DataFrame({"p": [0.0, 0.5, 1.0, 0.25]}))
    out = [r.logit_p for r in clean.logit(df, "p").collect()]
    eps = 1e-6
    assert out[1] == 0.0 and out[0] == pytest.approx(math.log(eps / (1 - eps)))
    assert out[2] == pytest.approx(-out[0]) and out[3] == pytest.approx(math.log(1 / 3))


def test_read_raw_keeps_text(spark):
    df = spark.createDataFrame([("NA", "", " 5 "), ("x", "NR", None)], "a string, b string, c string")
    path = os.path.join(tempfile.mkdtemp(dir="/tmp"), "raw")
    io.write_raw(df, path)
    back = sorted(tuple(r) for r in io.read_raw(spark, path, ["a", "b", "c"]).collect())
    assert back == sorted([("NA", "", " 5 "), ("x", "NR", None)])


def test_clean_columns_codes(spark):
    df = spark.createDataFrame([(" NA ", "1", "Ruptured "), ("", "3", "UNK"), ("12.5", "x", "")],
                               "v string, f string, t string")
    out = clean.clean_columns(df, ["v"], ["f"], ["v", "f", "t"]).collect()
    assert [r.v for r in out] == [None, None, 12.5]
    assert [r.v__missing_code for r in out] == ["NA", None, None]
    assert [r.f for r in out] == [1, None, None]
    assert [r.t for r in out] == ["Ruptured", None, None] and out[1].t__missing_code == "UNK"
