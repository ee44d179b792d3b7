"""Cox (Efron) against an independent numpy solver; ordered logit checks."""

import numpy as np
import pandas as pd
import pytest

from strata.operators import iterative


def efron_newton(t, e, X, iters=30):
    n, p = X.shape
    b = np.zeros(p)
    for _ in range(iters):
        w = np.exp(X @ b)
        g, H = np.zeros(p), np.zeros((p, p))
        for tt in np.unique(t[e == 1]):
            risk = t >= tt
            dead = (t == tt) & (e == 1)
            d = dead.sum()
            R0, R1 = w[risk].sum(), (w[risk, None] * X[risk]).sum(0)
            R2 = (w[risk, None, None] * X[risk, :, None] * X[risk, None, :]).sum(0)
            D0, D1 = w[dead].sum(), (w[dead, None] * X[dead]).sum(0)
            D2 = (w[dead, None, None] * X[dead, :, None] * X[dead, None, :]).sum(0)
            g += X[dead].sum(0)
            for l in range(d):
                f = l / d
                c0, c1, c2 = R0 - f * D0, R1 - f * D1, R2 - f * D2
                g -= c1 / c0
                H += c2 / c0 - np.outer(c1, c1) / c0 ** 2
        b = b + np.linalg.solve(H, g)
    return b


def test_cox_efron_matches_numpy(spark):
    rng = np.random.default_rng(7)
    n, p = 300, 2
    X = rng.normal(size=(n, p))
    t = np.round(rng.exponential(np.exp(-X @ np.array([0.7, -0.4]))) * 5).astype(float) + 1  # many ties
    e = (rng.random(n) < 0.7).astype(int)
    pdf = pd.DataFrame(X, columns=["x0", "x1"])
    pdf["time"], pdf["event"] = t, e
    fit = iterative.fit_cox(spark.createDataFrame(pdf), "time", "event", p)
    assert np.allclose(fit.coef, efron_newton(t, e, X), atol=1e-6)


def test_ordinal_gradient_and_fit(spark):
    rng = np.random.default_rng(1)
    p, K, n = 2, 4, 3000
    X = rng.normal(size=(n, p))
    beta, th = np.array([1.0, -0.5]), np.array([-1.0, 0.0, 1.2])
    lat = X @ beta + rng.logistic(size=n)
    y = np.searchsorted(th, lat)
    pdf = pd.DataFrame(X, columns=["x0", "x1"])
    pdf["__cls"] = y
    par = np.array([0.2, 0.1, -0.5, np.log(0.8), np.log(0.9)])
    f0, g0 = iterative._ordinal_terms(pdf, par, p, K)
    num = []
    for i in range(len(par)):
        d = np.zeros_like(par)
        d[i] = 1e-6
        num.append((iterative._ordinal_terms(pdf, par + d, p, K)[0]
                    - iterative._ordinal_terms(pdf, par - d, p, K)[0]) / 2e-6)
    assert np.allclose(num, g0, atol=1e-4)
    df = spark.createDataFrame(pdf.rename(columns={"__cls": "y"}))
    fit = iterative.fit_ordered_logit(df, "y", p)
    assert np.allclose(fit.beta, beta, atol=0.15) and np.allclose(fit.thresholds, th, atol=0.2)
    probs = df.select(*fit.probability_columns(p)).toPandas().to_numpy()
    assert np.allclose(probs.sum(1), 1.0)


def test_ordinal_passes_read_blocks(spark, monkeypatch):
    """Each pass reads the design as blocks, not row by row, with the sums of the rows."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(500, 3)), columns=["x0", "x1", "x2"])
    pdf["y"] = rng.integers(0, 3, 500) * 2                    # classes 0, 2, 4
    kept, keep = [], iterative.materialize
    monkeypatch.setattr(iterative, "materialize", lambda df: kept.append(keep(df)) or kept[-1])
    fit = iterative.fit_ordered_logit(spark.createDataFrame(pdf).repartition(3), "y", 3)
    assert kept[0].count() == 3 and fit.classes == [0, 2, 4]
    got = [(np.frombuffer(r.x).reshape(3, -1).T, np.frombuffer(r.y, np.int32)) for r in kept[0].collect()]
    raw = np.concatenate((fit.beta, fit.thresholds[:1], np.log(np.diff(fit.thresholds))))
    rows = iterative._ordinal_terms(pdf.assign(__cls=pdf["y"] // 2), raw, 3, 3)
    sums = [iterative._ordinal_sums(x, y, raw, 3, 3) for x, y in got]
    assert np.isclose(sum(s[0] for s in sums), rows[0]) and np.isclose(fit.loglik, -rows[0])
    assert np.allclose(sum(s[1] for s in sums), rows[1], atol=1e-8)
