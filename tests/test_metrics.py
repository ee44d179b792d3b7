"""Metrics against hand values, brute force and invariants."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import metrics


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def brute_ap(y, p):
    ap, P = 0.0, y.sum()
    for t in np.unique(p)[::-1]:
        sel = p >= t
        tp = (sel & (y == 1)).sum()
        ap += ((p == t) & (y == 1)).sum() / P * tp / sel.sum()
    return ap


def brute_youden(y, p):
    best, thr = -np.inf, 0.5
    for t in np.unique(np.concatenate(([0.0], p, [1.0]))):
        pr = p >= t
        tp, fn = (pr & (y == 1)).sum(), (~pr & (y == 1)).sum()
        tn, fp = (~pr & (y == 0)).sum(), (pr & (y == 0)).sum()
        v = (tp / (tp + fn) if tp + fn else 0.0) + (tn / (tn + fp) if tn + fp else 0.0) - 1.0
        if v > best:
            best, thr = v, float(t)
    return thr


def test_hand_values(spark):
    df = spark.createDataFrame(pd.DataFrame({"p": [.9, .8, .8, .6, .5, .2], "y": [1, 0, 1, 0, 1, 0]}))
    r = metrics.auc_ap(df, [], "y", "p").first()
    assert r.roc_auc == pytest.approx(0.722222, abs=1e-6)
    assert r.pr_auc == pytest.approx(0.755556, abs=1e-6)


@pytest.mark.parametrize("bad", [(None, 1), (float("nan"), 0), (0.4, None), (0.4, 2)])
def test_unrankable_rows_fail(spark, bad):
    rows = [(.9, 1), (.8, 0), (.8, 1), (.6, 0), (.5, 1), (.2, 0), bad]
    df = spark.createDataFrame(rows, "p double, y int")
    for metric in (metrics.auc_ap, metrics.youden_threshold, metrics.roc_points, metrics.decision_curve):
        with pytest.raises(Exception, match="null or NaN score"):
            metric(df, [], "y", "p").collect()


def test_roc_has_its_origin(spark):
    df = spark.createDataFrame([(.9, 1), (.8, 0)], "p double, y int")
    assert (None, 0.0, 0.0) in {tuple(r) for r in metrics.roc_points(df, [], "y", "p").collect()}


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_random_against_brute_force(spark, parts):
    rng = np.random.default_rng(parts)
    rows = []
    for g in range(4):
        n = 150
        p = np.round(rng.random(n), 1)
        y = (rng.random(n) < p).astype(int)
        rows += [(g, float(a), int(b)) for a, b in zip(p, y)]
    pdf = pd.DataFrame(rows, columns=["g", "p", "y"])
    df = spark.createDataFrame(pdf).repartition(parts)
    ra = {r.g: r for r in metrics.auc_ap(df, ["g"], "y", "p").collect()}
    ry = {r.g: r.threshold for r in metrics.youden_threshold(df, ["g"], "y", "p").collect()}
    for g, sub in pdf.groupby("g"):
        y, p = sub.y.to_numpy(), sub.p.to_numpy()
        assert ra[g].roc_auc == pytest.approx(brute_auc(y, p), abs=1e-12)
        assert ra[g].pr_auc == pytest.approx(brute_ap(y, p), abs=1e-12)
        assert ry[g] == brute_youden(y, p)


def test_auc_invariants(spark):
    rng = np.random.default_rng(3)
    p = rng.random(300)
    y = (rng.random(300) < p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y}))
    a = metrics.auc_ap(df, [], "y", "p").first().roc_auc
    b = metrics.auc_ap(df.withColumn("p", 1 - F.col("p")), [], "y", "p").first().roc_auc
    c = metrics.auc_ap(df.withColumn("p", F.col("p") ** 3), [], "y", "p").first().roc_auc
    assert a + b == pytest.approx(1.0, abs=1e-12)
    assert a == pytest.approx(c, abs=1e-12)


def test_bundle_confusion(spark):
    df = spark.createDataFrame(pd.DataFrame({"p": [.9, .8, .8, .6, .5, .2], "y": [1, 0, 1, 0, 1, 0]}))
    r = metrics.binary_metric_bundle(df, [], "y", "p", 0.7).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (2, 1, 2, 1)
    assert r.sensitivity == pytest.approx(2 / 3)
    assert r.mcc == pytest.approx((2 * 2 - 1 * 1) / np.sqrt(3 * 3 * 3 * 3))
    assert r.brier == pytest.approx(np.mean((np.array([.9, .8, .8, .6, .5, .2]) - [1, 0, 1, 0, 1, 0]) ** 2))


def brute_concordance(y, s):
    num = den = 0.0
    for i in range(len(y)):
        for j in range(i + 1, len(y)):
            if y[i] != y[j]:
                den += 1
                d = np.sign(y[j] - y[i]) * np.sign(s[j] - s[i])
                num += 1 if d > 0 else (0.5 if d == 0 else 0)
    return num / den


def brute_qwk(y, yh):
    labs = sorted(set(y) | set(yh))
    pos = {v: i for i, v in enumerate(labs)}
    K = len(labs)
    O = np.zeros((K, K))
    for a, b in zip(y, yh):
        O[pos[a], pos[b]] += 1
    W = np.array([[(i - j) ** 2 for j in range(K)] for i in range(K)], dtype=float)
    E = np.outer(O.sum(1), O.sum(0)) / O.sum()
    return 1 - (W * O).sum() / (W * E).sum()


def test_ordinal_against_brute_force(spark):
    rng = np.random.default_rng(5)
    n = 250
    y = rng.integers(0, 7, n)
    raw = rng.integers(1, 5, (n, 7)).astype(float)
    raw[np.arange(n), y] += 3
    probs = raw / raw.sum(1, keepdims=True)
    pdf = pd.DataFrame(probs, columns=[f"p{k}" for k in range(7)])
    pdf["y"] = y
    df = spark.createDataFrame(pdf)
    r = metrics.ordinal_metric_bundle(df, [], "y", [f"p{k}" for k in range(7)]).first()
    # same left-to-right summation as the operator (a matmul may round
    # differently in the last bit and so change which scores tie)
    es = np.zeros(n)
    for k in range(7):
        es = es + float(k) * probs[:, k]
    am = probs.argmax(1)
    assert r.ordinal_concordance == pytest.approx(brute_concordance(y, es), abs=1e-12)
    assert r.somers_dxy == pytest.approx(2 * brute_concordance(y, es) - 1, abs=1e-12)
    assert r.quadratic_weighted_kappa == pytest.approx(brute_qwk(y, am), abs=1e-12)
    cum = np.cumsum(probs[:, :-1], 1)
    obs = (y[:, None] <= np.arange(6)[None, :]).astype(float)
    assert r.ranked_probability_score == pytest.approx(np.mean(((cum - obs) ** 2).sum(1) / 6), abs=1e-12)
    assert r.average_absolute_ordinal_error == pytest.approx(np.mean(np.abs(y - am)), abs=1e-12)


def test_calibration_and_decision_curve(spark):
    rng = np.random.default_rng(9)
    p = np.round(rng.random(400), 2)
    y = (rng.random(400) < p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y}))
    edges = np.percentile(p, np.linspace(0, 100, 11))
    bins = np.searchsorted(edges[1:-1], p)
    got = {r.bin: (r.n, r.mean_predicted) for r in metrics.calibration_curve(df, [], "y", "p").collect()}
    for b in np.unique(bins):
        assert got[b][0] == (bins == b).sum()
        assert got[b][1] == pytest.approx(p[bins == b].mean())
    dc = {round(r.threshold, 2): r.net_benefit for r in metrics.decision_curve(df, [], "y", "p").collect()}
    t = 0.2
    tp, fp = ((p >= t) & (y == 1)).sum(), ((p >= t) & (y == 0)).sum()
    assert dc[0.2] == pytest.approx(tp / 400 - fp / 400 * t / (1 - t))
