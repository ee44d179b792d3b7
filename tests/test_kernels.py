"""Rank kernels and the C-index against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import kernels, survival


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_prefix_sums(spark, buckets):
    rng = np.random.default_rng(buckets)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 200), "k": rng.permutation(200).astype(float),
                        "v": rng.integers(0, 10, 200)})
    out = kernels.prefix_sums(spark.createDataFrame(pdf), ["g"], "k", ["v"], n_buckets=buckets).toPandas()
    pdf = pdf.sort_values(["g", "k"])
    pdf["exp"] = pdf.groupby("g").v.cumsum() - pdf.v
    m = out.merge(pdf, on=["g", "k"])
    assert (m.cum_v == m.exp).all() and len(m) == 200


def test_global_rank_and_quantiles(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 50, 500).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(500), "x": x}))
    r = kernels.global_rank(df, [], "x", tiebreak=["id"], n_buckets=7).toPandas()
    exp = pd.DataFrame({"id": np.arange(500), "x": x}).sort_values(["x", "id"]).reset_index(drop=True)
    exp["rank"] = np.arange(500)
    assert r.merge(exp, on=["id"]).eval("rank_x == rank_y").all()
    qs = [0.1, 0.25, 0.5, 0.9]
    got = {row.q: row.quantile for row in kernels.exact_quantiles(df, [], "x", qs).collect()}
    for q in qs:
        assert got[q] == pytest.approx(np.percentile(x, q * 100))


def test_median_is_exact(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [1.0, 2.0, 4.0, 10.0]}))
    assert kernels.exact_quantiles(df, [], "x", [0.5]).first().quantile == 3.0


def brute_c(t, e, r):
    num = den = 0.0
    for i in range(len(t)):
        if not e[i]:
            continue
        for j in range(len(t)):
            if t[j] > t[i] or (t[j] == t[i] and not e[j]):
                den += 1
                num += 1.0 if r[i] > r[j] else (0.5 if r[i] == r[j] else 0.0)
    return num / den


@pytest.mark.parametrize("buckets", [1, 4, 17])
def test_dominance_pairs(spark, buckets):
    rng = np.random.default_rng(2)
    rows = {(g, float(rng.integers(0, 9) if rng.random() < 0.6 else 4), float(rng.integers(0, 30) if rng.random() < 0.6 else 7))
            for g in range(4) for _ in range(1 if g == 3 else 90)}               # a hot key and a hot value
    pdf = pd.DataFrame([(*r, int(rng.integers(0, 4)), int(rng.integers(1, 5)) * 10 ** 12) for r in sorted(rows)],
                       columns=["g", "k", "v", "q", "w"])
    out = survival.dominance_pairs(spark.createDataFrame(pdf), ["g"], "k", "v", "q", "w", buckets)
    assert dict(out.dtypes)["pairs"] == "decimal(38,0)"
    got = {r.g: int(r.pairs) for r in out.collect()}
    for g, d in pdf.groupby("g"):
        m = d.merge(d, how="cross")
        m = m[(m.k_y > m.k_x) & (m.v_y < m.v_x)]
        assert got[g] == sum(int(q) * int(w) for q, w in zip(m.q_x, m.w_y))
    assert got[3] == 0


def test_pair_counts_beyond_64_bits(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3 * 10 ** 12, 10 ** 12), (2.0, 1.0, 5, 4 * 10 ** 12)], "k double, v double, q long, w long")
    assert int(survival.dominance_pairs(df, [], "k", "v", "q", "w").first().pairs) == 12 * 10 ** 24


@pytest.mark.parametrize("blocks", [2, 5])
def test_cindex(spark, blocks):
    rng = np.random.default_rng(blocks)
    rows = []
    for g in range(5):
        n = 60
        t, e, r = rng.integers(1, 12, n), rng.integers(0, 2, n), rng.integers(0, 6, n) / 2.0
        rows += [(g, float(a), int(b), float(c)) for a, b, c in zip(t, e, r)]
    pdf = pd.DataFrame(rows, columns=["g", "time", "event", "risk"])
    res = {x.g: x.c_index for x in survival.concordance_index(spark.createDataFrame(pdf), ["g"],
                                                              n_blocks=blocks).collect()}
    for g, s in pdf.groupby("g"):
        assert res[g] == pytest.approx(brute_c(s.time.to_numpy(), s.event.to_numpy(), s.risk.to_numpy()), abs=1e-12)


def test_hot_key_gets_own_bucket_and_cindex_stays_exact(spark):
    rng = np.random.default_rng(42)
    n = 600
    t = np.where(rng.random(n) < 1 / 3, 5.0, rng.integers(1, 30, n).astype(float))   # one hot time
    e, r = rng.integers(0, 2, n), rng.integers(0, 40, n) / 4.0
    pdf = pd.DataFrame({"time": t, "event": e, "risk": r})
    df = spark.createDataFrame(pdf)
    splits = kernels.key_splits(df, "time", 8)
    assert 5.0 in splits and float(np.nextafter(5.0, np.inf)) in splits
    got = survival.concordance_index(df, [], n_blocks=8).first().c_index
    assert got == pytest.approx(brute_c(t, e, r), abs=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 40, 257])
def test_dominated_equals_all_pairs(n):
    rng = np.random.default_rng(n)
    k, v = rng.integers(0, max(1, n // 3), n).astype(float), rng.integers(0, max(1, n // 2), n).astype(float)
    q, w = rng.integers(0, 4, n), rng.integers(0, 5, n) * 10 ** 15
    want = sum(int(q[i]) * int(w[j]) for i in range(n) for j in range(n) if k[j] > k[i] and v[j] < v[i])
    assert survival.dominated(k, v, q, w) == want


def test_a_point_moves_at_most_twice_to_be_compared(spark, monkeypatch):
    """Not once per level of a tree over all ranks."""
    df = spark.range(3000).selectExpr("cast(id % 211 as double) k", "cast(id * 7 % 3000 as double) v", "1L q", "1L w").cache()
    seen = []
    real = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a: seen.append(self.count()) or real(self, *a))
    d = df.toPandas()
    want = sum(((d.k > k) & (d.v < v)).sum() for k, v in zip(d.k, d.v))
    assert int(survival.dominance_pairs(df, [], "k", "v", "q", "w", 8).first().pairs) == want
    assert len(seen) == 1 and seen[0] <= 2 * 3000 + 8 * 8
