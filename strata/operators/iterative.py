"""Custom iterative fits (M6-M8 ordered logit, M11 Cox proportional hazards).

Each iteration is one distributed pass over a checkpointed design table:
Spark aggregates (Cox: per-time sums, reverse prefix sums over time) or
per-partition numpy partial sums (``mapInPandas``) produce the
log-likelihood, gradient and Hessian; only those p-sized numbers reach the
driver, which takes the Newton / quasi-Newton step.  The coefficient vector
is broadcast back as literals, so lineage does not grow across iterations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import materialize, prefix_sums


MAX_LEVELS = 100


class ConvergenceError(RuntimeError):
    pass


def design(df: DataFrame, features_col: str, p: int, keep: Sequence[str]) -> DataFrame:
    """Vector column -> x0..x{p-1} double columns (checkpointed once)."""
    arr = vector_to_array(features_col)
    return materialize(df.select(*keep, *[arr[i].alias(f"x{i}") for i in range(p)]))


# ---------------------------------------------------------------------------
# Cox proportional hazards, Efron ties
# ---------------------------------------------------------------------------

@dataclass
class CoxFit:
    coef: np.ndarray
    se: np.ndarray
    loglik: float
    iterations: int
    converged: bool

    def linear_predictor(self, p: int) -> Column:
        lp = F.lit(0.0)
        for i in range(p):
            lp = lp + F.lit(float(self.coef[i])) * F.col(f"x{i}")
        return lp


def _cox_terms(rows: pd.DataFrame, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Efron contributions of a batch of event times (risk-set sums given)."""
    ll, g, H = 0.0, np.zeros(p), np.zeros((p, p))
    tri = [(i, j) for i in range(p) for j in range(i, p)]
    for r in rows.itertuples(index=False):
        d = int(r.d)
        if d == 0:
            continue
        R0, D0 = r.R0, r.D0
        R1 = np.array([getattr(r, f"R1_{i}") for i in range(p)])
        D1 = np.array([getattr(r, f"D1_{i}") for i in range(p)])
        R2, D2 = np.zeros((p, p)), np.zeros((p, p))
        for i, j in tri:
            R2[i, j] = R2[j, i] = getattr(r, f"R2_{i}_{j}")
            D2[i, j] = D2[j, i] = getattr(r, f"D2_{i}_{j}")
        S = np.array([getattr(r, f"S_{i}") for i in range(p)])
        phi = np.arange(d) / d
        c0 = R0 - phi * D0                                   # d Efron denominators
        # sums over the d tied events reduce to five scalars (no loop over l):
        # sum c1/c0 = R1 s1 - D1 sp1;  sum c2/c0 = R2 s1 - D2 sp1;
        # sum c1 c1'/c0^2 = R1R1' s2 - (R1D1' + D1R1') sp2 + D1D1' spp2
        s1, sp1 = (1 / c0).sum(), (phi / c0).sum()
        s2, sp2, spp2 = (1 / c0 ** 2).sum(), (phi / c0 ** 2).sum(), (phi ** 2 / c0 ** 2).sum()
        ll += r.SLP - np.log(c0).sum()
        g += S - (R1 * s1 - D1 * sp1)
        RD = np.outer(R1, D1)
        H += (R2 * s1 - D2 * sp1) - (np.outer(R1, R1) * s2 - (RD + RD.T) * sp2 + np.outer(D1, D1) * spp2)
    return ll, g, H


def fit_cox(df: DataFrame, time: str, event: str, p: int, max_iter: int = 30,
            tol: float = 1e-9) -> CoxFit:
    """Cox PH by Newton-Raphson with Efron's tie correction.

    ``df`` holds time, event and x0..x{p-1} (see :func:`design`).  Per
    iteration: per distinct time the sums of e^{xb}, x e^{xb}, x x' e^{xb}
    over all rows and over the events; reverse prefix sums over time give
    the risk sets (bucketed X1 kernel, no single-task window); the Efron
    terms of each event time are added per partition; the driver solves."""
    spark = df.sparkSession
    tri = [(i, j) for i in range(p) for j in range(i, p)]
    beta = np.zeros(p)
    ll_old, it, converged = -np.inf, 0, False
    H = np.eye(p)
    ll = -np.inf
    for it in range(1, max_iter + 1):
        lp = F.lit(0.0)
        for i in range(p):
            lp = lp + F.lit(float(beta[i])) * F.col(f"x{i}")
        w = F.exp(lp)
        ev = F.col(event) == 1
        aggs = [F.sum(w).alias("A0"), F.count(F.when(ev, 1)).alias("d"), F.sum(F.when(ev, w)).alias("D0"),
                F.sum(F.when(ev, lp)).alias("SLP")]
        aggs += [F.sum(w * F.col(f"x{i}")).alias(f"A1_{i}") for i in range(p)]
        aggs += [F.sum(F.when(ev, w * F.col(f"x{i}"))).alias(f"D1_{i}") for i in range(p)]
        aggs += [F.sum(F.when(ev, F.col(f"x{i}"))).alias(f"S_{i}") for i in range(p)]
        aggs += [F.sum(w * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"A2_{i}_{j}") for i, j in tri]
        aggs += [F.sum(F.when(ev, w * F.col(f"x{i}") * F.col(f"x{j}"))).alias(f"D2_{i}_{j}") for i, j in tri]
        per_t = materialize(df.groupBy(F.col(time).cast("double").alias("t")).agg(*aggs).na.fill(0.0))
        sums = ["A0"] + [f"A1_{i}" for i in range(p)] + [f"A2_{i}_{j}" for i, j in tri]
        rs = prefix_sums(per_t, [], "t", sums, inclusive=True, prefix="R", descending=True, materialized=True)
        rs = rs.withColumnRenamed("RA0", "R0")
        for i in range(p):
            rs = rs.withColumnRenamed(f"RA1_{i}", f"R1_{i}")
        for i, j in tri:
            rs = rs.withColumnRenamed(f"RA2_{i}_{j}", f"R2_{i}_{j}")
        out_schema = "ll double, " + ", ".join([f"g{i} double" for i in range(p)]
                                               + [f"h{i}_{j} double" for i in range(p) for j in range(p)])

        def part(batches):
            tot_ll, tot_g, tot_H = 0.0, np.zeros(p), np.zeros((p, p))
            for pdf in batches:
                a, b, c = _cox_terms(pdf, p)
                tot_ll, tot_g, tot_H = tot_ll + a, tot_g + b, tot_H + c
            row = {"ll": [tot_ll], **{f"g{i}": [tot_g[i]] for i in range(p)},
                   **{f"h{i}_{j}": [tot_H[i, j]] for i in range(p) for j in range(p)}}
            yield pd.DataFrame(row)

        parts = rs.filter(F.col("d") > 0).mapInPandas(part, out_schema).agg(
            *[F.sum(c).alias(c) for c in out_schema.replace(" double", "").split(", ")]).first()
        ll = parts["ll"]
        g = np.array([parts[f"g{i}"] for i in range(p)])
        H = np.array([[parts[f"h{i}_{j}"] for j in range(p)] for i in range(p)])
        step = np.linalg.solve(H, g)
        beta = beta + step
        if abs(ll - ll_old) < tol * (abs(ll) + tol) and np.max(np.abs(step)) < 1e-7:
            converged = True
            break
        ll_old = ll
    del spark
    se = np.sqrt(np.diag(np.linalg.inv(H)))
    return CoxFit(beta, se, float(ll), it, converged)


# ---------------------------------------------------------------------------
# Proportional-odds ordered logit (M6-M8)
# ---------------------------------------------------------------------------

@dataclass
class OrderedLogitFit:
    beta: np.ndarray            # p coefficients
    thresholds: np.ndarray      # K-1 increasing cut points
    classes: list               # observed classes, sorted
    loglik: float
    iterations: int
    converged: bool

    def probability_columns(self, p: int, prefix: str = "prob_", terms: Sequence[Column] | None = None) -> list[Column]:
        """M8: P(y = class) as column expressions (no UDF) over ``terms`` (x0.. if not given)."""
        lp = F.lit(0.0)
        for i in range(p):
            lp = lp + F.lit(float(self.beta[i])) * (F.col(f"x{i}") if terms is None else terms[i])
        cdf = [F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(float(t)) - lp))) for t in self.thresholds]
        cols, prev = [], F.lit(0.0)
        for k, c in enumerate(self.classes):
            cur = cdf[k] if k < len(cdf) else F.lit(1.0)
            cols.append((cur - prev).alias(f"{prefix}{c}"))
            prev = cur
        return cols


def _theta(params: np.ndarray, p: int) -> np.ndarray:
    raw = params[p:]
    return np.concatenate(([raw[0]], raw[0] + np.cumsum(np.exp(raw[1:]))))


def _ordinal_terms(pdf: pd.DataFrame, params: np.ndarray, p: int, K: int) -> tuple[float, np.ndarray]:
    """:func:`_ordinal_sums` of a batch of rows (x0..x{p-1}, __cls)."""
    return _ordinal_sums(pdf[[f"x{i}" for i in range(p)]].to_numpy(dtype=float), pdf["__cls"].to_numpy(dtype=int), params, p, K)


def _packed(batches):
    """Batches of (x0.., __cls) -> one row each: the features, column after column,
    and the classes as bytes, which a pass reads without converting rows."""
    for b in batches:
        if b.num_rows:
            *xs, y = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(np.asarray(x, float).tobytes() for x in xs)], pa.binary()),
                                              pa.array([y.astype(np.int32).tobytes()], pa.binary())], names=["x", "y"])


def _ordinal_sums(X: np.ndarray, y: np.ndarray, params: np.ndarray, p: int, K: int) -> tuple[float, np.ndarray]:
    """Negative log-likelihood and gradient of rows (thresholds as first
    + cumulative exp increments, so they stay ordered)."""
    beta = params[:p]
    th = _theta(params, p)
    lp = X @ beta
    ext = np.concatenate(([-np.inf], th, [np.inf]))
    hi, lo = ext[y + 1][:, None] - lp[:, None], ext[y][:, None] - lp[:, None]
    s = lambda z: 1.0 / (1.0 + np.exp(-z))
    Fh, Fl = s(hi[:, 0]), s(lo[:, 0])
    prob = np.clip(Fh - Fl, 1e-300, None)
    nll = -np.log(prob).sum()
    fh, fl = Fh * (1 - Fh), Fl * (1 - Fl)                  # densities
    # d prob / d lp = -(fh - fl); d prob / d theta_j via the cut points used
    g_beta = -((-(fh - fl)) / prob) @ X
    g_th = np.zeros(K - 1)
    for j in range(K - 1):
        g_th[j] -= ((y == j) * fh / prob).sum()            # upper cut of class j
        g_th[j] += ((y == j + 1) * fl / prob).sum()        # lower cut of class j + 1
    # chain rule to the raw parameters (first cut, log increments)
    J = np.zeros((K - 1, K - 1))
    J[:, 0] = 1.0
    raw = params[p:]
    for j in range(1, K - 1):
        J[j:, j] = np.exp(raw[j])
    return nll, np.concatenate((g_beta, g_th @ J))


def fit_ordered_logit(df: DataFrame, label: str, p: int, max_iter: int = 1000,
                      tol: float = 1e-6) -> OrderedLogitFit:
    """M6: proportional-odds logit by BFGS; every function/gradient
    evaluation is one pass of per-partition partial sums over the design
    (x0..x{p-1}, label), checkpointed in blocks of one Arrow batch."""
    levels = df.select(label).distinct().limit(MAX_LEVELS + 1).collect()   # bounded: ordinal levels
    if len(levels) > MAX_LEVELS:
        raise ConvergenceError(f"more than {MAX_LEVELS} ordinal levels in {label}")
    classes = sorted(r[0] for r in levels)
    K = len(classes)
    if K < 2:
        raise ConvergenceError("need at least two observed classes")
    cmap = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
    seen = dict(df.groupBy(label).count().collect())
    counts = {i: seen.get(c, 0) for i, c in enumerate(classes)}
    n = sum(counts.values())
    base = materialize(df.select(*[f"x{i}" for i in range(p)], cmap[F.col(label)].alias("__cls"))
                       .mapInArrow(_packed, "x binary, y binary"))
    cum = np.cumsum([counts.get(i, 0) for i in range(K)])[:-1] / n
    th0 = np.log(cum / (1 - cum))
    params = np.concatenate((np.zeros(p), [th0[0]], np.log(np.maximum(np.diff(th0), 1e-6))))
    schema = "nll double, " + ", ".join(f"g{i} double" for i in range(len(params)))

    def evaluate(par: np.ndarray) -> tuple[float, np.ndarray]:
        def part(batches):
            tot, grad = 0.0, np.zeros(len(par))
            for blocks in batches:
                for x, y in zip(*blocks.columns, strict=True):
                    X = np.frombuffer(x.as_buffer()).reshape(p, -1).T
                    a, b = _ordinal_sums(X, np.frombuffer(y.as_buffer(), np.int32), par, p, K)
                    tot, grad = tot + a, grad + b
            yield pa.RecordBatch.from_pydict({"nll": [float(tot)], **{f"g{i}": [float(grad[i])] for i in range(len(par))}})
        r = base.mapInArrow(part, schema).agg(*[F.sum(c).alias(c) for c in
                                                ["nll"] + [f"g{i}" for i in range(len(par))]]).first()
        return r["nll"], np.array([r[f"g{i}"] for i in range(len(par))])

    f, g = evaluate(params)
    # the loss is a sum over n rows: start from an inverse Hessian of that
    # scale so the first steps need no long backtracking (each trial is a job)
    Hinv = np.eye(len(params)) * (4.0 / max(n, 1))
    it, converged = 0, False
    for it in range(1, max_iter + 1):
        d = -Hinv @ g
        step, f_new = 1.0, None
        for _ in range(30):                                 # backtracking (Armijo)
            cand = params + step * d
            f_new, g_new = evaluate(cand)
            if np.isfinite(f_new) and f_new <= f + 1e-4 * step * (g @ d):
                break
            step *= 0.5
        s_vec, y_vec = cand - params, g_new - g
        params, f_old, f, g = cand, f, f_new, g_new
        if np.max(np.abs(g)) < tol * max(1.0, n) ** 0.5 or abs(f_old - f) < 1e-12 * max(1.0, abs(f)):
            converged = True
            break
        sy = s_vec @ y_vec
        if sy > 1e-12:
            rho = 1.0 / sy
            I = np.eye(len(params))
            Hinv = (I - rho * np.outer(s_vec, y_vec)) @ Hinv @ (I - rho * np.outer(y_vec, s_vec)) \
                + rho * np.outer(s_vec, s_vec)
    return OrderedLogitFit(params[:p], _theta(params, p), classes, -float(f), it, converged)


def expand_probabilities(df: DataFrame, classes: Sequence, prefix: str = "prob_",
                         out_prefix: str = "prob_mrs_", n_slots: int = 7) -> DataFrame:
    """M7: place the fitted classes' probabilities into ``n_slots`` slots
    (missing classes 0), renormalised; a row summing to 0 is an error (null)."""
    slots = []
    for k in range(n_slots):
        slots.append(F.col(f"{prefix}{k}") if k in set(classes) else F.lit(0.0))
    total = slots[0]
    for c in slots[1:]:
        total = total + c
    out = df
    for k in range(n_slots):
        out = out.withColumn(f"{out_prefix}{k}", F.when(total > 0, slots[k] / total))
    return out.drop(*[f"{prefix}{c}" for c in classes])
