"""Thousands of elastic-net logistic fits at once (U5, U6 refit modes).

A replicate is a weight or a label per row and an encoder; what an encoder makes of a row is
linear in a design that all encoders share: per numeric column its value (0 where missing) and
a missing flag, per level of a categorical column a flag, and one for its nulls.  So the design
is stored once, in packed blocks of rows, and one pass over it gives loss, gradient and Hessian
of every replicate as matrix products.  Replicates leave tasks added up; the driver holds a
small matrix per replicate and takes proximal Newton steps (the quadratic model with its L1
term is solved exactly by feature-sign search) until the predicted gain is below ``TOL``.

Out-of-sample scores are ranked exactly: tasks send a replicate's scores on in packed pieces,
dealt by replicate and score range."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_order, num
from .bijection import bijection_constants, positions
from .draws import draw_blocks, weight_vectors
from .encode import FoldSafeEncoder, FoldSafeEncoderModel
from .kernels import global_rank, materialize
from .resample import valid_replicates

BLOCK_ROWS = 4096
TASK_ROWS = 16 * BLOCK_ROWS
CELLS = 500_000                      # of a (rows x fits) matrix in a task
COLUMNS = 64                         # of a design, whose square a task holds per fit
TOL = 1e-10                          # predicted gain of a Newton step (mean loss) at which a fit is done
SLICE = 50                           # fits whose sums travel together
GROUP_ROWS = 50_000                  # rows of a group that meet in one task
RANKED = 400_000_000                 # scores ranked in one job
BUCKET_ROWS = 2_000_000              # scores of a fit that are ranked together
TASK_SCORES = 6_000_000              # scores that meet in one task
END = 1000.0                         # log odds of a fit that saw one class only


# -- the design that all encoders share --------------------------------------

@dataclass
class Design:
    """``place``: column of ("1",), ("v", c), ("m", c), ("l", c, level) and ("n", c)."""
    numeric: list[str]
    levels: dict[str, list[str]]
    place: dict[tuple, int]

    @classmethod
    def of(cls, rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> "Design | None":
        """None if it has more than ``COLUMNS`` columns."""
        gaps = rows.agg(*[F.max(num(rows, c).isNull().cast("int")).alias(c) for c in numeric],
                        *[F.max(F.col(c).isNull().cast("int")).alias(c) for c in categorical]).first()
        place: dict[tuple, int] = {("1",): 0}
        for kind, at in [*(("v", c) for c in numeric), *(("m", c) for c in numeric if gaps[c])]:
            place[kind, at] = len(place)
        levels = {}
        for c in categorical:
            found = rows.select(F.col(c).cast("string")).filter(F.col(c).isNotNull()).distinct().limit(COLUMNS + 1).collect()
            levels[c] = sorted(r[0] for r in found)
            for v in levels[c]:
                place["l", c, v] = len(place)
            if gaps[c]:
                place["n", c] = len(place)
        return cls(list(numeric), levels, place) if len(place) <= COLUMNS else None

    def columns(self, rows: DataFrame) -> list:
        """Expressions of all columns but the first (which is 1)."""
        def cell(p):
            if p[0] == "v":
                return F.coalesce(num(rows, p[1]), F.lit(0.0))
            if p[0] == "m":
                return num(rows, p[1]).isNull().cast("double")
            if p[0] == "n":
                return F.col(p[1]).isNull().cast("double")
            return F.coalesce((F.col(p[1]).cast("string") == p[2]).cast("double"), F.lit(0.0))
        return [cell(p).alias(f"d{k}") for p, k in self.place.items() if k]

    def features(self) -> list[tuple]:
        return [p for p in self.place if p[0] in ("v", "m", "l")]

    def encoding(self, enc: FoldSafeEncoderModel) -> np.ndarray:
        """(columns x 1 + features): what an encoder without scaling makes of the design, intercept first;
        a feature that it lacks is 0."""
        if enc.scale or enc.dropped:
            raise ValueError("scaled and dropped columns are not supported")
        out = np.zeros((len(self.place), 1 + len(self.features())))
        out[0, 0] = 1.0
        for k, p in enumerate(self.features(), 1):
            c = p[1]
            if p[0] == "v" and c in enc.numeric:
                out[self.place[p], k] = 1.0
                if ("m", c) in self.place:
                    out[self.place["m", c], k] = enc.medians[c]
            elif p[0] == "m" and c in enc.indicators:
                out[self.place[p], k] = 1.0
            elif p[0] == "l" and c in enc.categorical and p[2] in enc.categories[c]:
                out[self.place[p], k] = 1.0
                if enc.modes[c] == p[2] and ("n", c) in self.place:
                    out[self.place["n", c], k] = 1.0
        return out


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The design of a batch with columns d1.., its first column 1."""
    return np.column_stack([np.ones(batch.num_rows), *(batch.column(f"d{k}").to_numpy(zero_copy_only=False) for k in range(1, width))])


# -- packed rows -------------------------------------------------------------
# A block is (fold, n, design, label, groups, vectors): labels are bytes, or bits of all label sets;
# with vectors a row's weights are those of its group.

BLOCK = "fold int, n int, design binary, label binary, groups binary, vectors binary"


def _block(fold: int, design: np.ndarray, label: bytes, groups: bytes = b"", vectors: bytes = b"") -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([fold], pa.int32()), pa.array([len(design)], pa.int32()), pa.array([np.ascontiguousarray(design).tobytes()], pa.binary()),
         pa.array([label], pa.binary()), pa.array([groups], pa.binary()), pa.array([vectors], pa.binary())],
        names=["fold", "n", "design", "label", "groups", "vectors"])


@dataclass
class Reader:
    """How a block's cells read: ``sets`` label sets or weight vectors; with ``folds`` there is a fit
    per training fold and label set (fold by fold), without a fit per vector."""
    width: int
    sets: int
    folds: int

    def cells(self, row: dict, valid: bool = False) -> Iterator[tuple[int, np.ndarray, Callable, Callable]]:
        """(first fit, design, labels, weights) of the fits that train on a block's rows (``valid``: that score them);
        labels(lo, hi, sets) and weights(lo, hi, sets) give (rows x sets) cells."""
        n, sets = row["n"], self.sets
        design = np.frombuffer(row["design"]).reshape(n, self.width)
        if self.folds:
            bits = np.frombuffer(row["label"], np.uint8).reshape(n, -1)

            def labels(lo, hi, which):
                return np.unpackbits(bits[lo:hi], axis=1, count=sets)[:, which].astype(float)

            for f in range(self.folds):
                if (f == row["fold"]) == valid:
                    yield f * sets, design, labels, lambda lo, hi, which: None
        else:
            y = np.frombuffer(row["label"], np.uint8)
            at, vectors = np.frombuffer(row["groups"], np.int32), np.frombuffer(row["vectors"], np.uint16).reshape(-1, sets)
            yield (0, design, lambda lo, hi, which: y[lo:hi, None].astype(float),
                   lambda lo, hi, which: vectors[:, which][at[lo:hi]])


@dataclass
class Packed:
    blocks: DataFrame
    read: Reader
    rows: int


def _tasks(spark, rows: int) -> int:
    """Parts of packed rows: every core has one, and no batch of a part's blocks is large."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "8")), -(-rows // TASK_ROWS))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _summed(df: DataFrame, run: Callable) -> dict[int, np.ndarray]:
    """slice -> sum of the float64 vectors that ``run(rows)`` gives per slice, added up on the executors in task order."""
    def tasks(batches):
        part = TaskContext.get().partitionId()
        for s, v in run(_rows_of(batches)):
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([part], pa.int32()),
                                              pa.array([np.ascontiguousarray(v, float).tobytes()], pa.binary())],
                                             names=["slice", "part", "sums"])

    def add(batches):
        key, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                              names=["slice", "sums"])
        for r in _rows_of(batches):
            v = np.frombuffer(r["sums"])
            if r["slice"] != key:
                if key is not None:
                    yield done()
                key, total = r["slice"], v.copy()
            else:
                total += v
        if key is not None:
            yield done()

    sums = (df.mapInArrow(tasks, "slice int, part int, sums binary").repartition("slice")
            .sortWithinPartitions("slice", "part").mapInArrow(add, "slice int, sums binary"))
    return {r.slice: np.frombuffer(bytes(r.sums)) for r in sums.collect()}            # a vector per fit


# -- one pass: loss, gradient and Hessian ------------------------------------

def _pass(packed: Packed, which: np.ndarray, coef: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of loss, gradient and Hessian in the design's columns at ``coef`` (width x fits) of the fits ``which``."""
    read, fits = packed.read, len(which)
    q, sets = read.width, read.sets
    up = np.triu_indices(q)
    size = 1 + q + len(up[0])

    def run(rows):
        total = np.zeros((fits, size))
        for row in rows:
            for first, design, labels, weights in read.cells(row):
                at = np.flatnonzero((which >= first) & (which < first + sets))
                if not len(at):
                    continue
                used, b = which[at] - first, coef[:, at]
                step = max(1, CELLS // len(at))
                for lo in range(0, row["n"], step):
                    d = design[lo:lo + step]
                    y, w = labels(lo, lo + step, used), weights(lo, lo + step, used)
                    eta = d @ b
                    e = np.exp(-np.abs(eta))
                    p = np.where(eta >= 0, 1.0, e) / (1.0 + e)
                    loss, slope, curve = np.maximum(eta, 0) + np.log1p(e) - y * eta, p - y, p * (1.0 - p)
                    if w is not None:
                        loss, slope, curve = loss * w, slope * w, curve * w
                    total[at, 0] += loss.sum(axis=0)
                    total[at, 1:1 + q] += slope.T @ d
                    total[at, 1 + q:] += curve.T @ (d[:, up[0]] * d[:, up[1]])
        for lo in range(0, fits, SLICE):
            yield lo // SLICE, total[lo:lo + SLICE].ravel()

    found = _summed(packed.blocks, run)
    total = np.concatenate([found[s].reshape(-1, size) for s in sorted(found)])
    hess = np.empty((fits, q, q))
    hess[:, up[0], up[1]] = total[:, 1 + q:]
    hess[:, up[1], up[0]] = total[:, 1 + q:]
    return total[:, 0], total[:, 1:1 + q], hess


# -- the step: an L1 quadratic per fit, exactly ------------------------------

def l1_quadratic(a: np.ndarray, b: np.ndarray, l1: np.ndarray, x: np.ndarray) -> np.ndarray:
    """argmin of x'ax/2 - b'x + sum(l1 |x|) for each row (``l1`` 0: no penalty), from ``x``, by feature-sign search:
    the coordinates that are not 0 solve a linear system of their signs; steps end where one becomes 0."""
    x, left = x.copy(), np.arange(len(x))
    tol = np.maximum(1e-5 * l1.max(axis=1), 1e-13 * np.abs(b).max(axis=1))
    for _ in range(20 * x.shape[1] + 50):
        if not len(left):
            break
        A, B, L, X = a[left], b[left], l1[left], x[left]
        grad = np.einsum("sij,sj->si", A, X) - B
        free = (X != 0) | (L == 0)
        sign = np.sign(X)
        wrong = np.abs(np.where(free, grad + L * sign, 0)).max(axis=1) > tol[left]
        excess = np.where(free, -np.inf, np.abs(grad) - L)
        enter = ~wrong & (excess.max(axis=1) > tol[left])
        r = np.flatnonzero(enter)
        j = excess[r].argmax(axis=1)
        free[r, j], sign[r, j] = True, -np.sign(grad[r, j])
        go = wrong | enter
        if not go.all():
            left, A, B, L, X, free, sign = left[go], A[go], B[go], L[go], X[go], free[go], sign[go]
            if not len(left):
                break
        eye = np.eye(X.shape[1])
        scale = 1.0 / np.sqrt(np.maximum(np.einsum("sii->si", A), 1e-300))
        scale = np.where(free, scale, 1.0)
        system = np.where(free[:, :, None] & free[:, None, :], A, eye) * scale[:, :, None] * scale[:, None, :]
        new = np.linalg.solve(system, (np.where(free, B - L * sign, 0) * scale)[..., None])[..., 0] * scale
        move = new - X
        with np.errstate(divide="ignore", invalid="ignore"):
            zero = np.where((X * new < 0) & (L > 0), X / (X - new), 2.0)
        t = np.concatenate([np.where(zero < 1, zero, 1.0), np.ones((len(X), 1))], axis=1)
        am = np.einsum("sij,sj->si", A, move)
        value = (t * (np.einsum("si,si->s", X, am) - np.einsum("si,si->s", B, move))[:, None]
                 + t * t * 0.5 * np.einsum("si,si->s", move, am)[:, None]
                 + np.einsum("si,ski->sk", L, np.abs(X[:, None] + t[:, :, None] * move[:, None])))
        best = value.argmin(axis=1)
        rows = np.arange(len(X))
        best = np.where(value[rows, -1] <= value[rows, best], X.shape[1], best)
        out = X + t[rows, best][:, None] * move
        hit = np.flatnonzero(best < X.shape[1])
        out[hit, best[hit]] = 0.0
        x[left] = np.where(free, out, 0.0)
    return x


def fit_all(packed: Packed, encoding: np.ndarray, n: np.ndarray, l1: np.ndarray, l2: np.ndarray, max_iter: int) -> np.ndarray:
    """(width x fits): coefficients on the design of every fit of mean log loss + l1 |b| + l2 b'b / 2 (intercept free).
    ``encoding``: a matrix per fit, ``n``: its rows or sum of weights."""
    fits, _, p = encoding.shape
    lam1, lam2 = np.repeat(l1[:, None], p, 1), np.repeat(l2[:, None], p, 1)
    lam1[:, 0] = lam2[:, 0] = 0.0
    theta, step, before = np.zeros((fits, p)), np.zeros((fits, p)), np.full(fits, np.inf)
    active = np.arange(fits)
    first = True
    for _ in range(max_iter):
        tried = theta[active] + step[active]
        loss, grad, hess = _pass(packed, active, np.einsum("sqp,sp->qs", encoding[active], tried))
        if first:                                            # at 0 the intercept's slope tells the positives
            positives = 0.5 * n - grad[:, 0]
            for k in np.flatnonzero((positives < 0.25) | (n - positives < 0.25)):
                theta[k, 0] = END if positives[k] >= 0.25 else -END
            single = (positives < 0.25) | (n - positives < 0.25)
        l1a, l2a = lam1[active], lam2[active]

        def penalty(x, l1a=l1a, l2a=l2a):
            return (l1a * np.abs(x) + 0.5 * l2a * x * x).sum(axis=1)

        value = loss / n[active] + penalty(tried)
        better = value <= before[active] + 1e-14
        if first:
            better &= ~single
        short = np.flatnonzero(~better)                      # half the step, unless it is nothing already
        step[active[short]] *= 0.5
        keep = np.ones(len(active), bool)
        keep[short] = np.abs(step[active[short]]).max(axis=1) > 1e-9 if not first else False
        ok = np.flatnonzero(better)
        if len(ok):
            at = active[ok]
            u, x = encoding[at], tried[ok]
            g = np.einsum("sqp,sq->sp", u, grad[ok]) / n[at, None]
            h = np.einsum("sqp,sqr,srt->spt", u, hess[ok], u, optimize=True) / n[at, None, None]
            a = h.copy()
            d = np.arange(p)
            a[:, d, d] += lam2[at]
            new = l1_quadratic(a, np.einsum("spt,st->sp", h, x) - g, lam1[at], x)
            move = new - x
            gain = -((g * move).sum(axis=1) + 0.5 * np.einsum("sp,spt,st->s", move, h, move)
                     + ((lam1[at] * np.abs(new) + 0.5 * lam2[at] * new * new) - (lam1[at] * np.abs(x) + 0.5 * lam2[at] * x * x)).sum(axis=1))
            done = gain <= TOL
            theta[at], step[at], before[at] = np.where(done[:, None], new, x), move, value[ok]
            keep[ok] = ~done
        active, first = active[keep], False
        if not len(active):
            break
    return np.einsum("sqp,sp->qs", encoding, theta)


# -- exact AUCs of every fit's scores ----------------------------------------

def _scores(design: np.ndarray, coef: np.ndarray) -> np.ndarray:
    """Probabilities (rows x fits), column by column, so that equal rows have equal scores."""
    eta = np.zeros((len(design), coef.shape[1]))
    for k in range(design.shape[1]):
        eta += design[:, k:k + 1] * coef[k]
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-eta))


def score_aucs(packed: Packed, coef: np.ndarray) -> np.ndarray:
    """(sets x 2): AUC of the scores of a label set's or vector's fits over all rows, and by the vector's weights
    (without vectors: the same).  With folds a row is scored by the fit that did not train on it."""
    read = packed.read
    sets, buckets = read.sets, max(1, -(-packed.rows // BUCKET_ROWS))
    splits = None
    if buckets > 1:                                          # where to cut is a matter of balance only
        some = [r.asDict() for r in packed.blocks.limit(4).collect()]
        scores = np.concatenate([_scores(d, coef[:, f:f + sets]) for r in some for f, d, _, _ in read.cells(r, bool(read.folds))])
        splits = np.quantile(scores, np.arange(1, buckets) / buckets, axis=0)
    out = np.full((sets, 2), np.nan)
    some = max(1, RANKED // max(1, packed.rows))
    for lo in range(0, sets, some):
        which = np.arange(lo, min(lo + some, sets))
        for k, both in _ranked_aucs(packed, coef, which, splits).items():
            out[k] = both
    return out


def _ranked_aucs(packed: Packed, coef: np.ndarray, which: np.ndarray, splits: np.ndarray | None) -> dict[int, tuple[float, float]]:
    read = packed.read
    plain = bool(read.folds)

    def send(batches):
        for row in _rows_of(batches):
            for first, design, labels, weights in read.cells(row, plain):
                step = max(1, CELLS // max(1, row["n"]))
                for at in range(0, len(which), step):
                    sets = which[at:at + step]
                    s, y, w = _scores(design, coef[:, first + sets]), labels(0, row["n"], sets), weights(0, row["n"], sets)
                    rows = {"fit": [], "bucket": [], "score": [], "label": [], "weight": []}
                    for j, k in enumerate(sets.tolist()):
                        column, label = s[:, j], y[:, j if y.shape[1] > 1 else 0].astype(np.uint8)
                        cut = np.zeros(len(column), int) if splits is None else np.searchsorted(splits[:, k], column, "right")
                        for b in np.unique(cut).tolist():
                            take = cut == b
                            rows["fit"].append(k)
                            rows["bucket"].append(b)
                            rows["score"].append(column[take].tobytes())
                            rows["label"].append(np.packbits(label[take]).tobytes())
                            rows["weight"].append(b"" if w is None else np.ascontiguousarray(w[take, j]).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows["fit"], pa.int32()), pa.array(rows["bucket"], pa.int32()), pa.array(rows["score"], pa.binary()),
                         pa.array(rows["label"], pa.binary()), pa.array(rows["weight"], pa.binary())], names=list(rows))

    def rank(batches):
        key, held = None, []

        def done():
            score = np.concatenate([np.frombuffer(r["score"]) for r in held])
            label = np.concatenate([np.unpackbits(np.frombuffer(r["label"], np.uint8), count=len(r["score"]) // 8) for r in held])
            order = np.argsort(score)
            score, label = score[order], label[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], score[1:] != score[:-1])))

            def sums(w):
                pos, neg = np.add.reduceat(label * w, first), np.add.reduceat((1 - label) * w, first)
                less = np.cumsum(neg) - neg
                return float(pos.sum()), float(neg.sum()), float((pos * (less + 0.5 * neg)).sum())

            one = sums(np.ones(len(score), np.int64))
            own = one if plain else sums(np.concatenate([np.frombuffer(r["weight"], np.uint16) for r in held])[order].astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, *one, *own)], names=["fit", "bucket", *"abcdef"])

        for r in _rows_of(batches):
            if (r["fit"], r["bucket"]) != key:
                if key is not None:
                    yield done()
                key, held = (r["fit"], r["bucket"]), []
            held.append(r)
        if key is not None:
            yield done()

    pieces = packed.blocks.mapInArrow(send, "fit int, bucket int, score binary, label binary, weight binary")
    tasks = max(packed.blocks.sparkSession.sparkContext.defaultParallelism, -(-packed.rows * len(which) // TASK_SCORES))
    ranked = (pieces.repartition(tasks, "fit", "bucket").sortWithinPartitions("fit", "bucket")
              .mapInArrow(rank, "fit bigint, bucket bigint, " + ", ".join(f"{c} double" for c in "abcdef")))
    parts: dict[int, list] = {}
    for r in ranked.collect():                                                    # fits x buckets rows
        parts.setdefault(r.fit, []).append(tuple(r))

    def auc(rows, at):
        less = wins = pos = 0.0
        for r in sorted(rows):
            wins += r[at + 2] + r[at] * less
            pos, less = pos + r[at], less + r[at + 1]
        return wins / (pos * less) if pos and less else float("nan")

    return {k: (auc(rows, 2), auc(rows, 5)) for k, rows in parts.items()}


# -- U5: bootstrap refits ----------------------------------------------------

def _bits(x: np.ndarray) -> np.ndarray:
    """float64 as integers of the same order."""
    u = (x + 0.0).view(np.uint64)                            # -0.0 is 0.0
    return np.where(u >> 63, ~u, u | np.uint64(1 << 63))


def _unbits(u: np.ndarray) -> np.ndarray:
    return np.where(u >> 63, u & np.uint64((1 << 63) - 1), ~u).astype(np.uint64).view(np.float64)


def _order_statistics(packed: Packed, value: int, missing: int, ranks: np.ndarray) -> np.ndarray:
    """(vectors x asked): the values at 0-based ``ranks`` of a design column's observed rows, each counted by the
    vector's weights: eight bits of the value a pass."""
    read = packed.read
    sets, asked = ranks.shape
    prefix, left = np.zeros((sets, asked), np.uint64), ranks.astype(np.int64).copy()
    for shift in range(56, -1, -8):
        high = np.uint64(shift + 8)

        def run(rows, shift=shift, high=high, prefix=prefix):
            total = np.zeros((asked, 256, sets))
            for row in rows:
                for _, design, _, weights in read.cells(row):
                    step = max(1, 2 * CELLS // sets)
                    for lo in range(0, row["n"], step):
                        part = design[lo:lo + step]
                        keep = np.flatnonzero(part[:, missing] == 0)
                        if not len(keep):
                            continue
                        own = _bits(np.ascontiguousarray(part[keep, value]))
                        order = np.argsort(own, kind="stable")
                        bits, first = np.unique(own[order], return_index=True)
                        w = np.add.reduceat(weights(lo, lo + step, np.arange(sets))[keep[order]].astype(np.int64), first, axis=0)
                        digit = ((bits >> np.uint64(shift)) & np.uint64(255)).astype(int)
                        order = np.argsort(digit, kind="stable")
                        found, first = np.unique(digit[order], return_index=True)
                        for k in range(asked):
                            m = w if shift == 56 else w * ((bits >> high)[:, None] == prefix[None, :, k])
                            total[k, found] += np.add.reduceat(m[order], first, axis=0)
            for lo in range(0, sets, SLICE):
                yield lo // SLICE, total[:, :, lo:lo + SLICE].ravel()

        sums = _summed(packed.blocks, run)
        for s, v in sums.items():
            count = np.cumsum(v.reshape(asked, 256, -1), axis=1).astype(np.int64)
            for k in range(asked):
                for j in range(count.shape[2]):
                    r = s * SLICE + j
                    digit = int(np.searchsorted(count[k, :, j], left[r, k], "right"))
                    digit = min(digit, 255)
                    left[r, k] -= count[k, digit - 1, j] if digit else 0
                    prefix[r, k] = (int(prefix[r, k]) << 8) | digit
    return _unbits(prefix)


@dataclass
class _Count:
    n: int
    present: int


def weighted_encoders(packed: Packed, design: Design, encoder: FoldSafeEncoder) -> list[FoldSafeEncoderModel]:
    """The encoder of each vector of weights, as ``encoder.fit_weighted`` gives it; a median is looked for only where
    the design has missing values (it is used nowhere else, and 0 there)."""
    read = packed.read
    sets, q = read.sets, read.width

    def run(rows):
        total = np.zeros((sets, q))
        for row in rows:
            for _, d, _, weights in read.cells(row):
                step = max(1, CELLS // sets)
                for lo in range(0, row["n"], step):
                    total += weights(lo, lo + step, np.arange(sets)).astype(float).T @ (d[lo:lo + step] * counted)
        for lo in range(0, sets, SLICE):
            yield lo // SLICE, total[lo:lo + SLICE].ravel()

    counted = np.array([p[0] != "v" for p in sorted(design.place, key=design.place.get)], float)
    found = _summed(packed.blocks, run)
    total = np.rint(np.concatenate([found[s].reshape(-1, q) for s in sorted(found)])).astype(np.int64)
    n, at = total[:, 0], design.place
    counts, med, levels = {}, {}, {}
    for c in design.numeric:
        gone = total[:, at["m", c]] if ("m", c) in at else np.zeros(sets, np.int64)
        middle = np.zeros(sets)
        if ("m", c) in at:
            last = np.maximum(n - gone - 1, 0)
            two = _order_statistics(packed, at["v", c], at["m", c], np.stack([last // 2, last - last // 2], axis=1))
            middle = np.where(n > gone, two[:, 0] + 0.5 * (last % 2) * (two[:, 1] - two[:, 0]), 0.0)
        for s in range(sets):
            counts[s, c], med[s, c] = _Count(int(n[s]), int(n[s] - gone[s])), float(middle[s])
    for c in encoder.categorical:
        for s in range(sets):
            counts[s, c] = _Count(int(n[s]), 0)
            seen = {v: int(total[s, at["l", c, v]]) for v in design.levels[c] if total[s, at["l", c, v]]}
            if seen:
                levels[s, c] = seen
    return [encoder._model(s, counts, med, {}, levels) for s in range(sets)]


def _with_vectors(rows: DataFrame, design: Design, group: str, reps: list[int], groups: DataFrame, n_groups: int, seed) -> Packed:
    """Rows in blocks with the weights of their groups in every replicate; a last vector is 1 for all rows."""
    sets, width, cells = len(reps) + 1, len(design.place), [f"d{k}" for k in range(1, len(design.place))]
    plain = materialize(rows.select(group, *design.columns(rows), F.col("label").cast("int").alias("y")))
    parts = plain.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("parts"))
    drawn = weight_vectors(draw_blocks(rows.sparkSession, n_groups, reps, seed), reps, n_groups)
    vectors = groups.join(drawn.hint("merge"), "group_idx").join(parts.hint("merge"), group)
    none = [F.lit(None).cast("double").alias(c) for c in cells]
    vectors = vectors.select(group, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("is_row"), "vector",
                             *none, F.lit(None).cast("int").alias("y"))
    dealt = (plain.withColumn("__id", F.monotonically_increasing_id()).join(parts.withColumnRenamed(group, "__g"), F.col(group).eqNullSafe(F.col("__g")))
             .select(group, F.pmod("__id", F.col("parts")).cast("int").alias("part"), F.lit(1).alias("is_row"),
                     F.lit(None).cast("binary").alias("vector"), *cells, "y"))
    # rows without a group come first (nulls first): no vector is before them
    stream = (vectors.unionByName(dealt).repartition(_tasks(rows.sparkSession, plain.count()), group, "part").sortWithinPartitions(group, "part", "is_row")
              .select(F.col(group).isNull().alias("alone"), F.concat_ws("|", F.col(group).cast("string"), F.col("part").cast("string")).alias("name"),
                      "is_row", "vector", *cells, "y"))

    def pack(batches):
        zero = np.zeros(len(reps), np.uint16).tobytes()
        one = np.uint16(1).tobytes()
        held, name, book, kept = zero, None, [], []          # the last vector and whose it is; vectors and rows of the next block
        size, fresh = 0, True                                # fresh: the held vector is not in the book

        def done():
            d = np.concatenate([x[0] for x in kept])
            return _block(-1, d, np.concatenate([x[1] for x in kept]).astype(np.uint8).tobytes(),
                          np.concatenate([x[2] for x in kept]).astype(np.int32).tobytes(), b"".join(v + one for v in book))

        for batch in batches:
            is_row = batch.column("is_row").to_numpy() == 1
            names = batch.column("name").to_pylist()
            cuts = np.flatnonzero(np.concatenate(([True], np.array(names[1:]) != np.array(names[:-1])))).tolist() if batch.num_rows else []
            vector = batch.column("vector")
            d, y = _matrix(batch, width), batch.column("y").to_numpy(zero_copy_only=False)
            for lo, hi in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if names[lo] != name:
                    name, held, fresh = names[lo], zero, True    # a group that was never drawn has no vector
                if not is_row[lo]:
                    held, fresh = vector[lo].as_py(), True
                    lo += 1
                while lo < hi:
                    if fresh:
                        book.append(held)
                        fresh = False
                    end = min(hi, lo + BLOCK_ROWS - size)
                    kept.append((d[lo:end], y[lo:end], np.full(end - lo, len(book) - 1)))
                    size, lo = size + end - lo, end
                    if size >= BLOCK_ROWS:
                        yield done()
                        book, kept, size, fresh = [], [], 0, True
        if size:
            yield done()

    blocks = materialize(stream.mapInArrow(pack, BLOCK))
    return Packed(blocks, Reader(width, sets, 0), blocks.agg(F.sum("n")).first()[0])


def bootstrap_refits(rows: DataFrame, encoder: FoldSafeEncoder, design: Design, penalty: Callable, max_iter: int, group: str,
                     n_boot: int, seed) -> tuple[float, list[tuple[int, float, float]]]:
    """The AUC of the fit on all ``rows``, and (replicate, its AUC on the rows it drew, its AUC on all rows)."""
    labelled = rows.withColumn("label", F.col("label").cast("int"))
    reps, groups, n_groups = valid_replicates(labelled, group, "label", n_boot, seed)
    packed = _with_vectors(labelled, design, group, reps, groups, n_groups, seed)
    encoders = weighted_encoders(packed, design, encoder)
    n = np.array([e.n_rows for e in encoders], float)
    l1, l2 = (np.array(x) for x in zip(*[penalty(int(k)) for k in n], strict=True))
    coef = fit_all(packed, np.stack([design.encoding(e) for e in encoders]), n, l1, l2, max_iter)
    aucs = score_aucs(packed, coef)
    return float(aucs[-1, 0]), [(r, float(own), float(all_)) for r, (all_, own) in zip(reps, aucs[:-1], strict=True)]


# -- U6: permutation refits --------------------------------------------------

def permutation_refits(rows: DataFrame, encoders: Sequence[FoldSafeEncoderModel], design: Design, penalty: Callable, max_iter: int,
                       key: str, n_perm: int, seed, salt: str = "perm") -> np.ndarray:
    """AUCs of the out-of-fold scores: of the rows' own labels, then of each permutation (those of ``permute_labels``,
    but a row has its own place also where its key repeats or is null).  ``rows`` hold the label and their fold."""
    k, width = len(encoders), len(design.place)
    cells = [c for c in design.columns(rows)]
    ranked = materialize(global_rank(rows.select("fold", F.col("label").cast("int").alias("y"), key, *cells,
                                                 hash_order(seed, f"{salt}:key", F.col(key)).alias("__h")),
                                     [], "__h", tiebreak=[key], out="__rank"))
    per_fold = {r.fold: (r.n, r.p) for r in ranked.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).collect()}
    total, positives = (sum(x) for x in zip(*per_fold.values(), strict=True))
    constants, sets = bijection_constants(seed, salt), n_perm + 1

    def pack(batches):
        held: dict[int, list] = {}
        for batch in batches:
            fold, d, y = batch.column("fold").to_numpy(), _matrix(batch, width), batch.column("y").to_numpy()
            rank = batch.column("__rank").to_numpy()
            for f in np.unique(fold).tolist():
                at = np.flatnonzero(fold == f)
                held.setdefault(f, []).append((d[at], y[at], rank[at]))
                if sum(len(x[0]) for x in held[f]) >= BLOCK_ROWS:
                    yield from done(f, held.pop(f))
        for f, parts in held.items():
            yield from done(f, parts)

    def done(f, parts):
        d, y, rank = (np.concatenate(x) for x in zip(*parts, strict=True))
        for lo in range(0, len(d), BLOCK_ROWS):
            hi = lo + BLOCK_ROWS
            moved = positions(rank[lo:hi], np.arange(n_perm), total, constants) >= total - positives
            yield _block(f, d[lo:hi], np.packbits(np.concatenate([y[lo:hi, None].astype(bool), moved], axis=1), axis=1).tobytes())

    dealt = ranked.repartition(_tasks(rows.sparkSession, total), "fold", "__rank")
    blocks = materialize(dealt.select("fold", "y", "__rank", *[f"d{j}" for j in range(1, width)]).mapInArrow(pack, BLOCK))
    packed = Packed(blocks, Reader(width, sets, k), total)
    n = np.repeat([float(total - per_fold.get(f, (0, 0))[0]) for f in range(k)], sets)
    l1, l2 = (np.repeat([penalty(int(x))[j] for x in n[::sets]], sets) for j in (0, 1))
    encoding = np.repeat(np.stack([design.encoding(e) for e in encoders]), sets, axis=0)
    return score_aucs(packed, fit_all(packed, encoding, n, l1, l2, max_iter))[:, 0]

