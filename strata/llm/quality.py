"""Quality classifier on document statistics.

Every whole text is reduced to a fixed vector of statistics (shares of
character classes, word and line repetition, lengths).  Random Fourier features
of the standardised vector approximate a Gaussian kernel.  Ridge regression is
fitted from normal equations: each task sums Z'Z and Z'y of its rows, once per
fold, and only those sums (a fixed size) reach the driver; the systems without
one fold come from subtraction.  Their out-of-fold scores are binned on a fixed
grid, counted by Spark, and an isotonic (pool adjacent violators) fit on the
counts calibrates the final score.

Fitting reads at most about ``max_rows`` labelled rows, those with the smallest
id hashes (a documented bound; scoring reads every row).  Labels, language,
source and id are never inputs of a score; the id only chooses rows.

Defined results: null and empty texts have statistics zero and get the score
the model gives there; equal texts get equal scores; conflicting labels of one
id are averaged; rows without a usable label are not fitted on; with no labels
at all, or labels of one kind, every score is the mean label (0.5 without any);
an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH, blocks, stage

MAX_ROWS = 100_000
FEATURES, FOLDS, RIDGE, WIDTH, GRID, SEED = 256, 3, 1e-3, 1.0, 4096, 20
MARKS = b"!?.,;:|#$%&*@/\\<>()[]{}=+-_~^'\"`"

_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a"): ord("z") + 1] = 1
_CLASS[ord("A"): ord("Z") + 1] = 2
_CLASS[ord("0"): ord("9") + 1] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[128:] = 6
for _i, _m in enumerate(MARKS):
    _CLASS[_m] = 7 + _i
_CLASSES = 7 + len(MARKS)
N_STATS = _CLASSES + 13


def document_stats(text: bytes | None) -> np.ndarray:
    """The statistics of one text (all between 0 and about 5)."""
    out = np.zeros(N_STATS)
    if not text:
        return out
    share = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=_CLASSES) / len(text)
    out[:_CLASSES] = np.sqrt(share)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    tail = out[_CLASSES:]
    tail[0] = np.log1p(len(text)) / 4
    if n == 0:
        return out
    count = Counter(words)
    length = np.fromiter(map(len, words), np.int64, n)
    tail[1] = np.log1p(n) / 3
    tail[2] = len(count) / n
    tail[3] = np.sqrt(max(count.values()) / n)
    tail[4] = np.sqrt(sum(c for c in count.values() if c > 1) / n)
    tail[5] = np.log1p(length.mean())
    tail[6] = np.log1p(length.std())
    tail[7] = np.log1p(length.max()) / 2
    tail[8] = (length <= 3).mean()
    tail[9] = np.sqrt(sum(map(bytes.__eq__, words[1:], words[:-1])) / n)
    tail[10] = len(set(lines)) / max(1, len(lines))
    tail[11] = np.log1p(n / max(1, len(lines))) / 3
    tail[12] = np.sqrt(len(zlib.compress(text, 1)) / len(text)) if len(text) > 64 else 0.8
    return out


@dataclass
class QualityModel:
    """Everything scoring needs; about 200 KB whatever was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray            # random frequencies
    phase: np.ndarray
    coef: np.ndarray
    cal_x: np.ndarray             # calibration: score -> probability, linear between
    cal_y: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        f = np.cos(z @ self.weight + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.hstack([np.ones((len(f), 1)), f])

    def raw(self, x: np.ndarray, coef: np.ndarray | None = None) -> np.ndarray:
        return self.features(x) @ (self.coef if coef is None else coef)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.cal_x, self.cal_y).clip(0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted ``x``: block centres and values."""
    blocks: list[list[float]] = []                       # sum w, sum w*y, sum w*x
    for xi, yi, wi in zip(x, y, w, strict=True):
        blocks.append([wi, wi * yi, wi * xi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str,
                  label_col: str) -> DataFrame:
    """(y, fold, stats) of the labelled rows that are fitted on."""
    lab = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(id_col).agg(F.avg(F.col(label_col).cast("double")).alias("__y")))
    total = lab.count()
    if total > max_rows:                                 # a hash threshold, not a sort
        lab = lab.filter(F.pmod(F.xxhash64(id_col, F.lit(SEED)), F.lit(1 << 40)) <
                         int((1 << 40) * max_rows / total))
    lab = lab.select(id_col, "__y", F.pmod(F.xxhash64(id_col), F.lit(FOLDS)).cast("int").alias("__fold"))
    # at most about max_rows ids and numbers: a checked size
    rows = docs.select(id_col, F.col(text_col).cast("binary").alias("__t")).join(F.broadcast(lab), id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = [document_stats(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(stats, pa.list_(pa.float64()))],
                                             names=["y", "fold", "stats"])

    return stage(rows.select("__t", "__y", "__fold").mapInArrow(run, "y double, fold int, stats array<double>"),
                 "labelled", BATCH)


def _matrix(col) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), N_STATS)


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality") -> QualityModel:
    rows = labelled_rows(docs, labels, max_rows, id_col, text_col, label_col)
    rng = np.random.default_rng(SEED)
    moments = rows.agg(F.count(F.lit(1)), F.avg("y"), F.min("y"), F.max("y")).first()
    d = N_STATS
    weight = rng.normal(size=(d, FEATURES)) / (WIDTH * np.sqrt(d))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def sums(batches):
        n, s, q = 0, np.zeros(d), np.zeros(d)
        for b in batches:
            x = _matrix(b.column(0))
            n, s, q = n + len(x), s + x.sum(0), q + (x * x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([s.tobytes()]), pa.array([q.tobytes()])],
                                         names=["n", "s", "q"])

    def add(parts, name):
        return np.sum([np.frombuffer(p[name]) for p in parts], axis=0)

    n, mean_y, low, high = moments
    if not n or low == high:
        flat = np.full(2, 0.5 if not n else mean_y)
        return QualityModel(np.zeros(d), np.ones(d), weight, phase, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), flat)
    # max_rows rows of d numbers: a few tasks, whose sums have a fixed size
    few = rows.coalesce(8)
    parts = few.select("stats").mapInArrow(sums, "n bigint, s binary, q binary").collect()
    mean = add(parts, "s") / n
    scale = np.sqrt(np.maximum(add(parts, "q") / n - mean**2, 0)) + 0.02
    model = QualityModel(mean, scale, weight, phase, np.zeros(FEATURES + 1), np.zeros(2), np.zeros(2))

    def normal(batches):
        m = FEATURES + 1
        zz, zy = np.zeros((FOLDS, m, m)), np.zeros((FOLDS, m))
        for whole in batches:
            for b in blocks(whole):
                z, y, fold = model.features(_matrix(b.column(2))), b.column(0).to_numpy(), b.column(1).to_numpy()
                for k in range(FOLDS):
                    zk = z[fold == k]
                    zz[k] += zk.T @ zk
                    zy[k] += zk.T @ y[fold == k]
        yield pa.RecordBatch.from_arrays([pa.array([zz.tobytes()], pa.binary()), pa.array([zy.tobytes()], pa.binary())],
                                         names=["zz", "zy"])

    parts = few.select("y", "fold", "stats").mapInArrow(normal, "zz binary, zy binary").collect()
    zz = add(parts, "zz").reshape(FOLDS, FEATURES + 1, FEATURES + 1)
    zy = add(parts, "zy").reshape(FOLDS, FEATURES + 1)

    def solve(a, b):
        penalty = RIDGE * np.eye(len(b)) * max(1.0, n * 2.0 / FEATURES)
        penalty[0, 0] = 1e-9
        return np.linalg.solve(a + penalty, b)

    held = [solve(zz.sum(0) - zz[k], zy.sum(0) - zy[k]) for k in range(FOLDS)]
    model.coef = solve(zz.sum(0), zy.sum(0))

    def scored(batches):
        for whole in batches:
            for b in blocks(whole):
                x, fold = _matrix(b.column(2)), b.column(1).to_numpy()
                raw = np.select([fold == k for k in range(FOLDS)], [model.raw(x, held[k]) for k in range(FOLDS)])
                at = np.clip(np.floor((raw + 0.5) / 2 * GRID), 0, GRID - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at), b.column(0)], names=["bin", "y"])

    bins = (few.select("y", "fold", "stats").mapInArrow(scored, "bin int, y double")
            .groupBy("bin").agg(F.count(F.lit(1)).alias("w"), F.avg("y").alias("y")).orderBy("bin").collect())
    x = (np.array([r["bin"] for r in bins]) + 0.5) / GRID * 2 - 0.5
    model.cal_x, model.cal_y = isotonic(x, np.array([r["y"] for r in bins]), np.array([float(r["w"]) for r in bins]))
    return model


def score_documents(docs: DataFrame, model: QualityModel, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
                    out: str = "score") -> DataFrame:
    """(*carry, out double): the calibrated score of every whole text."""
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    own = text_col if text_col in carry else "__t"       # a carried text is sent once
    rows = docs.select(*carry) if own in carry else docs.select(*carry, F.col(text_col).alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in blocks(whole):
                x = np.array([document_stats(t.as_py()) for t in b.column(own).cast(pa.binary())]).reshape(b.num_rows, N_STATS)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), pa.array(model.score(x), pa.float64())],
                                                 names=[*carry, out])

    return rows.mapInArrow(run, f"{fields}, `{out}` double")
