"""Many replicates at once: permutations by arithmetic and rank metrics of weight vectors.

*Permutations.*  Rows are ranked once; where replicate b sends a rank is arithmetic
(:mod:`.bijection`), so no table is copied or sorted per replicate.

*Vector-weighted AUC.*  Rows bring one weight per replicate and class.  Tasks add them up
per distinct score (a hot score is a row per task), slices of ``SLICE`` replicates apart;
the distinct scores are bucketed by range, each bucket gives its totals and its inner
sum per replicate, and a window over the buckets adds what stands before them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash_order
from .bijection import bijection_constants, positions
from .draws import draw_blocks, weight_vectors
from .kernels import BUCKET, bucketize, global_rank, key_splits, materialize
from .resample import valid_replicates

SLICE = 250
CELLS = 1_000_000                    # of a (rows x replicates) matrix in a task
HELD = 200_000                       # rows whose weights a task adds up before it passes them on


# -- vector-weighted AUC -----------------------------------------------------

Expand = Callable[[pa.RecordBatch, np.ndarray], tuple[np.ndarray, np.ndarray]]
Prepare = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches joined to at least ``rows`` rows (the last one has the rest)."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def vector_histogram(df: DataFrame, score: str, expand: Expand, n_replicates: int, prepare: Prepare = iter,
                     held: int = HELD) -> DataFrame:
    """(slice, score, pos, neg): per distinct score of ``held`` rows of a task the weights of
    both classes, a 64-bit integer per replicate of the slice.

    ``expand(batch, replicates)`` gives the rows' positive and negative weights
    (rows x replicates) for the replicate numbers of a slice; ``prepare`` may change
    the batches of a task before."""
    rows = df.withColumn("__score", F.col(score).cast("double"))
    replicates = [np.arange(a, min(a + SLICE, n_replicates)) for a in range(0, n_replicates, SLICE)]

    def cells(k: int, score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(score), k), pa.int32()), pa.array(score),
             pa.array([x.tobytes() for x in pos], pa.binary()), pa.array([x.tobytes() for x in neg], pa.binary())],
            names=["slice", "score", "pos", "neg"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // SLICE)
        for whole in _gathered(prepare(batches), held):
            s = whole.column("__score").to_numpy()
            order = np.argsort(s, kind="stable")
            whole, s = whole.take(pa.array(order)), s[order]
            for k, which in enumerate(replicates):
                last = None                              # the score that the next rows may go on with
                for at in range(0, whole.num_rows, step):
                    here = s[at:at + step]
                    first = np.flatnonzero(np.concatenate(([True], here[1:] != here[:-1])))
                    pos, neg = (np.add.reduceat(m, first, axis=0, dtype=np.int64) for m in expand(whole.slice(at, step), which))
                    score = here[first]
                    if last is not None and last[0][0] == score[0]:
                        pos[0] += last[1][0]
                        neg[0] += last[2][0]
                    elif last is not None:
                        yield cells(k, *last)
                    if len(first) > 1:
                        yield cells(k, score[:-1], pos[:-1], neg[:-1])
                    last = score[-1:], pos[-1:], neg[-1:]
                if last is not None:
                    yield cells(k, *last)

    return rows.mapInArrow(run, "slice int, score double, pos binary, neg binary")


def vector_auc(df: DataFrame, score: str, expand: Expand, n_replicates: int, prepare: Prepare = iter,
               held: int = HELD) -> DataFrame:
    """(replicate, pos, neg, roc_auc): the weighted AUC of every replicate, ties a half."""
    splits = key_splits(df.select(F.col(score).cast("double").alias("s")).filter("s IS NOT NULL"), "s",
                        max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))))
    hist = bucketize(vector_histogram(df, score, expand, n_replicates, prepare, held), "score", splits=splits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def done() -> pa.RecordBatch:
            part, bucket = key
            less, pos, neg, inner, sums = state["less"], state["pos"], state["neg"], state["inner"], state["sums"]
            inner = inner + pos * (less + 0.5 * neg)
            n = len(pos)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(part * SLICE, part * SLICE + n)), pa.array(np.full(n, bucket)),
                 pa.array(sums), pa.array(less + neg), pa.array(inner)], names=["replicate", "bucket", "pos", "neg", "inner"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("slice", BUCKET, "score", "pos", "neg")]
            for part, bucket, s, p, q in zip(*columns, strict=True):
                p, q = np.frombuffer(p, np.int64), np.frombuffer(q, np.int64)
                if (part, bucket) != key:
                    if key is not None:
                        yield done()
                    key = part, bucket
                    zero = np.zeros(len(p), np.int64)
                    state = {"score": None, "less": zero, "pos": zero, "neg": zero, "inner": zero.astype(float), "sums": zero}
                if s != state["score"]:                  # close the score before
                    state["inner"] = state["inner"] + state["pos"] * (state["less"] + 0.5 * state["neg"])
                    state["less"] = state["less"] + state["neg"]
                    state["score"], state["pos"], state["neg"] = s, p, q
                else:
                    state["pos"], state["neg"] = state["pos"] + p, state["neg"] + q
                state["sums"] = state["sums"] + p
        if key is not None:
            yield done()

    cells = (hist.repartition("slice", BUCKET).sortWithinPartitions("slice", BUCKET, "score")
             .mapInArrow(run, "replicate bigint, bucket double, pos bigint, neg bigint, inner double"))
    before = Window.partitionBy("replicate").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = (cells.withColumn("less", F.coalesce(F.sum("neg").over(before), F.lit(0)))
             .groupBy("replicate").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                       F.sum(F.col("inner") + F.col("pos").cast("double") * F.col("less")).alias("u")))
    return whole.select("replicate", "pos", "neg", F.try_divide("u", F.col("pos").cast("double") * F.col("neg")).alias("roc_auc"))


# -- replicates of a fixed score ---------------------------------------------

def _ranked(df: DataFrame, key: str, label: str, columns: list[str], seed, salt: str) -> tuple[DataFrame, int, int]:
    """Rows with their rank in the seeded order, their number and that of the positives."""
    ranked = materialize(global_rank(df.select(key, label, *columns).withColumn("__h", hash_order(seed, f"{salt}:key", F.col(key))),
                                     [], "__h", tiebreak=[key], out="__rank"))
    n, positives, valid = ranked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)),
                                     F.sum(F.col(label).isin(0, 1).cast("int"))).first()
    if n and valid != n:
        raise ValueError(f"{label} must be 0 or 1 in every row")
    return ranked, n, positives


def permuted_positives(df: DataFrame, key: str, label: str, n_perm: int, seed, salt: str = "perm") -> DataFrame:
    """(key, replicates, times_positive, replicate_sum): how many of the permutations of
    ``permute_labels`` make a row positive, and the sum of their numbers; a row stays one row."""
    ranked, n, positives = _ranked(df, key, label, [], seed, salt)
    constants = bijection_constants(seed, salt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        which, step = np.arange(n_perm), max(1, CELLS // max(1, n_perm))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                hit = positions(batch.column("__rank").to_numpy(), which, n, constants) >= n - positives
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(np.full(batch.num_rows, n_perm)), pa.array(hit.sum(axis=1)), pa.array(hit @ which)],
                    names=[key, "replicates", "times_positive", "replicate_sum"])

    kind = ranked.schema[key].dataType.simpleString()
    return ranked.select(key, "__rank").mapInArrow(run, f"`{key}` {kind}, replicates bigint, times_positive bigint, replicate_sum bigint")


def permutation_aucs(df: DataFrame, key: str, label: str, score: str, n_perm: int, seed, salt: str = "perm") -> DataFrame:
    """U6 metric mode, (replicate, pos, neg, roc_auc): AUC of ``score`` against each
    global permutation of the 0/1 ``label`` (those of ``permute_labels``).  Rows are
    ranked once; the positives have the last places, so a row is positive where its
    place in a replicate is one of them."""
    ranked, n, positives = _ranked(df, key, label, [score], seed, salt)
    constants = bijection_constants(seed, salt)

    def expand(batch: pa.RecordBatch, replicates: np.ndarray):
        hit = positions(batch.column("__rank").to_numpy(), replicates, n, constants) >= n - positives
        return hit, ~hit

    return vector_auc(ranked.select(F.col(score), "__rank"), score, expand, n_perm)


HELD_VECTORS = 20_000                # rows with weight vectors that a task holds
VECTOR_ROWS = 50_000                 # distinct (score, label) of a group that meet in one task


def bootstrap_aucs(df: DataFrame, group: str, label: str, score: str, n_boot: int, seed) -> DataFrame:
    """U5 metric mode, (rep, pos, neg, roc_auc): AUC of ``score`` in each valid cluster
    bootstrap replicate.  A group's draws are one vector of 16-bit weights; vectors and
    rows (aggregated by group, score and label) meet sorted by group, a large group
    split over several tasks with a copy of its vector each."""
    reps, groups, n_groups = valid_replicates(df, group, label, n_boot, seed)
    rows = (df.groupBy(group, F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("y"))
            .agg(F.count(F.lit(1)).alias("c")))
    parts = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / VECTOR_ROWS).cast("int").alias("parts"))
    drawn = weight_vectors(draw_blocks(df.sparkSession, n_groups, reps, seed), reps, n_groups)
    none = F.lit(bytearray(2 * n_boot))
    # the planner takes the vectors for a column of the few replicate numbers that they were drawn from and would
    # broadcast them all: sorted joins
    vectors = (groups.join(drawn.hint("merge"), "group_idx", "left").join(parts.hint("merge"), group)
               .select(group, F.coalesce("vector", none).alias("vector"), "parts"))
    vectors = vectors.select(group, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("is_row"),
                             "vector", F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("y"),
                             F.lit(None).cast("bigint").alias("c"))
    dealt = rows.join(parts, group).select(group, F.pmod(F.xxhash64("score"), F.col("parts")).cast("int").alias("part"),
                                           F.lit(1).alias("is_row"), F.lit(None).cast("binary").alias("vector"), "score", "y", "c")
    stream = (vectors.unionByName(dealt).repartition(group, "part").sortWithinPartitions(group, "part", "is_row")
              .select("is_row", "vector", "score", "y", "c"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_boot, np.uint16).tobytes()
        for batch in batches:
            is_row = batch.column("is_row").to_numpy() == 1
            here = [held, *batch.column("vector").filter(pa.array(~is_row)).to_pylist()]
            own = np.cumsum(~is_row)[is_row]             # the last vector before each row
            held = here[-1]
            b = batch.filter(pa.array(is_row))
            if b.num_rows:
                vector = pa.DictionaryArray.from_arrays(pa.array(own, pa.int32()), pa.array(here, pa.binary()))
                yield pa.RecordBatch.from_arrays([b.column("y"), b.column("c"), b.column("score"), vector],
                                                 names=["y", "c", "__score", "vector"])

    def expand(batch: pa.RecordBatch, replicates: np.ndarray):
        v = batch.column("vector")
        used, at = np.unique(v.indices.to_numpy(), return_inverse=True)
        all_of = np.stack([np.frombuffer(v.dictionary[k].as_py(), np.uint16)[replicates] for k in used.tolist()]).astype(np.int64)
        w = all_of[at] * batch.column("c").to_numpy()[:, None]
        y = batch.column("y").to_numpy()[:, None]
        return w * y, w * (1 - y)

    back = F.element_at(F.array(*[F.lit(r) for r in reps]), (F.col("replicate") + 1).cast("int")) if reps != list(range(n_boot)) \
        else F.col("replicate")
    return vector_auc(stream, "score", expand, n_boot, prepare, HELD_VECTORS).select(back.cast("bigint").alias("rep"), "pos", "neg", "roc_auc")
