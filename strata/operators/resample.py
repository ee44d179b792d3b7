"""Leakage-safe grouped resampling.

Randomness comes from ``hash_order`` (md5 of seed:salt:key), so folds,
draws and permutations are identical under any partitioning, survive a
recomputed partition, and can be re-derived in SQL.  A group (entity) is
never split across folds or draws.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_order
from ..specs import GLOBAL_SEED, LEARNING_CURVE_FRACTIONS, OUTER_CV_SPLITS
from .bijection import bijection_constants, positions
from .draws import draw_blocks, drawn_classes, group_weights
from .kernels import global_rank, materialize, prefix_sums


class ResamplingError(RuntimeError):
    pass


def group_profiles(df: DataFrame, group: str, label: str) -> DataFrame:
    """Per group: positives and negatives (partial aggregate; a group that
    holds a third of all rows is combined map-side)."""
    y = F.col(label)
    return df.groupBy(group).agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("n_pos"),
                                 F.sum(F.when(y == 0, 1).otherwise(0)).cast("bigint").alias("n_neg"))


def stratified_group_folds(df: DataFrame, group: str, label: str, k: int = OUTER_CV_SPLITS,
                           seed: int = GLOBAL_SEED, out: str = "fold") -> DataFrame:
    """G1: group -> fold in 0..k-1.

    Groups are ordered by class-count profile (n_pos, n_neg), then by a seeded
    hash, and dealt round robin: every fold gets an equal share (+-1) of the
    groups of every profile, so class balance and fold size match closely and
    a group is never split.  The order is a distributed rank (profile offset +
    bucketed rank by hash inside the profile), not a single-task sort.
    Returns (group, fold).
    """
    g = group_profiles(df, group, label).withColumn("__h", hash_order(seed, "fold", F.col(group)))
    ranked = global_rank(g, ["n_pos", "n_neg"], "__h", tiebreak=[group], out="__r")
    prof = g.groupBy("n_pos", "n_neg").agg(F.count(F.lit(1)).alias("__cnt"))
    # with long-tailed groups there are nearly as many profiles as groups: X1, not one window
    offs = (prefix_sums(prof, [], "n_pos", ["__cnt"], prefix="__before", tiebreak=["n_neg"])
            .select("n_pos", "n_neg", F.col("__before__cnt").alias("__off")))
    return (ranked.join(offs, ["n_pos", "n_neg"])
            .select(F.col(group), ((F.col("__r") + F.col("__off")) % k).cast("int").alias(out)))


def assign_folds(df: DataFrame, group: str, label: str, k: int = OUTER_CV_SPLITS,
                 seed: int = GLOBAL_SEED, out: str = "fold") -> DataFrame:
    """Rows with their group's fold (join on the group key)."""
    return df.join(stratified_group_folds(df, group, label, k, seed, out), group, "inner")


def fold_findings(rows_with_folds: DataFrame, group: str, fold: str = "fold") -> DataFrame:
    """Invariant: a group is in exactly one fold (count of violating groups)."""
    bad = rows_with_folds.groupBy(group).agg(F.countDistinct(fold).alias("__k")).filter(F.col("__k") > 1)
    return bad.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit("group_in_one_fold").alias("finding"),
        F.when(F.col("n") > 0, "error").otherwise("ok").alias("severity"),
        F.lit(group).alias("variable"), "n")


def oof_assemble(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of the per-fold held-out predictions."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def oof_findings(oof: DataFrame, eligible: DataFrame, key: str) -> DataFrame:
    """G2 check: every eligible row predicted exactly once."""
    dup = oof.groupBy(key).count().filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n"))
    missing = eligible.select(key).join(oof.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    def f(name, d):
        return d.select(F.lit(name).alias("finding"),
                        F.when(F.col("n") > 0, "error").otherwise("ok").alias("severity"),
                        F.lit(key).alias("variable"), F.col("n").cast("bigint").alias("n"))
    return f("oof_duplicate", dup).unionByName(f("oof_missing", missing))


def assert_oof_complete(oof: DataFrame, eligible: DataFrame, key: str) -> None:
    bad = [r for r in oof_findings(oof, eligible, key).collect() if r.n]
    if bad:
        raise ResamplingError(f"rows without exactly one held-out prediction: {bad}")


def group_index(df: DataFrame, group: str, seed: int = GLOBAL_SEED) -> DataFrame:
    """Groups numbered 0..G-1 in seeded-hash order (distributed rank)."""
    g = df.select(group).distinct().withColumn("__h", hash_order(seed, "group", F.col(group)))
    return global_rank(g, [], "__h", tiebreak=[group], out="group_idx").select(group, "group_idx")


def bootstrap_draws(spark, n_groups: int, reps: Sequence[int] | int, seed: int = GLOBAL_SEED) -> DataFrame:
    """(rep, group_idx, weight): each replicate draws ``n_groups`` group
    indices with replacement; weight = times drawn.  Draws are generated
    by ``range`` (rep x draw, no join) and combined map-side."""
    if isinstance(reps, int):
        reps = range(reps)
    reps = list(reps)
    lo, hi = min(reps), max(reps) + 1
    d = spark.range(lo * n_groups, hi * n_groups)
    d = d.select(F.expr(f"id div {int(n_groups)}").alias("rep"), (F.col("id") % n_groups).alias("draw"))
    if len(reps) != hi - lo:
        d = d.filter(F.col("rep").isin(reps))
    idx = hash_order(seed, "draw", F.col("rep"), F.col("draw")) % n_groups
    return d.groupBy("rep", idx.alias("group_idx")).agg(F.count(F.lit(1)).alias("weight"))


FIRST_DRAWS = 64


def first_draws(spark, n_groups: int, reps: Sequence[int], n: int, seed: int = GLOBAL_SEED) -> DataFrame:
    """(rep, group_idx) of the first ``n`` draws of each replicate, a row each."""
    ids = spark.createDataFrame([(int(r),) for r in reps], "rep long")
    draws = ids.select("rep", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw"))
    return draws.select("rep", (hash_order(seed, "draw", F.col("rep"), F.col("draw")) % n_groups).alias("group_idx"))


def valid_replicates(df: DataFrame, group: str, label: str, n_boot: int, seed: int = GLOBAL_SEED,
                     max_attempt_factor: int = 10) -> tuple[list[int], DataFrame, int]:
    """Ids of ``n_boot`` replicates whose drawn rows hold both classes, the numbered
    groups and their count.  Invalid attempts are skipped and the next ids drawn (at most
    ``max_attempt_factor * n_boot`` attempts), like the reference's redraw."""
    spark = df.sparkSession
    gidx = group_index(df, group, seed)
    prof = materialize(group_profiles(df, group, label).join(gidx, group))      # one row per group, read for every batch
    gidx = prof.select(group, "group_idx")
    n_groups = prof.count()
    has = prof.select("group_idx", ((F.col("n_pos") > 0).cast("int") + 2 * (F.col("n_neg") > 0).cast("int")).alias("has"))

    def both(flags: DataFrame) -> set[int]:
        return {r.rep for r in flags.filter("has = 3").select("rep").collect()}          # at most n_boot ids

    valid_reps: list[int] = []
    start = 0
    while n_groups and len(valid_reps) < n_boot and start < max_attempt_factor * n_boot:
        batch = list(range(start, min(start + (n_boot - len(valid_reps)), max_attempt_factor * n_boot)))
        # most replicates show both classes in their first draws; only the others are drawn whole
        few = first_draws(spark, n_groups, batch, min(n_groups, FIRST_DRAWS), seed)
        ok = both(few.join(has, "group_idx").groupBy("rep").agg(F.bit_or("has").alias("has")))
        rest = [r for r in batch if r not in ok]
        if rest and n_groups > FIRST_DRAWS:
            ok |= both(drawn_classes(draw_blocks(spark, n_groups, rest, seed), has, n_groups))
        ok = sorted(ok)
        valid_reps.extend(ok[: n_boot - len(valid_reps)])
        start = batch[-1] + 1
    if len(valid_reps) < n_boot:
        raise ResamplingError(f"{len(valid_reps)} of {n_boot} replicates hold both classes after {start} attempts")
    return valid_reps, gidx, n_groups


def cluster_bootstrap(df: DataFrame, group: str, label: str, n_boot: int, seed: int = GLOBAL_SEED,
                      max_attempt_factor: int = 10) -> DataFrame:
    """(rep, group, weight) for ``n_boot`` valid replicates.  Weights replace row
    duplication: a weighted metric over (rows x weight) equals the metric over the
    duplicated rows."""
    reps, gidx, n_groups = valid_replicates(df, group, label, n_boot, seed, max_attempt_factor)
    return group_weights(draw_blocks(df.sparkSession, n_groups, reps, seed), gidx, group, n_groups)


MAX_LEVELS = 100        # distinct values that a permuted column may have as thresholds; more are joined by position


def permute_labels(df: DataFrame, key: str, label: str, n_perm: int, seed: int = GLOBAL_SEED,
                   out: str | None = None, salt: str = "perm") -> DataFrame:
    """For b in 0..n_perm-1, a global permutation of ``label`` over rows.
    Returns (b, key, permuted label).

    Rows are ranked once in a seeded order (X4); replicate b sends a row's rank to a place
    by a seeded bijection.  Places are dealt to the values in order (null first), so with
    up to ``MAX_LEVELS`` distinct values the permuted value is a comparison with their
    cumulative counts: no shuffle.  With more, places are dealt by rank and the one value
    is joined by place."""
    out = out or f"{label}_permuted"
    ranked = materialize(global_rank(df.select(key, label).withColumn("__h", hash_order(seed, f"{salt}:key", F.col(key))),
                                     [], "__h", tiebreak=[key], out="__rank"))
    n = ranked.count()
    constants = bijection_constants(seed, salt)
    kind = ranked.schema[key].dataType.simpleString()

    def places(batches):
        which, step = np.arange(n_perm), max(1, 500_000 // max(1, n_perm))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                place = positions(batch.column("__rank").to_numpy(), which, n, constants)
                row = pa.array(np.repeat(np.arange(batch.num_rows), n_perm))
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(which, batch.num_rows)), batch.column(key).take(row), pa.array(place.ravel())],
                                                 names=["b", key, "__place"])

    moved = ranked.select(key, "__rank").mapInArrow(places, f"b bigint, `{key}` {kind}, __place bigint")
    levels = ranked.groupBy(label).agg(F.count(F.lit(1)).alias("c")).orderBy(F.col(label).asc_nulls_first()).limit(MAX_LEVELS + 1).collect()
    if len(levels) > MAX_LEVELS:
        donors = ranked.select(F.col("__rank").alias("__place"), F.col(label).alias(out))
        return moved.join(donors, "__place").select("b", key, out)
    kind = df.schema[label].dataType
    value, upto = F, 0
    for level in levels:
        upto += level["c"]
        value = value.when(F.col("__place") < upto, F.lit(level[0]).cast(kind))
    if not levels:
        value = F.lit(None).cast(kind)
    return moved.select("b", key, value.alias(out))


def permute_column(df: DataFrame, key: str, column: str, n_repeats: int, seed: int = GLOBAL_SEED) -> DataFrame:
    """One predictor shuffled (per repeat); same plan as G4."""
    return permute_labels(df, key, column, n_repeats, seed, out=f"{column}_permuted", salt=f"col:{column}")


def nested_group_subsets(df: DataFrame, group: str, label: str,
                         fractions: Sequence[float] = LEARNING_CURVE_FRACTIONS,
                         seed: int = GLOBAL_SEED) -> DataFrame:
    """One seeded group order; fraction f keeps the first
    max(2, ceil(f * G)) groups (nested subsets).  Returns
    (fraction, n_groups, rows, positives, usable) where ``usable`` is false
    for a single-class subset (the reference skips those)."""
    prof = group_profiles(df, group, label)
    idx = group_index(df, group, seed)
    g = materialize(prof.join(idx, group))        # one row per group, read once per fraction
    n_groups = g.count()
    rows = []
    for f in fractions:
        n_f = max(2, int(math.ceil(float(f) * n_groups)))
        rows.append(g.filter(F.col("group_idx") < n_f).agg(
            F.lit(float(f)).alias("fraction"), F.lit(n_f).cast("bigint").alias("n_groups"),
            F.sum(F.col("n_pos") + F.col("n_neg")).cast("bigint").alias("n_rows"),
            F.sum("n_pos").cast("bigint").alias("positives")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("usable", (F.col("positives") > 0) & (F.col("positives") < F.col("n_rows")))


def subset_rows(df: DataFrame, group: str, fraction: float, seed: int = GLOBAL_SEED) -> DataFrame:
    """Rows of the nested subset for one fraction (left-semi on group rank)."""
    idx = group_index(df, group, seed)
    n_f = max(2, int(math.ceil(float(fraction) * idx.count())))
    return df.join(idx.filter(F.col("group_idx") < n_f).select(group), group, "left_semi")
