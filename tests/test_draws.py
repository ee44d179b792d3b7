"""Packed bootstrap draws, permutation places and summed weight vectors."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import draws, replicates, resample
from strata.operators.bijection import HALF, PRIME, bijection_constants, halves, positions


def test_hashes_are_md5_at_every_length():
    for prefix, lo, hi in (("2024:draw:7:", 95, 1005), ("x" * 54, 7, 12), ("s:" * 40, 0, 3)):
        want = [int(hashlib.md5(f"{prefix}{k}".encode()).hexdigest()[:12], 16) for k in range(lo, hi)]
        assert draws.hash_range(prefix, lo, hi).tolist() == want


@pytest.mark.parametrize("unit", [draws.UNIT, 100])
def test_packed_draws_are_the_draws(spark, monkeypatch, unit):
    monkeypatch.setattr(draws, "UNIT", unit)
    n, reps = 700, [0, 2, 5]
    want = {(r.rep, r.group_idx): r.weight for r in resample.bootstrap_draws(spark, n, reps, 3).collect()}
    size = draws.block_size(n)
    got = Counter()
    for r in draws.draw_blocks(spark, n, reps, 3).collect():
        got.update((r.rep, r.block * size + int(i)) for i in np.frombuffer(r.drawn, np.uint16))
    assert got == want
    vectors = {r.group_idx: np.frombuffer(r.vector, np.uint16).tolist()
               for r in draws.weight_vectors(draws.draw_blocks(spark, n, reps, 3), reps, n).collect()}
    assert all(vectors[g][reps.index(r)] == w for (r, g), w in want.items())
    assert sum(map(sum, vectors.values())) == len(reps) * n


def test_whole_replicates_are_drawn_only_where_the_first_draws_lack_a_class(spark, monkeypatch):
    def never(*_):
        raise AssertionError("drawn whole")
    df = spark.range(400).select(F.col("id").alias("g"), (F.col("id") % 2).alias("y"))
    with monkeypatch.context() as m:
        m.setattr(resample, "draw_blocks", never)
        reps, _, n = resample.valid_replicates(df, "g", "y", 20)
    assert (reps, n) == (list(range(20)), 400)
    # one positive group: whole replicates decide, as their drawn rows do
    rare = spark.range(400).select(F.col("id").alias("g"), (F.col("id") == 7).cast("int").alias("y"))
    reps, groups, n = resample.valid_replicates(rare, "g", "y", 12)
    hot = groups.filter("g = 7").first().group_idx
    drawn = {r.rep for r in resample.bootstrap_draws(spark, n, range(reps[-1] + 1)).filter(F.col("group_idx") == hot).collect()}
    assert reps == sorted(drawn)[:12]


def test_no_row_per_replicate_and_group_is_shuffled(spark):
    df = spark.range(300).select(F.col("id").alias("g"), (F.col("id") % 2).alias("y"))
    plan = resample.cluster_bootstrap(df, "g", "y", 3)._jdf.queryExecution().executedPlan().toString()
    assert "group_idx" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x and "rep" in x)
    assert "hashpartitioning(block" in plan


def test_a_score_of_a_task_is_one_row_per_slice(spark):
    df = spark.range(10_000).select((F.col("id") % 3 / 10).alias("s"), F.col("id").alias("w")).coalesce(1)

    def expand(batch, which):
        w = batch.column("w").to_numpy()[:, None] + 0 * which
        return w, np.ones_like(w)

    rows = replicates.vector_histogram(df, "s", expand, 4).collect()
    assert len(rows) == 3
    for r in rows:
        k = round(r.score * 10)
        assert np.frombuffer(r.pos, np.int64).tolist() == [sum(range(k, 10_000, 3))] * 4
        assert np.frombuffer(r.neg, np.int64).tolist() == [len(range(k, 10_000, 3))] * 4


def test_places_are_those_of_the_walk_cell_by_cell():
    constants = bijection_constants(5, "t")

    def place(rank, b, n):
        a, c = halves(n)
        while True:
            left, right = divmod(rank, c)
            for i, (t1, t2, t3, s1, s2, s3) in enumerate(constants):
                key = ((b + t1) * (b + t1) % PRIME * t2 + t3) % PRIME % HALF
                mixed = ((right if i % 2 == 0 else left) + key + s1) ** 2 % PRIME * s2 + s3
                left, right = ((left + mixed % PRIME) % a, right) if i % 2 == 0 else (left, (right + mixed % PRIME) % c)
            rank = left * c + right
            if rank < n:
                return rank
    for n in (1, 2, 11, 1003, 40_000_003):
        ranks, which = np.arange(max(0, n - 9), n), np.array([0, 1, 999])
        assert positions(ranks, which, n, constants).tolist() == [[place(int(r), int(b), n) for b in which] for r in ranks]
