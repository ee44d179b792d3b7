"""Scalable rank kernels (X1, X3, X4) shared by metrics, resampling and
conformal quantiles.

The reference sorts whole arrays in memory or loops over all pairs.  Here
every ordered scan runs on *distinct keys* (pre-aggregated, so a hot value
is one row), split into buckets by fixed key boundaries; a running window
works inside each bucket and a tiny per-bucket total table supplies the
offsets.  There is never a bare ``Window.orderBy`` over the whole table
(a single task), and bucket ids come from key values, not from
``spark_partition_id`` (which may change when a lost partition is rebuilt).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"


def materialize(df: DataFrame) -> DataFrame:
    """Write a pre-aggregated frame (a histogram of distinct keys, a table
    per group) to the shared checkpoint folder and read it back.

    The ordered scans below use their input several times (a boundary
    sketch, per-bucket totals, the running window); without this each use
    would re-read and re-aggregate the source, and filters inferred from
    join keys would be pushed into the source scan with every upstream
    expression inlined.  Reliable checkpoint (not a local one): a lost
    executor does not lose it.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _n_buckets(df: DataFrame, requested: int | None) -> int:
    if requested:
        return requested
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def key_splits(df: DataFrame, order_col: str, n_buckets: int) -> list[float]:
    """Bucket boundaries from an approximate quantile sketch (one bounded
    aggregate; only ``n_buckets`` numbers reach the driver)."""
    if n_buckets <= 1:
        return [float("-inf"), float("inf")]
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = [float(q) for q in df.approxQuantile(order_col, probs, 1.0 / (4 * n_buckets)) if q is not None]
    inner = set(qs)
    # a value returned for two or more quantiles holds more than 1/n_buckets
    # of the keys: give it a bucket of its own ([v, next float after v))
    for v in {q for q in qs if qs.count(q) > 1}:
        inner.add(float(np.nextafter(v, np.inf)))
    return [float("-inf"), *sorted(inner), float("inf")]


def bucketize(df: DataFrame, order_col: str, n_buckets: int | None = None,
              splits: Sequence[float] | None = None) -> DataFrame:
    """Add ``__bucket`` (equal keys always share a bucket); binary search
    over the boundaries runs JVM-side in ``Bucketizer``."""
    if splits is None:
        splits = key_splits(df, order_col, _n_buckets(df, n_buckets))
    if len(splits) < 3:                      # one bucket (e.g. a single distinct key)
        return df.withColumn(BUCKET, F.lit(0.0))
    tmp = "__bkey"
    b = Bucketizer(splits=list(splits), inputCol=tmp, outputCol=BUCKET, handleInvalid="keep")
    return b.transform(df.withColumn(tmp, F.col(order_col).cast("double"))).drop(tmp)


def prefix_sums(df: DataFrame, by: Sequence[str], order_col: str, sum_cols: Sequence[str],
                inclusive: bool = False, prefix: str = "cum_", n_buckets: int | None = None,
                tiebreak: Sequence[str] = (), descending: bool = False,
                materialized: bool = False) -> DataFrame:
    """For each row, the sum of ``sum_cols`` over rows of the same ``by``
    group that come earlier in ``order_col`` order (``inclusive`` adds the
    row itself).  Rows should be distinct on ``by + order_col (+ tiebreak)``.
    ``materialized``: the caller already checkpointed ``df``.
    """
    by = list(by)
    if not materialized:
        df = materialize(df)
    key = order_col
    if descending:
        key = "__neg_key"
        df = df.withColumn(key, -F.col(order_col).cast("double"))
    b = bucketize(df, key, n_buckets)
    part = by if by else [F.lit(0)]
    totals = b.groupBy(*by, BUCKET).agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    w_off = Window.partitionBy(*part).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, BUCKET, *[
        F.coalesce(F.sum(f"__t_{c}").over(w_off), F.lit(0)).alias(f"__o_{c}") for c in sum_cols])
    end = 0 if inclusive else -1
    w_in = (Window.partitionBy(*by, BUCKET).orderBy(key, *tiebreak)
            .rowsBetween(Window.unboundedPreceding, end))
    out = b.join(offsets, [*by, BUCKET], "inner")
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(w_in), F.lit(0)))
    drop = [BUCKET, *[f"__o_{c}" for c in sum_cols]] + (["__neg_key"] if descending else [])
    return out.drop(*drop)


def global_rank(df: DataFrame, by: Sequence[str], order_col: str, tiebreak: Sequence[str] = (),
                out: str = "rank", n_buckets: int | None = None, materialized: bool = False) -> DataFrame:
    """0-based row number in ``order_col`` (then ``tiebreak``) order within
    ``by``; distributed (bucketed prefix count), no single-task window."""
    one = "__one"
    ranked = prefix_sums(df.withColumn(one, F.lit(1).cast("bigint")), by, order_col, [one],
                         inclusive=False, prefix="__cum", n_buckets=n_buckets, tiebreak=tiebreak,
                         materialized=materialized)
    return ranked.withColumnRenamed(f"__cum{one}", out).drop(one)


def value_at_ranks(hist: DataFrame, by: Sequence[str], value_col: str, count_col: str,
                   targets: DataFrame, rank_col: str = "target_rank") -> DataFrame:
    """Order statistics: ``hist`` (materialized) has one row per distinct
    value with its count; ``targets`` (by + rank) asks for 0-based ranks.
    Returns targets joined with the value covering each rank.

    Totals per (group, bucket) give the rows ahead of each bucket; a target
    picks the one bucket that covers it, and only those buckets are ordered."""
    by = list(by)
    keys = [f"__k_{c}" for c in by]
    b = bucketize(hist, value_col).withColumnsRenamed(dict(zip(by, keys, strict=True)))
    part = keys or [F.lit(0)]
    totals = b.groupBy(*keys, BUCKET).agg(F.sum(count_col).alias("__t"))      # buckets per group: a bounded number
    ahead = Window.partitionBy(*part).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__ahead", F.coalesce(F.sum("__t").over(ahead), F.lit(0)))
    same = [F.col(c) == F.col(k) for c, k in zip(by, keys, strict=True)] or [F.lit(True)]
    covers = [F.col(rank_col) >= F.col("__ahead"), F.col(rank_col) < F.col("__ahead") + F.col("__t")]
    # equi-join on ``by``; without it both sides are tables of a bounded number of rows
    wanted = materialize(targets.join(totals, [*same, *covers]).select(*targets.columns, *keys, BUCKET, "__ahead"))
    needed = wanted.select(*keys, BUCKET).distinct()
    w = Window.partitionBy(*keys, BUCKET).orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    cum = (b.join(needed, [*keys, BUCKET], "left_semi").select(*keys, BUCKET, F.col(value_col).alias("value"), F.col(count_col).alias("__c"),
                                                   F.coalesce(F.sum(count_col).over(w), F.lit(0)).alias("__lo")))
    inside = F.col(rank_col) - F.col("__ahead")
    return (wanted.join(cum, [*keys, BUCKET]).filter((inside >= F.col("__lo")) & (inside < F.col("__lo") + F.col("__c")))
            .select(*targets.columns, "value"))


def exact_quantiles(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy default / DuckDB
    ``quantile_cont``) per ``by`` group without holding a group in one task:
    distinct-value histogram -> prefix counts -> the two order statistics
    around ``q * (n - 1)``.  Returns (by..., q, quantile)."""
    by = list(by)
    hist = materialize(df.filter(F.col(col).isNotNull()).groupBy(*by, col)
                       .agg(F.count(F.lit(1)).alias("__cnt")))
    return histogram_quantiles(hist, by, col, "__cnt", probs)


def histogram_quantiles(hist: DataFrame, by: Sequence[str], col: str, count_col: str,
                        probs: Sequence[float]) -> DataFrame:
    """``exact_quantiles`` of a materialized histogram: one row per ``by`` and
    distinct ``col`` with a positive whole count (a sum of integer weights)."""
    by = list(by)
    hist = hist.withColumnRenamed(count_col, "__cnt")
    n = hist.groupBy(*by).agg(F.sum("__cnt").alias("__n"))
    qarr = F.array(*[F.lit(float(q)) for q in probs])
    t = n.select(*by, "__n", F.explode(qarr).alias("q")).withColumn(
        "__h", F.col("q") * (F.col("__n") - 1))
    t = t.withColumn("__lo", F.floor("__h")).withColumn("__hi", F.ceil("__h"))
    targets = t.select(*by, "q", "__h", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("__lo").alias("target_rank")),
        F.struct(F.lit(1).alias("side"), F.col("__hi").alias("target_rank")))).alias("s")
    ).select(*by, "q", "__h", "s.side", "s.target_rank")
    vals = value_at_ranks(hist, by, col, "__cnt", targets)
    piv = vals.groupBy(*by, "q", "__h").agg(
        F.max(F.when(F.col("side") == 0, F.col("value"))).alias("__a"),
        F.max(F.when(F.col("side") == 1, F.col("value"))).alias("__b"))
    g = F.col("__h") - F.floor("__h")
    return piv.select(*by, "q", (F.col("__a") + g * (F.col("__b") - F.col("__a"))).alias("quantile"))
