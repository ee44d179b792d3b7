"""Hilbert-curve sharding (DataFrame functions only).

Several metadata dimensions are quantised to the same number of bits, at
quantiles of their values and in the order of their values, so a file's minimum
and maximum stay meaningful.  Rows are sorted by the index of their cell on the
Hilbert curve, and runs of that order become shards: neighbouring cells share
shards, and every shard covers a compact box of all dimensions, which is what
lets a reader prune files on any of them.

Laws: ``rows`` (counts at most one apart) and ``bytes`` (runs cut at equal sums
of sizes).  Ties on the curve are ordered by text hash, then by id, so equal
texts with equal metadata stand together.  The order key ends in a number of
its own for each row, so a group of any size, also of repeats of one row, is
spread over many sort partitions.

Defined results: nulls are the smallest value of a dimension; a null text has
size 1 and the checksum of the empty text; repeated rows keep a row each; fewer
rows than shards leave the last shards empty; an empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .syncmers import _bucket

BITS = 6
ROW = "__row"


def order_number(col, kind: str) -> F.Column:
    """A bigint that orders like ``col``: numbers as they are, strings by their
    first seven bytes; null first."""
    if kind in ("string", "binary"):
        lead = F.rpad(F.hex(F.substring(col.cast("binary"), 1, 7)), 14, "0")
        return F.coalesce(F.conv(lead, 16, 10).cast("bigint"), F.lit(-1))
    return F.coalesce(col.cast("bigint"), F.lit(-(2**62)))


def hilbert_index(cells: list, bits: int) -> F.Column:
    """Index on the Hilbert curve of a cell given by ``bits``-bit coordinates,
    most significant bits first: each level's octant is read in the frame of
    the previous one (entry corner ``e``, axis ``d``)."""
    n = len(cells)
    if not 2 <= n <= 8 or n * bits > 62:
        raise ValueError("2 to 8 dimensions of at most 62 bits in all")
    mask = (1 << n) - 1

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def entry(i: int) -> int:
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def axis(i: int) -> int:
        if i == 0:
            return 0
        j = i - 1 if i % 2 == 0 else i
        return ((j ^ (j + 1)).bit_length() - 1) % n

    def ints(f):
        return F.array(*[F.lit(f(i)) for i in range(1 << n)])

    inverse = [0] * (1 << n)
    for i in range(1 << n):
        inverse[gray(i)] = i
    entries, axes, inverses = ints(entry), ints(axis), ints(lambda i: inverse[i])

    def turn(x, by, left: bool):
        """Rotate n bits."""
        to = F.when(by % n == 0, x)
        for k in range(1, n):
            a, b = (k, n - k) if left else (n - k, k)
            to = to.when(by % n == k, F.shiftleft(x, a).bitwiseOR(F.shiftright(x, b)).bitwiseAND(F.lit(mask)))
        return to

    coords = F.array(*cells)

    def level(state, i):
        corner = F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0), lambda a, j: a.bitwiseOR(
            F.call_function("shiftleft", F.call_function("shiftright", F.get(coords, j), i).bitwiseAND(F.lit(1)), j)))
        e, d = state["e"], state["d"]
        w = F.get(inverses, turn(corner.bitwiseXOR(e), d + 1, left=False))
        return F.struct((state["h"] * (1 << n) + w).alias("h"),
                        e.bitwiseXOR(turn(F.get(entries, w), d + 1, left=True)).alias("e"),
                        ((d + F.get(axes, w) + 1) % n).alias("d"))

    start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, level, lambda x: x["h"])


def quantised(df: DataFrame, dims: dict[str, str], bits: int) -> DataFrame:
    """Add ``__cell_i`` for each dimension (column -> type): its bin between
    quantiles, 2**bits bins; only the bin edges reach the driver."""
    cells = 1 << bits
    probs = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    numbers = {c: order_number(F.col(c), k) for c, k in dims.items()}
    edges = df.agg(*[F.percentile_approx(n, probs, F.lit(100 * cells)).alias(f"e{i}")
                     for i, n in enumerate(numbers.values())]).first()
    for i, n in enumerate(numbers.values()):
        df = df.withColumn(f"__cell_{i}", _bucket(sorted(set(edges[i] or [])), n))
    return df


def hilbert_shards(docs: DataFrame, n_shards: int, dims: tuple[str, ...] = ("lang", "source", "n_chars"),
                   law: str = "rows", bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, curve, law, shard, slot) for every row: ``curve``
    is the cell's index, ``slot`` the place in the shard, from 0 without gaps."""
    return _placed(docs.withColumn(ROW, F.monotonically_increasing_id()), n_shards, dims, law, bits, id_col,
                   text_col).drop(ROW)


def _placed(docs: DataFrame, n_shards: int, dims: tuple[str, ...], law: str, bits: int, id_col: str,
            text_col: str) -> DataFrame:
    """:func:`hilbert_shards` of rows numbered in ``ROW``, which is kept."""
    if law not in ("rows", "bytes"):
        raise ValueError("law is 'rows' or 'bytes'")
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = {c: docs.schema[c].dataType.simpleString() for c in dims}
    small = quantised(docs.select(ROW, id_col, *[c for c in dims if c != id_col], text_col), kinds, bits)
    small = small.select(
        ROW, F.col(id_col), F.octet_length(text).cast("bigint").alias("bytes"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("th"), hilbert_index([F.col(f"__cell_{i}") for i in range(len(dims))], bits).alias("curve"))
    small = small.withColumn("size", F.col("bytes") + 1).drop("bytes")
    order = ["curve", "th", id_col, ROW]
    # metadata only: ranges of the whole order key, numbered and kept, so numbers can't change on a retry
    parts = stage(small.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "curve")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    offsets = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                          F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"))   # one row per partition
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    within = Window.partitionBy("part").orderBy(*order)
    ranked = (parts.join(F.broadcast(offsets), "part")
              .withColumn("rank", F.col("n0") + F.row_number().over(within) - 1)
              .withColumn("ahead", F.col("b0") + F.sum("size").over(
                  within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")))
    rows, size = int(total[0]), int(total[1])
    if law == "rows":
        q, r = divmod(rows, n_shards)
        cut = r * (q + 1)
        rank = F.col("rank")
        low = rank < cut
        shard = F.when(low, F.floor(rank / (q + 1))).otherwise(r + F.floor((rank - cut) / max(q, 1)))
        first = F.when(low, shard * (q + 1)).otherwise(cut + (shard - r) * q)
        out = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (rank - first).cast("bigint"))
    else:
        mid = F.col("ahead") + F.col("size") / 2
        ranked = ranked.withColumn("shard", F.least(F.floor(mid * n_shards / max(size, 1)), F.lit(n_shards - 1)).cast("int"))
        firsts = ranked.groupBy("shard").agg(F.min("rank").alias("first"))
        out = ranked.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("rank") - F.col("first"))
    return out.select(ROW, id_col, "size", "text_crc32", "curve", F.lit(law).alias("law"), "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int, dims: tuple[str, ...] = ("lang", "source", "n_chars"),
                 bits: int = BITS, **options) -> None:
    """Write ``docs`` as one folder per shard, each file in curve order (so row
    groups prune too).  Rows are matched to their places by a number of their
    own, so null ids and repeated rows are written like any other."""
    docs = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")   # kept: same numbers in both uses
    settings = {"law": "rows", "id_col": "doc_id", "text_col": "text"} | options
    placed = _placed(docs, n_shards, dims, bits=bits, **settings).select(ROW, "shard", "slot")
    (docs.join(placed, ROW).drop(ROW)
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop("slot")
     .write.partitionBy("shard").parquet(path))
