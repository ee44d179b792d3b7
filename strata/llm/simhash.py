"""SimHash near-duplicates by multi-index hashing.

Fingerprint: majority bits of the 64-bit hashes (XXH64, seed 42) of a text's
word shingles.  Two texts link when their fingerprints differ in at most
``max_bits`` bits; ``simhash_components`` returns the connected components.

Search.  The fingerprint is cut into ``segments`` segments, with one table per
segment: (segment, value of its bits).  If two fingerprints differ in at most k
bits, some segment differs in at most k // segments of them, so every
fingerprint looks up, in each table, the Hamming ball of that radius around its
own value; a match is verified on the complete distance.  A value shared by
more than ``HOT`` fingerprints is not looked up but refined: its fingerprints
go on to tables of that value and one segment more, whose radius follows from
the bits still allowed and the segments still left.  A key of all segments is
one fingerprint, so a lookup meets at most ``HOT`` rows however the values are
skewed, no pairs of a group are formed, and no link is lost.

Defined results: null or empty text (no words) has fingerprint zero and links
like any other; fewer words than the shingle length: the whole sequence is the
one shingle; repeated rows and equal texts share a fingerprint and hence a
component; a null id is returned as null and never names a component that has
another id; rows of one id (or of none) with different texts are not linked by
it; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH, files_for, id_back, id_key, stage
from .components import connected_components

HOT = 64                 # fingerprints; a segment value with more of them is refined by one more segment
MOST_FLIPS = 100_000     # values of one Hamming ball


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of one text."""
    words = (text or b"").lower().split()        # bytes: A-Z and ASCII white space only
    n = len(words)
    if n == 0:
        return 0
    line = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = np.array([h(line, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = np.fromiter((h(line[a:b], seed) for a, b in
                              zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)),
                             np.uint64, n - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):    # bounded memory for very long texts
        block = np.ascontiguousarray(hashes[at: at + (1 << 16)]).astype("<u8").view(np.uint8)
        ones += np.unpackbits(block, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def simhash_fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                         carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, *carry, fp bigint), one row per input row."""
    keep = [id_col, *carry]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column("__t").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fps, pa.int64())], names=[*keep, "fp"])

    return docs.select(*keep, F.col(text_col).cast("binary").alias("__t")).mapInArrow(run, f"{kinds}, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _segments(segments: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each segment; widths differ by one at most."""
    cuts = [64 * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in flipped) for n in range(min(width, radius) + 1) for flipped in combinations(range(width), n)]


def _extend(rows: DataFrame, parts: list[tuple[int, int]], left: int, max_bits: int, radius: int) -> DataFrame:
    """Keys of one segment more.  ``rows``: (bits, part, fp), the segments in the key as a bit mask, their value
    and the fingerprint; ``left`` segments are not in the key yet.  With ``radius`` 0 only own values."""
    each = F.array(*[F.struct(F.lit(at).alias("at"), F.lit(_signed((2**width - 1) << at)).cast("bigint").alias("bits"))
                     for at, width in parts])
    used, own = F.col("bits"), F.col("fp").bitwiseAND(F.col("s.bits"))
    out = rows.withColumn("s", F.explode(each)).filter(used.bitwiseAND(F.col("s.bits")) == 0)
    if radius:
        flips = F.expr("array(" + ", ".join(f"{m}L" for m in map(_signed, _ball(max(w for _, w in parts), radius))) + ")")
        spent = F.bit_count(F.col("part").bitwiseXOR(F.col("fp").bitwiseAND(used)))
        out = (out.withColumn("m", F.explode(flips)).withColumn("f", F.expr("shiftleft(m, s.at)"))
               # the flips must lie in the segment (the widest one gives the ball) and within the bits still allowed
               .filter((F.col("f").bitwiseAND(F.col("s.bits")) == F.col("f")) & (F.bit_count("f") == F.bit_count("m"))
                       & (spent + F.bit_count("m") * left <= max_bits)))
        own = own.bitwiseXOR(F.col("f"))
    return out.select(used.bitwiseOR(F.col("s.bits")).alias("bits"), F.col("part").bitwiseOR(own).alias("part"), "fp")


def simhash_links(fingerprints: DataFrame, max_bits: int = 2, segments: int = 4) -> DataFrame:
    """Links between distinct fingerprints: (src, dst, bits), src > dst.  ``fingerprints``: distinct ``fp``.
    Each link is verified on the complete distance."""
    if not (1 <= segments <= 64 and 0 <= max_bits <= 64):
        raise ValueError("segments must be 1..64 and max_bits 0..64")
    parts = _segments(segments)
    widest = max(w for _, w in parts)
    if sum(comb(widest, n) for n in range(min(widest, max_bits) + 1)) > MOST_FLIPS:
        raise ValueError("the last segment's Hamming ball is too large: use more segments or fewer bits")
    key = ["bits", "part"]
    files = files_for(fingerprints)
    table = probe = fingerprints.select(F.lit(0).cast("bigint").alias("bits"), F.lit(0).cast("bigint").alias("part"), "fp")
    found = []
    for level in range(segments):
        left = segments - level
        radius = max_bits // left
        same = probe is table and not radius
        lists = [_extend(table, parts, left, max_bits, 0)]
        if not same:
            lists.append(_extend(probe, parts, left, max_bits, radius))
        if level:                                # a set of segments is reached in several orders
            lists = [stage(x.distinct(), "keys", files=files) for x in lists]
        table, probe = lists[0], lists[-1]
        last = level == segments - 1
        hot = None
        if not last:
            hot = stage(table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select(key), "hot", files=files)
            last = hot.isEmpty()
        cold = table if last else table.join(hot, key, "left_anti")
        met = probe.alias("p").join(cold.alias("t"), key)
        distance = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp")))
        found.append(met.filter((F.col("p.fp") > F.col("t.fp")) & (distance <= max_bits))
                     .select(F.col("p.fp").alias("src"), F.col("t.fp").alias("dst"), distance.alias("bits")))
        if last:
            break
        table = table.join(hot, key, "left_semi")
        probe = table if same else probe.join(hot, key, "left_semi")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links.distinct()


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2, segments: int = 4,
                       id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, *carry, fp bigint, class bigint, component_id): class is the smallest fingerprint and component_id the
    smallest id reachable over links, the row's own included."""
    fps = stage(simhash_fingerprints(docs, shingle, id_col, text_col, carry), "fingerprints", BATCH)
    distinct = stage(fps.groupBy("fp").agg(F.min(id_key(F.col(id_col))).alias("__least")), "distinct")
    links = simhash_links(distinct.select("fp"), max_bits, segments).select("src", "dst")
    comp = connected_components(links, files_for(distinct)).withColumnRenamed("node", "fp")          # linked fingerprints only
    least = comp.join(distinct, "fp").groupBy("component").agg(F.min("__least").alias("__c"))
    classes = (distinct.join(comp.join(least, "component"), "fp", "left")
               .select("fp", F.coalesce("component", "fp").alias("class"), F.coalesce("__c", "__least").alias("__c")))
    return fps.join(classes, "fp").select(F.col(id_col), *carry, "fp", "class", id_back(F.col("__c")).alias("component_id"))
