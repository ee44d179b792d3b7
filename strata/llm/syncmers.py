"""Document fingerprints from closed syncmers (DataFrame functions only).

Symbols are words (runs of up to ``MAX_SYMBOL`` characters that are not white
space); in a longer run, as in text written without spaces, every character is
a symbol, so an edit in the run does not shift the symbols after it.  Of all ``K`` consecutive symbols a
k-mer is an anchor (a closed syncmer) when the smallest hash among its inner
runs of ``S`` symbols lies at its first or its last place.  That depends on the
k-mer alone, not on its context, so an unchanged stretch of text keeps its
anchors wherever it stands, and anchors with their positions can be matched
between texts.

The fingerprint is the ``SKETCH`` smallest distinct anchor hashes, 8 hex digits
each; the likeness of two fingerprints estimates the share of common anchors
(Jaccard, over the smallest hashes of their union) and is exact for texts with
no more anchors than that.

Defined results: null and empty texts (no symbols) have the empty fingerprint;
two empty fingerprints have likeness 1, one empty and one not 0; a text with
symbols but no anchor (fewer symbols than K, or 5 or 6 without a closed
syncmer): the whole sequence is the one anchor; equal texts have equal
fingerprints.  ``next_document`` orders by id (null first), then by text hash
for repeated ids; the last row's next is the first, a single row is its own.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, S, SKETCH, MAX_SYMBOL = 5, 2, 64, 16
HEX = 8


def symbols(text) -> F.Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?<!\S)\S{{1,{MAX_SYMBOL}}}(?!\S)|\S"), F.lit(0))


def _run(arrays: dict[int, F.Column], size: int, at) -> F.Column:
    """Hash of the run of ``size`` symbols at place ``at``: two runs of the greatest
    power of two below it, overlapped; ``arrays`` has the hashes of some sizes."""
    if size in arrays:
        return F.get(arrays[size], at)
    half = 1 << ((size - 1).bit_length() - 1)
    return F.xxhash64(_run(arrays, half, at), _run(arrays, half, at + (size - half)))


def _least(values: list) -> F.Column:
    return F.least(*values) if len(values) > 1 else values[0]


def with_anchors(df: DataFrame, text, name: str, k: int = K, s: int = S) -> tuple[DataFrame, dict, F.Column, object]:
    """Add, under the names returned second, the symbol hashes of ``text`` (a column)
    and those of all runs of ``s`` symbols.  Third is the array of the places (from 0)
    of its closed syncmers, fourth the function from a place to its anchor hash, which
    is so computed for anchors alone."""
    if not 1 < s < k:
        raise ValueError("1 < s < k")
    c = {x: f"__{name}_{x}" for x in ("w", "s")}
    df = df.withColumn(c["w"], F.transform(symbols(text), lambda x: F.xxhash64(x)))
    w = F.col(c["w"])
    starts = F.slice(w, 1, F.greatest(F.size(w) - (s - 1), F.lit(0)))
    df = df.withColumn(c["s"], F.transform(starts, lambda x, i: _run({1: w}, s, i)))
    arrays, last = {1: w, s: F.col(c["s"])}, k - s

    def closed(at):
        inner = [F.get(arrays[s], at + j) for j in range(1, last)]
        edge = F.least(F.get(arrays[s], at), F.get(arrays[s], at + last))
        return edge <= _least(inner) if inner else F.lit(True)

    places = F.when(F.size(w) >= k, F.sequence(F.lit(0), F.size(w) - k)).otherwise(F.array().cast("array<int>"))
    return df, c, F.filter(places, closed), lambda at: _run(arrays, k, at)


def _sketch(df: DataFrame, text, name: str, k: int, s: int, sketch: int) -> DataFrame:
    """Add ``name``: the sorted smallest distinct anchor hashes (32 bits)."""
    df, c, places, anchor = with_anchors(df, text, name, k, s)
    low = F.transform(places, lambda at: anchor(at).bitwiseAND(F.lit(0xFFFFFFFF)))
    df = df.withColumn(name, F.slice(F.sort_array(F.array_distinct(low)), 1, sketch))
    w = F.col(c["w"])
    whole = F.aggregate(w, F.size(w).cast("bigint"), lambda a, x: F.xxhash64(a, x)).bitwiseAND(F.lit(0xFFFFFFFF))
    df = df.withColumn(name, F.when((F.size(name) == 0) & (F.size(w) > 0), F.array(whole)).otherwise(F.col(name)))
    return df.drop(*c.values())


def fingerprint_text(sketch) -> F.Column:
    return F.concat_ws("", F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), HEX, "0"))))


def likeness(a, b, sketch: int = SKETCH) -> F.Column:
    """Estimated Jaccard of two sketches."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, sketch)
    common = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "sketch", k: int = K, s: int = S,
                 sketch: int = SKETCH) -> DataFrame:
    """``docs`` with ``out`` (array<bigint>): the sketch of every whole text."""
    return _sketch(docs, F.col(text_col), out, k, s, sketch)


def anchor_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                     s: int = S) -> DataFrame:
    """(id, pos, hash): every anchor with its symbol position."""
    df, _, places, anchor = with_anchors(docs.select(id_col, F.col(text_col).alias("__text")), F.col("__text"), "a", k, s)
    return df.select(id_col, F.explode(F.transform(places, lambda at: F.struct(at.alias("pos"), anchor(at).alias("hash"))))
                     .alias("a")).select(id_col, "a.pos", "a.hash")


def matched_offsets(left: DataFrame, right: DataFrame, pair: list[str]) -> DataFrame:
    """Positional matching of anchor tables that share the ``pair`` columns:
    (pair, shift, n) with n anchors that agree at one shift."""
    r = right.select(*pair, F.col("pos").alias("__pos"), "hash")
    return (left.join(r, [*pair, "hash"]).groupBy(*pair, (F.col("__pos") - F.col("pos")).alias("shift"))
            .agg(F.count(F.lit(1)).alias("n")))


def _bucket(splits: list[int], key) -> F.Column:
    """Number of ``splits`` that are <= key, by binary search in the row."""
    if not splits:
        return F.lit(0)
    table = F.array(*[F.lit(x).cast("bigint") for x in splits])
    steps = [1 << b for b in range(len(splits).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda at, step: F.when(
        (at + step <= len(splits)) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))


def next_document(docs: DataFrame, id_col: str, text_col: str, derive=lambda df: df, lead: dict[str, str] | None = None,
                  rows_per_bucket: int = 2000) -> DataFrame:
    """``derive(docs)`` with, for each ``lead`` entry (column -> new name), the
    value that the next document (ascending id) has.  Rows are cut into buckets
    of neighbouring ids at quantiles, so one shuffle and short per-bucket
    windows do it; the first row of the next bucket, one per bucket, stands
    at the end of each bucket.  ``derive`` must be row-wise."""
    lead = lead or {text_col: f"next_{text_col}"}
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63)))
    docs = docs.withColumn("__key", key).withColumn("__th", F.xxhash64(text_col))
    buckets = min(65536, max(1, math.ceil(docs.count() / rows_per_bucket)))
    splits: list[int] = []
    if buckets > 1:
        probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
        splits = sorted(set(docs.agg(F.percentile_approx("__key", probs, F.lit(10 * buckets))).first()[0]))
    docs = docs.withColumn("__bucket", _bucket(splits, F.col("__key")))
    heads = (docs.groupBy("__bucket").agg(F.min(F.struct("__key", "__th")).alias("h"))
             .select("__bucket", "h.*").orderBy("__bucket").collect())        # one row per bucket
    follow = [(heads[i - 1]["__bucket"], h["__key"], h["__th"]) for i, h in enumerate(heads)]
    starts = docs.sparkSession.createDataFrame(follow, "__of int, __key bigint, __th bigint")
    firsts = (docs.drop("__bucket").join(F.broadcast(starts), ["__key", "__th"]).withColumnRenamed("__of", "__bucket")
              .dropDuplicates(["__bucket"]))
    # the row that follows a bucket stands at its end: a join by bucket would hand the optimizer the formula of
    # __bucket, whose lambda it may infer as a filter of the other side, where __key does not exist
    rows = (derive(docs).withColumn("__last", F.lit(0))
            .unionByName(derive(firsts).withColumn("__last", F.lit(1))))
    order = Window.partitionBy("__bucket").orderBy("__last", "__key", "__th")
    rows = rows.select("*", *[F.lead(F.col(c)).over(order).alias(s) for c, s in lead.items()])
    return rows.filter("__last = 0").drop("__key", "__th", "__bucket", "__last")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S,
                        sketch: int = SKETCH) -> DataFrame:
    """(id, text, edited, fp, edited_fp, next_fp sketches): every text, and the
    text whose last floor(n/2) code points are replaced by the first as many
    of the next document."""
    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    both = next_document(base, id_col, "text", lambda df: fingerprints(df, "text", "fp", k, s, sketch),
                         {"text": "next_text", "fp": "next_fp"})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    both = both.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                                              F.substring(F.col("next_text"), F.lit(1), half))).drop("next_text")
    return _sketch(both, F.col("edited"), "edited_fp", k, s, sketch)
