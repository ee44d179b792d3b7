"""Substring dedup by seed and extend.

A word is removed from a document when it lies in a run of at least
``min_words`` words whose ``min_words``-windows all start in a document with a
smaller id; judged on the input, not on what is left.

1. Seed.  Winnowing picks anchors: in every window of ``min_words`` words the
   leftmost smallest hash of ``anchor_words`` words.  Which anchor a window
   picks depends on its words alone, so equal windows pick equal anchors.
2. Extend.  An anchor's occurrences are joined on (anchor, extension), the
   extension being everything to the left and right that a window holding the
   anchor can reach.  Occurrences with equal extensions collapse into the smallest
   id's; all others of them are repeats as a whole.  So copies and long shared
   passages cost one row per anchor, whatever the group's size.
3. Where one anchor is left with several extensions (ends of repeats, edits,
   short shared passages), the collapsed occurrences compare window by window,
   grouped by (anchor, window), and windows with a smaller id are repeats.
4. Repeated windows and extensions of a document are laid over its words; the
   unions are the maximal repeats.

No pairs of documents are formed: the work is linear in words, and the shuffles
carry anchors (about 2 / (min_words - anchor_words + 2) of the words), not
windows.  Keys are two independent 64-bit hashes.

Defined results: null text is empty; fewer than ``min_words`` words: nothing
is removed; repeated rows with one id: neither is smaller, both keep or lose
the same words; different texts with one id (or all null ids) are one document to
the others and none to each other; a null id comes after every other id; an empty
table gives an empty table.  Repeats inside one document stay.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH, RollingHash, WordHash, arrow_rows, blocks, id_key, mix64, signed, sliding_argmin, stage

ANCHOR_WORDS = 16


class Windows:
    """Anchors, extensions and windows of one document's words."""

    def __init__(self, min_words: int, anchor_words: int):
        if not 0 < anchor_words <= min_words:
            raise ValueError("anchor_words must be in 1..min_words")
        self.length, self.k = min_words, anchor_words
        self.words, self.roll = WordHash(), RollingHash()

    def load(self, text: bytes | None) -> bool:
        self.tokens = (text or b"").split()
        n = self.n = len(self.tokens)
        if n < self.length:
            return False
        self.prefix = self.roll.prefix(self.words.of(self.tokens))
        grams = self.roll.grams(self.prefix, self.k)
        self.at = sliding_argmin(grams, self.length - self.k + 1)     # anchor of each window
        self.pos = self.at[np.concatenate(([True], self.at[1:] != self.at[:-1]))]
        self.anchor = grams[self.pos]
        self.left = np.maximum(self.pos + self.k - self.length, 0)
        self.right = np.minimum(self.pos + self.length, n)
        shape = (self.pos - self.left) * (2 * self.length) + (self.right - self.pos)
        self.extension = mix64(self.roll.spans(self.prefix, self.left, self.right) ^ mix64(shape.astype(np.uint64)))
        self.key = mix64(self.anchor) ^ self.extension
        return True

    def window_keys(self, of_anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, anchor hash, window hash) of the windows whose anchors are marked."""
        nth = np.cumsum(np.concatenate(([0], (self.at[1:] != self.at[:-1]).astype(np.int64))))
        start = np.flatnonzero(of_anchor[nth])
        return start, self.anchor[nth[start]], self.roll.spans(self.prefix, start, start + self.length)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("binary").alias("t"),
                       id_key(F.col(id_col)).alias("ord"), F.xxhash64(F.col(text_col)).alias("th"))


def _once(keyed: DataFrame) -> DataFrame:
    """Repeated rows (equal id and text) once; only rows whose key is repeated move,
    combined before the shuffle."""
    again = stage(keyed.groupBy("ord", "th").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("ord", "th"), "again")
    if again.isEmpty():
        return keyed
    return (keyed.join(again, ["ord", "th"], "left_anti")
            .unionByName(keyed.join(again, ["ord", "th"], "left_semi").groupBy("ord", "th").agg(F.first("t").alias("t"))))


def _unique(*cols: np.ndarray) -> list[np.ndarray]:
    rows = np.unique(np.rec.fromarrays(cols))
    return [rows[f] for f in rows.dtype.names]


def anchor_rows(keyed: DataFrame, min_words: int, anchor_words: int) -> DataFrame:
    """(anchor, extension, ord, th), distinct within a document."""

    def rows(batches):
        doc = Windows(min_words, anchor_words)
        for b in batches:
            for o, h, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if doc.load(t):
                    a, e = _unique(doc.anchor, doc.extension)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(a)), pa.array(signed(e)), pa.array(np.full(len(a), o, np.int64)),
                         pa.array(np.full(len(a), h, np.int64))], names=["anchor", "extension", "ord", "th"])

    return keyed.select("ord", "th", "t").mapInArrow(
        _joined(rows), "anchor bigint, extension bigint, ord bigint, th bigint")


def _joined(rows, at_least: int = 50_000):
    """Join small record batches into larger ones."""

    def run(batches):
        held, size = [], 0
        for b in rows(batches):
            held.append(b)
            size += b.num_rows
            if size >= at_least:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held and size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return run


def repeated_keys(docs: DataFrame, min_words: int, anchor_words: int, id_col: str, text_col: str) -> DataFrame:
    """(ord, th, extensions array, windows array): per document the keys of its
    extensions and windows that also start in a document with a smaller id."""
    keyed = _once(_keyed(docs, id_col, text_col))
    anchors = stage(anchor_rows(keyed, min_words, anchor_words), "anchors", BATCH)
    first = stage(anchors.groupBy("anchor", "extension")
                  .agg(F.min("ord").alias("m"), F.max("ord").alias("last"), F.min(F.struct("ord", "th")).alias("rep"),
                       F.max(F.struct(-F.col("ord"), "th")).alias("other")),
                  "extensions")
    # repeats as a whole: every occurrence after the first document's
    whole = (anchors.join(first.filter("m < last").select("anchor", "extension", "m"), ["anchor", "extension"])
             .filter("ord > m").select("ord", "th", "anchor", "extension", F.lit(True).alias("is_ext")))
    # anchors left with several extensions in more than one document: compare windows
    several = stage(first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("lo"), F.max("m").alias("hi"))
                    .filter("n > 1 and lo < hi").select("anchor"), "several")
    open_ = first.join(several, "anchor")
    # different texts of the smallest id (or without an id) are all opened
    ties = open_.filter(F.col("rep.th") != F.col("other.th")).select("anchor", "extension", "m")
    tied = anchors.join(ties, ["anchor", "extension"]).filter("ord = m").select("ord", "th", "anchor", "extension")
    reps = (open_.filter(F.col("rep.th") == F.col("other.th"))
            .select(F.col("rep.ord").alias("ord"), F.col("rep.th").alias("th"), "anchor", "extension").unionByName(tied)
            .groupBy("ord", "th").agg(F.collect_list(F.struct("anchor", "extension")).alias("open")))

    def windows(batches):
        doc = Windows(min_words, anchor_words)
        for b in batches:
            for o, h, t, pairs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not doc.load(t):
                    continue
                pair = np.array([(p["anchor"], p["extension"]) for p in pairs], np.int64).view(np.uint64)
                _, a, w = doc.window_keys(np.isin(doc.key, mix64(pair[:, 0]) ^ pair[:, 1]))
                if len(a):
                    a, w = _unique(a, w)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(a)), pa.array(signed(w)), pa.array(np.full(len(a), o, np.int64)),
                         pa.array(np.full(len(a), h, np.int64))], names=["anchor", "win", "ord", "th"])

    opened = stage(keyed.select("ord", "th", "t").join(reps, ["ord", "th"]).select("ord", "th", "t", "open")
                   .mapInArrow(_joined(windows), "anchor bigint, win bigint, ord bigint, th bigint"), "windows", BATCH)
    shared = (opened.groupBy("anchor", "win").agg(F.min("ord").alias("m"), F.max("ord").alias("last"))
              .filter("m < last").select("anchor", "win", "m"))
    single = (opened.join(shared, ["anchor", "win"]).filter("ord > m")
              .select("ord", "th", "anchor", F.col("win").alias("extension"), F.lit(False).alias("is_ext")))
    return (whole.union(single).groupBy("ord", "th")
            .agg(F.collect_list(F.when(F.col("is_ext"), F.struct("anchor", "extension"))).alias("exts"),
                 F.collect_list(F.when(~F.col("is_ext"), F.struct("anchor", "extension"))).alias("wins")))


RESULT = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
                    ("span_start", pa.list_(pa.int32())), ("span_end", pa.list_(pa.int32()))])


def _spans(mask: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def substring_dedup(docs: DataFrame, min_words: int = 50, anchor_words: int = ANCHOR_WORDS,
                    id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: (id, *carry, n_words, n_removed, kept_text,
    span_start, span_end).  Spans are the removed maximal runs in word
    positions [start, end); ``kept_text`` joins the other words by a space.
    ``carry``: further input columns to pass through."""
    found = repeated_keys(docs, min_words, anchor_words, id_col, text_col)
    own = text_col if text_col in carry else "__t"       # a carried text is sent once
    keyed = docs.select(F.col(id_col), *carry, *([] if own in carry else [F.col(text_col).alias(own)]),
                        id_key(F.col(id_col)).alias("__ord"), F.xxhash64(F.col(text_col)).alias("__th"))
    found = found.withColumnsRenamed({"ord": "__ord", "th": "__th", "exts": "__exts", "wins": "__wins"})
    rows = keyed.join(found, ["__ord", "__th"], "left").drop("__ord", "__th")
    keep = [id_col, *carry]
    fields = [rows.schema[c] for c in keep]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_words bigint", "n_removed bigint",
                     "kept_text string", "span_start array<int>", "span_end array<int>"])

    def pairs(found_pairs) -> np.ndarray:
        return np.array([(p["anchor"], p["extension"]) for p in found_pairs], np.int64).reshape(-1, 2).view(np.uint64)

    def run(batches):
        doc = Windows(min_words, anchor_words)
        for b in chain.from_iterable(map(blocks, batches)):
            out = []
            texts = b.column(own).cast(pa.binary()).to_pylist()
            for t, exts, wins in zip(texts, *(b.column(c).to_pylist() for c in ("__exts", "__wins")), strict=True):
                if not exts and not wins:
                    tokens = (t or b"").split()
                    out.append((len(tokens), 0, b" ".join(tokens).decode("utf-8", "replace"), [], []))
                    continue
                doc.load(t)
                level = np.zeros(doc.n + 1, np.int64)
                if exts:
                    p = pairs(exts)
                    hit = np.isin(doc.key, mix64(p[:, 0]) ^ p[:, 1])
                    np.add.at(level, doc.left[hit], 1)
                    np.add.at(level, doc.right[hit], -1)
                if wins:
                    p = pairs(wins)
                    start, a, w = doc.window_keys(np.isin(doc.anchor, p[:, 0]))
                    start = start[np.isin(mix64(a) ^ w, mix64(p[:, 0]) ^ p[:, 1])]
                    np.add.at(level, start, 1)
                    np.add.at(level, start + min_words, -1)
                gone = np.cumsum(level[:-1]) > 0
                kept = [x for x, g in zip(doc.tokens, gone.tolist(), strict=True) if not g]
                out.append((doc.n, int(gone.sum()), b" ".join(kept).decode("utf-8", "replace"), *_spans(gone)))
            cols = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), RESULT, strict=True)] if out else \
                [pa.array([], f.type) for f in RESULT]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *cols],
                                             names=[*keep, *(f.name for f in RESULT)])

    return rows.mapInArrow(run, ddl)
