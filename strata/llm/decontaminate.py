"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

1. One scan counts, over the whole corpus, how often each word n-gram of the
   test items occurs (tasks send their counts, not texts).
2. Of every ``window`` consecutive occurring n-grams of an item the rarest is a
   seed.  Rarity is only ever relative to the item, so no item is left without
   seeds because its passage was copied often.
3. A second scan joins each document's words to the seeds; a seed's position in
   the document and in the item give a diagonal, near diagonals one region.
   Regions are aligned with the item by Smith-Waterman over words (batched per
   item); regions that share too few words with the item to reach the threshold
   are left out first, which is an exact bound.
4. A document matches an item when the best local alignment reaches
   ``min_share`` of the item's own score, and ``min_words`` words (all words of
   a shorter item).

Words: runs between ASCII white space, lower-cased, without leading and
trailing punctuation.  The item side is read in blocks of at most
``BLOCK_WORDS`` words; further blocks mean further scans, so what a task
holds of the benchmark is bounded whatever its size.

Defined results: null and empty texts (on either side) match nothing; items of
fewer words than the n-gram can't be seeded and match nothing; repeated
documents each get their rows, repeated items are one; null ids are kept as
null ids; empty tables give an empty result.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import RollingHash, WordHash, arrow_rows, stage

NGRAM, WINDOW, MIN_SHARE, MIN_WORDS = 3, 3, 0.5, 8
MATCH, MISMATCH, GAP = 2, -1, 1
BLOCK_WORDS = 2_000_000
BITS = 22


class PlainWords(WordHash):
    """Raw word -> hash of its plain form; 0 for words of punctuation only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        plain = word.decode("utf-8", "replace").lower()
        a, b = 0, len(plain)
        while a < b and unicodedata.category(plain[a])[0] in "PSZC":
            a += 1
        while b > a and unicodedata.category(plain[b - 1])[0] in "PSZC":
            b -= 1
        h = self[word] = (xxhash.xxh64_intdigest(plain[a:b], 0) | 1) if b > a else 0
        return h

    def text(self, text: bytes | None) -> np.ndarray:
        h = self.of((text or b"").split())
        return h[h != 0]


class Grams:
    """n-gram hashes and fast membership in a fixed set."""

    def __init__(self, grams: np.ndarray, n: int):
        self.n, self.grams = n, np.unique(grams)
        self.words, self.roll = PlainWords(), RollingHash()
        self.bit = np.zeros(1 << BITS, bool)
        self.bit[self.grams >> np.uint64(64 - BITS)] = True

    def hits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in the text, index of the n-gram) of each known n-gram."""
        if len(x) < self.n or not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        g = self.roll.grams(self.roll.prefix(x), self.n)
        pos = np.flatnonzero(self.bit[g >> np.uint64(64 - BITS)])
        g = g[pos]
        at = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        ok = self.grams[at] == g
        return pos[ok], at[ok]


def smith_waterman(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of one item with each row of ``regions`` (word
    hashes, 0 = padding): (score, item end, region end).  One vector step per
    item word; the gap along the row is a running maximum."""
    n, width = regions.shape
    ramp = GAP * np.arange(width + 1, dtype=np.int32)
    h = np.zeros((n, width + 1), np.int32)
    best, at_i, at_j = (np.zeros(n, np.int64) for _ in range(3))
    for i, w in enumerate(item, 1):
        t = np.zeros((n, width + 1), np.int32)
        np.maximum(h[:, :-1] + np.where(regions == w, MATCH, MISMATCH).astype(np.int32), h[:, 1:] - GAP, out=t[:, 1:])
        np.maximum(t, 0, out=t)
        h = np.maximum.accumulate(t + ramp, axis=1) - ramp
        j = h.argmax(axis=1)
        s = h[np.arange(n), j]
        up = s > best
        best[up], at_i[up], at_j[up] = s[up], i, j[up]
    return best, at_i, at_j


def align(item: np.ndarray, regions: list[np.ndarray], need: float) -> list[tuple[int, int, int, int, int, int]]:
    """(region index, score, item start, item end, region start, region end)
    of the alignments that reach ``need``."""
    out = []
    for lo in range(0, len(regions), 256):
        part = regions[lo: lo + 256]
        grid = np.zeros((len(part), max(map(len, part))), np.uint64)
        for r, x in enumerate(part):
            grid[r, : len(x)] = x
        score, ie, je = smith_waterman(item, grid)
        for r in np.flatnonzero(score >= need).tolist():
            # the start is the end of the best alignment of the reversed parts
            _, bi, bj = smith_waterman(item[: ie[r]][::-1], part[r][: je[r]][::-1][None, :])
            out.append((lo + r, int(score[r]), int(ie[r] - bi[0]), int(ie[r]), int(je[r] - bj[0]), int(je[r])))
    return out


def item_words(items: DataFrame, id_col: str, text_col: str, ngram: int) -> DataFrame:
    """(item, words array) of the distinct items that can be seeded."""

    def rows(item, text, cache=PlainWords()):
        x = cache.text(text)
        if len(x) >= ngram:
            yield item, x.view(np.int64).tolist(), len(x)

    kind = items.schema[id_col].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = pa.schema([("item", arrow), ("words", pa.list_(pa.int64())), ("n", pa.int32())])
    return (items.select(F.col(id_col).alias("item"), F.col(text_col).cast("binary").alias("t")).distinct()
            .mapInArrow(arrow_rows(rows, schema), f"item {kind}, words array<bigint>, n int"))


def _seeds(docs: DataFrame, block: list, ngram: int, window: int, text_col: str) -> dict[int, list[tuple[int, int]]]:
    """Seed hash -> (item index, position) of one block of items."""
    spark = docs.sparkSession
    roll = RollingHash()
    where = []
    for k, r in enumerate(block):
        g = roll.grams(roll.prefix(np.array(r["words"], np.int64).view(np.uint64)), ngram)
        where += [(k, p, int(h)) for p, h in enumerate(g.view(np.int64).tolist())]
    known = np.unique(np.array([w[2] for w in where], np.int64)).view(np.uint64)

    def count(batches):
        grams = Grams(known, ngram)
        total = np.zeros(len(grams.grams), np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                _, at = grams.hits(grams.words.text(t))
                total += np.bincount(at, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(grams.grams[seen].view(np.int64)), pa.array(total[seen])],
                                         names=["gram", "n"])

    freq = (docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(count, "gram bigint, n bigint")
            .groupBy("gram").agg(F.sum("n").alias("freq")))
    places = spark.createDataFrame(where, "k int, pos int, gram bigint")
    near = Window.partitionBy("k").orderBy("pos").rowsBetween(0, window - 1)
    rare = (places.join(freq, "gram")                    # n-grams that occur nowhere are no seeds
            .select(F.col("k"), F.min(F.struct("freq", "pos", "gram")).over(near).alias("s")).distinct())
    seeds: dict[int, list[tuple[int, int]]] = {}
    for r in rare.select("k", "s.pos", "s.gram").collect():      # bounded by the block
        seeds.setdefault(r["gram"], []).append((r["k"], r["pos"]))
    return seeds


def contaminated(docs: DataFrame, items: DataFrame, ngram: int = NGRAM, window: int = WINDOW,
                 min_share: float = MIN_SHARE, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, *carry, item_id, score, share, item_start, item_end, word_start,
    word_end): the best alignment of each matching (document, item), one row
    per input row and item.  Word positions count plain words."""
    known = stage(item_words(items, item_id_col, item_text_col, ngram), "items")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // BLOCK_WORDS))
    found = []
    for k in range(n_blocks):
        block = known.filter(F.pmod(F.hash("item", "words"), F.lit(n_blocks)) == k).collect()   # a bounded block
        found.append(_matches(docs, block, known.schema["item"].dataType.simpleString(), ngram, window, min_share,
                              min_words, id_col, text_col, item_id_col, carry))
    return reduce(DataFrame.union, found)


def _matches(docs, block, item_kind, ngram, window, min_share, min_words, id_col, text_col, item_id_col, carry):
    keep = [id_col, *carry]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    ddl = (f"{kinds}, `{item_id_col}` {item_kind}, score int, share double, item_start int, item_end int, "
           "word_start int, word_end int")
    seeds = _seeds(docs, block, ngram, window, text_col) if block else {}
    words = [np.array(r["words"], np.int64).view(np.uint64) for r in block]
    names = [r["item"] for r in block]
    order = sorted(seeds, key=lambda g: np.int64(g).view(np.uint64))
    hashes = np.array(order, np.int64).view(np.uint64)
    lists = [seeds[g] for g in order]
    need = [MATCH * max(min_share * len(w), min(len(w), min_words)) for w in words]
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind]

    def regions(x: np.ndarray, pos: np.ndarray, at: np.ndarray):
        """(item, start, end) of the regions around a document's seeds."""
        diagonals: dict[int, list[int]] = {}
        for p, a in zip(pos.tolist(), at.tolist(), strict=True):
            for k, q in lists[a]:
                diagonals.setdefault(k, []).append(p - q)
        for k, ds in diagonals.items():
            m = len(words[k])
            slack = m // 4 + 4
            ds.sort()
            first = last = ds[0]
            for d in [*ds[1:], None]:
                if d is not None and d - last <= slack:
                    last = d
                    continue
                a, b = max(0, first - slack), min(len(x), last + m + slack)
                inside = set(x[a:b].tolist())
                if MATCH * sum(w in inside for w in words[k].tolist()) >= need[k]:
                    yield k, a, b
                first = last = d if d is not None else 0

    def run(batches):
        grams = Grams(hashes, ngram)
        for b in batches:
            todo: dict[int, list[tuple[int, int, np.ndarray]]] = {}
            for i, t in enumerate(b.column("__t").to_pylist()):
                x = grams.words.text(t)
                pos, at = grams.hits(x)
                if len(pos):
                    for k, a, z in regions(x, pos, at):
                        todo.setdefault(k, []).append((i, a, x[a:z]))
            best: dict[tuple[int, int], tuple] = {}
            for k, parts in todo.items():
                for r, score, ia, ie, ja, je in align(words[k], [p[2] for p in parts], need[k]):
                    i, a, _ = parts[r]
                    row = (score, score / (MATCH * len(words[k])), ia, ie, a + ja, a + je)
                    if (i, k) not in best or (-score, row[4]) < (-best[i, k][0], best[i, k][4]):
                        best[i, k] = row
            keys = sorted(best)
            rows = pa.array([i for i, _ in keys], pa.int64())
            cols = list(zip(*(best[x] for x in keys), strict=True)) if keys else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(rows) for c in keep), pa.array([names[k] for _, k in keys], arrow_kind),
                 *(pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.float64()] + [pa.int32()] * 4, strict=True))],
                names=[*keep, item_id_col, "score", "share", "item_start", "item_end", "word_start", "word_end"])

    return docs.select(*keep, F.col(text_col).cast("binary").alias("__t")).mapInArrow(run, ddl)
