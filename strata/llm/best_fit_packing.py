"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents are encoded, ended by a separator id and cut only where they are longer
than a sequence.  Full pieces are sequences of their own.  The other pieces are dealt
by a hash into blocks of about ``BLOCK`` pieces; each block is packed by ``ISLANDS``
populations that start from best fit decreasing and from best fit in random orders.
Crossover injects whole well-filled bins of one parent into the other, removes the
other's bins that hold an injected piece a second time, and best-fits the displaced
pieces, longest first.  After each epoch an island's best packing migrates to the
next island of its block (a join on block and island).  A packing is better if it
has fewer bins, then if its fills have the larger sum of squares.

The bins of a block that stay poorly filled (below ``WELL_FILLED``), usually one, are
opened again and their pieces dealt into fewer blocks at the next level, until one
block is left or opening no longer helps, so the whole corpus ends with about as
many sequences as its tokens need, and no task ever holds more than a block.

Defined results: null text is empty (a piece of the separator alone); repeated rows
and repeated ids are documents of their own; an empty table gives no rows; a piece is
numbered before it is stored, so every later stage sees the same pieces.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .common import Memory, stage
from .sp_codec import _slices

BLOCK = 4096
ISLANDS = 4
POPULATION = 4
EPOCHS = 2
GENERATIONS = 8
WELL_FILLED = 15 / 16
LEVELS = 6
MEMORY = 600_000                     # words, and units of words, that a worker remembers
MARKS = ".,;:!?"


# -- tokens -----------------------------------------------------------------

class WordTokens:
    """Ids of texts by a tokenizers JSON.  Where the file's rules never look across
    white space, each word is encoded once and remembered."""

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(blob)
        spec = json.loads(blob)
        parts = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        pattern = split.get("pattern", {}).get("Regex", " ")
        # words apart: white space is collapsed, removed by the split and in none of its alternatives
        self.by_word = (parts == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and bool(split.get("invert"))
                        and " " not in pattern and "\\s" not in pattern.replace("[^\\s", ""))
        self.words, self.units = Memory(MEMORY), Memory(MEMORY)

    def _encode_units(self, units: list[str]) -> Iterator[bytes]:
        """Encode the units as one text and cut its ids by the units they start in."""
        for k in range(0, len(units), 20_000):
            part = units[k: k + 20_000]
            code = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            raw = np.array(code.ids, "<u4").tobytes()
            starts = np.array([o[0] for o in code.offsets], np.int64)
            begin = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
            edge = (4 * np.searchsorted(starts, begin)).tolist()
            yield from (raw[a:b] for a, b in zip(edge, [*edge[1:], len(raw)], strict=True))

    def _encode_words(self, words: list[str]) -> Iterator[bytes]:
        """A word that ends with a letter and then marks is two units for the split."""
        cores, marks = [], []
        for w in words:
            core = w.rstrip(MARKS)
            if not core or not core[-1].isalpha():
                core = w
            marks.append(w[len(core):])
            cores.append(core.lower() if core.isascii() and core.isalpha() else core)
        units = list(dict.fromkeys([*cores, *marks]))
        known = dict(zip(units, self.units.fetch(units, self._encode_units), strict=True))
        return (known[c] + known[m] for c, m in zip(cores, marks, strict=True))

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text: its distinct words are looked up, the ids gathered."""
        if not self.by_word:
            for t in texts.to_pylist():
                yield np.array(self.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4")
            return
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        word = coded.indices.to_numpy()
        found = self.words.fetch(coded.dictionary.to_pylist(), self._encode_words)
        size = np.array([len(x) // 4 for x in found], np.int64)
        first = np.cumsum(size) - size
        count = size[word]
        ends = np.cumsum(count)
        ids = np.frombuffer(b"".join(found), "<u4")[np.arange(ends[-1]) + np.repeat(first[word] - ends + count, count)]
        # a text has at least one word, if only an empty one
        last = ends[np.cumsum(pc.list_value_length(cut).to_numpy()) - 1]
        yield from np.split(ids, last[:-1])


_LOADED: dict[bytes, WordTokens] = {}


def _tokens(blob: bytes) -> WordTokens:
    if blob not in _LOADED:
        _LOADED.clear()
        _LOADED[blob] = WordTokens(blob)
    return _LOADED[blob]


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Pieces of the encoded documents: uid (any number, unique), id, piece, start,
    length, ids_crc32 (of the little-endian unsigned 32-bit ids).  The tokenizer file
    travels with the task's code."""
    with open(tokenizer_path, "rb") as f:
        blob = f.read()
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = StructType([StructField(id_col, rows.schema[id_col].dataType), *StructType.fromDDL(
        "uid bigint, piece int, start bigint, length bigint, ids_crc32 bigint").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(blob)
        uid = TaskContext.get().partitionId() << 33
        for whole in batches:
            for part in _slices(whole, "__text", 16_000_000):
                row, piece, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(tokens.encode(part.column("__text"))):
                    raw = ids.tobytes() + int(end_id).to_bytes(4, "little")
                    n = len(raw) // 4
                    for p, a in enumerate(range(0, n, capacity)):
                        b = min(a + capacity, n)
                        row.append(k)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(raw[4 * a: 4 * b]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(np.arange(uid, uid + len(row))), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], schema=arrow)
                uid += len(row)

    return rows.mapInArrow(run, schema)


# -- packings of a block -----------------------------------------------------

class Packing:
    """Bin of each piece, and the bins' fills."""

    def __init__(self, bins: np.ndarray, lengths: np.ndarray):
        used, self.bins = np.unique(bins, return_inverse=True)
        self.fill = np.bincount(self.bins, weights=lengths, minlength=len(used)).astype(np.int64)

    @property
    def rank(self) -> tuple[int, int]:
        """Smaller is better."""
        return len(self.fill), -int((self.fill ** 2).sum())


def best_fit(lengths: list[int], items: list[int], bins: list[int], fill: list[int], capacity: int) -> None:
    """Put each item into the bin with the least room that takes it, or a new one."""
    rooms: dict[int, list[int]] = {}
    mask = 0                                             # bit r: a bin with room r
    for b, f in enumerate(fill):
        if f < capacity:
            rooms.setdefault(capacity - f, []).append(b)
            mask |= 1 << (capacity - f)
    for i in items:
        size = lengths[i]
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i] = b
        fill[b] += size
        if room > size:
            rooms.setdefault(room - size, []).append(b)
            mask |= 1 << (room - size)


class Island:
    """A population of packings of one block."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: tuple[int, ...]):
        self.lengths, self.capacity = lengths, capacity
        self.sizes = lengths.tolist()
        self.random = np.random.default_rng(seed)
        self.least = -(-int(lengths.sum()) // capacity)
        self.packings: list[Packing] = []

    def _fitted(self, order: np.ndarray) -> Packing:
        bins = [0] * len(self.sizes)
        best_fit(self.sizes, order.tolist(), bins, [], self.capacity)
        return Packing(np.array(bins), self.lengths)

    def populate(self, size: int) -> None:
        noise = np.arange(size) * self.capacity / 16     # the first is best fit decreasing; later ones in looser order
        for scale in noise:
            self.packings.append(self._fitted(np.argsort(scale * self.random.random(len(self.sizes)) - self.lengths, kind="stable")))
            if self.done:
                break
        self.packings.sort(key=lambda p: p.rank)

    @property
    def done(self) -> bool:
        return bool(self.packings) and min(len(p.fill) for p in self.packings) == self.least

    def cross(self, into: Packing, source: Packing) -> Packing:
        """Whole well-filled bins of ``source`` go into ``into``."""
        order = np.argsort(-source.fill + self.random.random(len(source.fill)), kind="stable")
        pool = order[: max(1, len(order) // 2)]
        chosen = np.zeros(len(source.fill), bool)
        chosen[self.random.choice(pool, max(1, len(pool) // 3), replace=False)] = True
        injected = chosen[source.bins]
        twice = np.zeros(len(into.fill), bool)
        twice[into.bins[injected]] = True                # bins that hold an injected piece
        twice[np.argsort(into.fill, kind="stable")[: 1 + len(into.fill) // 50]] = True      # and the least filled ones
        displaced = np.flatnonzero(twice[into.bins] & ~injected)
        bins = np.where(injected, len(into.fill) + source.bins, into.bins)
        stay = np.flatnonzero(injected | ~twice[into.bins])
        used, bins[stay] = np.unique(bins[stay], return_inverse=True)
        fill = np.bincount(bins[stay], weights=self.lengths[stay], minlength=len(used)).astype(np.int64).tolist()
        placed = bins.tolist()
        best_fit(self.sizes, displaced[np.argsort(-self.lengths[displaced], kind="stable")].tolist(), placed, fill, self.capacity)
        return Packing(np.array(placed), self.lengths)

    def evolve(self, generations: int) -> None:
        for _ in range(generations):
            if self.done or len(self.packings) < 2:
                break
            a, b = self.random.choice(len(self.packings), 2, replace=False)
            child = self.cross(self.packings[min(a, b)], self.packings[max(a, b)])
            if child.rank not in [p.rank for p in self.packings] and child.rank < self.packings[-1].rank:
                self.packings[-1] = child
                self.packings.sort(key=lambda p: p.rank)


def _evolve(capacity: int, epoch: int, schema: pa.Schema):
    """(block, island, lengths[, population, migrant]) -> the island after an epoch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row] for n in batch.schema.names}
                lengths = np.array(one["lengths"].values, np.int64)
                block, number = one["block"].as_py(), one["island"].as_py()
                island = Island(lengths, capacity, (block, number, epoch))
                if epoch:
                    own = np.array(one["population"].values, np.int64).reshape(-1, len(lengths))
                    island.packings = [Packing(p, lengths) for p in own]
                    guest = Packing(np.array(one["migrant"].values, np.int64), lengths)
                    if guest.rank not in [p.rank for p in island.packings]:
                        island.packings = sorted([*island.packings, guest], key=lambda p: p.rank)[:POPULATION]
                else:
                    island.populate(POPULATION)
                island.evolve(GENERATIONS)
                flat = np.concatenate([p.bins for p in island.packings]).astype(np.int32)
                best = island.packings[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([number], pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.array(lengths.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat)),
                     pa.array([best.rank[0]], pa.int64()), pa.array([best.rank[1]], pa.int64())], schema=schema)

    return run


def _place(capacity: int, level: int, schema: pa.Schema):
    """(block, items, packing) -> a row per piece with its sequence and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                items = batch.column("items")[row].values
                lengths, uids = (np.array(items.field(c), np.int64) for c in ("length", "uid"))
                packing = Packing(np.array(batch.column("bins")[row].values, np.int64), lengths)
                order = np.argsort(packing.bins, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.cumsum(packing.fill) - packing.fill
                offset = before - first[packing.bins[order]]
                sequence = (level << 56) | (batch.column("block")[row].as_py() << 16) | packing.bins[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uids[order]), pa.array(lengths[order]), pa.array(sequence), pa.array(offset),
                     pa.array(packing.fill[packing.bins[order]] < WELL_FILLED * capacity)], schema=schema)

    return run


def pack_pieces(pieces: DataFrame, capacity: int, block: int = BLOCK) -> DataFrame:
    """(uid, sequence_id, offset) of every piece (uid, length)."""
    island = StructType.fromDDL("block bigint, island int, lengths array<int>, population array<int>, n_bins bigint, squares bigint")
    placed = StructType.fromDDL("uid bigint, length bigint, sequence_id bigint, offset bigint, open boolean")
    done = [pieces.filter(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    items = pieces.filter(F.col("length") < capacity).select("uid", "length")
    n = items.count()
    level = 1
    while n:
        blocks = max(1, round(n / block))
        grouped = stage(items.groupBy(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks)).alias("block"))
                        .agg(F.array_sort(F.collect_list(F.struct("length", "uid"))).alias("items")), "blocks")
        lengths = F.transform("items", lambda x: x["length"].cast("int"))
        state = (grouped.select("block", lengths.alias("lengths"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
                 .repartition("block", "island").mapInArrow(_evolve(capacity, 0, to_arrow_schema(island)), island))
        for epoch in range(1, EPOCHS):
            state = stage(state, f"epoch{epoch}")
            best = F.slice("population", F.lit(1), F.size("lengths"))
            elites = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), best.alias("migrant"))
            state = (state.join(elites, ["block", "island"]).select("block", "island", "lengths", "population", "migrant")
                     .mapInArrow(_evolve(capacity, epoch, to_arrow_schema(island)), island))
        state = stage(state, "islands")
        won = (state.groupBy("block").agg(F.min(F.struct("n_bins", "squares", "island")).alias("w")).select("block", "w.island"))
        best = state.join(won, ["block", "island"]).select("block", F.slice("population", F.lit(1), F.size("lengths")).alias("bins"))
        found = stage(grouped.join(best, "block").mapInArrow(_place(capacity, level, to_arrow_schema(placed)), placed), "placed")
        again = found.filter("open").count()
        # opened bins are worth another level while they get fewer and more than one block was packed
        last = blocks == 1 or level == LEVELS or again > 0.8 * n
        done.append((found if last else found.filter("NOT open")).select("uid", "sequence_id", "offset"))
        if last:
            break
        items, n, level = found.filter("open").select("uid", "length"), again, level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(cut_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    return (pieces.join(pack_pieces(pieces, capacity), "uid")
            .select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
