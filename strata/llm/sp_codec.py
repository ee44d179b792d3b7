"""SentencePiece (BPE) encoding that keeps byte offsets, and decoding.

1. Normalise.  The model's compiled character map is read as it is stored (a
   double-array trie over UTF-8 bytes and a table of replacements); at every
   position the longest prefix in the trie is replaced, otherwise one code
   point is copied.  White space rules of the model follow (dummy prefix,
   removal of extra white space, the visible space).  Every normalised
   code point keeps the source byte span it came from.
2. Segment.  No piece of the vocabulary holds a visible space after another
   character, so no merge ever crosses such a place; the normalised text is cut
   there, and each distinct segment is merged once per task (best score first,
   leftmost on ties) and remembered.  The memory is emptied at a fixed size.
3. Project.  Piece lengths summed over the source spans give each piece's
   byte span [start, end) in the original text; the dummy prefix has no bytes.

Defined results: null text is empty and gives no pieces; unknown characters
become byte pieces when the model has byte fallback, else runs of them become
one unknown piece; texts of any length are taken whole; repeated rows give
repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharMap:
    """Longest-prefix lookups in a compiled character map: a uint32 byte size,
    that many bytes of double-array units, then NUL-terminated replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size:] if blob else b""
        self.firsts = {b for b in range(256) if self._child(0, b) is not None} if blob else set()

    def _child(self, node: int, byte: int) -> int | None:
        unit = self.units[node]
        nxt = node ^ (unit >> 10 << ((unit & 0x200) >> 6)) ^ byte
        if nxt >= len(self.units) or self.units[nxt] & 0x800000FF != byte:
            return None
        return nxt

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes consumed, replacement) of the longest match at ``at``."""
        node, best = 0, None
        for i in range(at, len(text)):
            node = self._child(node, text[i]) if text[i] else None
            if node is None:
                break
            unit = self.units[node]
            if unit >> 8 & 1:                                    # has a value
                leaf = self.units[node ^ (unit >> 10 << ((unit & 0x200) >> 6))]
                best = (i + 1 - at, leaf & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.strings[best[1]: self.strings.index(b"\0", best[1])]


class Model:
    """What encoding needs of a BPE model file."""

    def __init__(self, blob: bytes, memory: int = 400_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(blob)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        kinds = [p.type for p in proto.pieces]
        if spec.model_type != 2 or spec.treat_whitespace_as_suffix or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("a BPE model without user-defined, unused or suffix pieces is needed")
        self.map = CharMap(norm.precompiled_charsmap)
        self.dummy, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.space = SPACE if norm.escape_whitespaces else " "
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.cost = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = kinds
        self.unk = kinds.index(UNKNOWN)
        self.unk_surface = spec.unk_surface
        self.fallback = spec.byte_fallback
        self.bytes_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.bytes_id.items()}
        if any(self.space in p.lstrip(self.space) for p in self.ids):
            raise ValueError("a piece holds a space after another character: segments can't be cut there")
        self.known: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}
        self.words = Memory(250_000)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.last_byte = max(self.byte_of, default=-1)
        self.memory = memory
        # a run of spaces with what follows is one segment
        self.cut = re.compile(f"{self.space}*[^{self.space}]+|{self.space}+")
        self.surface = [b"" if k == CONTROL else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, kinds)]
        self.surface[self.unk] = self.unk_surface.encode()
        self.widths = [1 if i in self.byte_of else min(255, len(s)) for i, s in enumerate(self.surface)]

    # -- normalising ---------------------------------------------------------
    def plain(self, text: str) -> bool:
        """True if normalising only replaces spaces and adds the prefix."""
        return not self.squeeze and not (self.map.firsts and not self.map.firsts.isdisjoint(text.encode()))

    def normalise(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """Normalised text and, for each of its code points, the source byte span."""
        raw = text.encode()
        parts: list[tuple[str, int, int]] = []                 # (replacement, start, end)
        at = 0
        while at < len(raw):
            hit = self.map.longest(raw, at) if raw[at] in self.map.firsts else None
            if hit:
                parts.append((hit[1].decode(), at, at + hit[0]))
                at += hit[0]
            else:
                end = at + 1
                while end < len(raw) and raw[end] & 0xC0 == 0x80:
                    end += 1
                parts.append((raw[at:end].decode(), at, end))
                at = end
        if self.squeeze:
            while parts and parts[0][0] == " ":
                parts.pop(0)
        out: list[str] = []
        start: list[int] = []
        end: list[int] = []

        def put(chars: str, a: int, b: int) -> None:
            for i, c in enumerate(chars):
                out.append(self.space if c == " " else c)
                start.append(a if i == 0 else b)               # further code points of a replacement
                end.append(b)                                  # add no bytes of their own

        if parts and self.dummy:
            put(" ", parts[0][1], parts[0][1])
        space_before = self.squeeze
        for chars, a, b in parts:
            if self.squeeze:
                while space_before and chars.startswith(" "):
                    chars = chars[1:]
                if not chars:
                    continue
                space_before = chars.endswith(" ")
            put(chars, a, b)
        if self.squeeze:
            while out and out[-1] == self.space:
                out.pop(), start.pop(), end.pop()
        return "".join(out), np.array(start, np.int64), np.array(end, np.int64)

    # -- merging -------------------------------------------------------------
    def _merge(self, seg: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost on ties, until none is a piece."""
        if len(seg) > 48:
            return self._merge_long(seg)
        get, none = self.cost.get, float("inf")
        sym = list(seg)
        cost = [get(a + b, none) for a, b in zip(sym, sym[1:])]
        while cost:
            best = min(cost)
            if best == none:
                break
            i = cost.index(best)
            sym[i] += sym.pop(i + 1)
            del cost[i]
            if i < len(cost):
                cost[i] = get(sym[i] + sym[i + 1], none)
            if i:
                cost[i - 1] = get(sym[i - 1] + sym[i], none)
        return sym

    def _merge_long(self, seg: str) -> list[str]:
        """The same with a heap, for segments that are long."""
        sym: list[str | None] = list(seg)
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []
        cost = self.cost

        def push(i: int) -> None:
            j = nxt[i]
            if j < n:
                both = sym[i] + sym[j]
                c = cost.get(both)
                if c is not None:
                    heapq.heappush(heap, (c, i, both))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if sym[i] is None or nxt[i] >= n or sym[i] + sym[nxt[i]] != both:
                continue
            j = nxt[i]
            sym[i], sym[j] = both, None
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            if prv[i] >= 0:
                push(prv[i])
            push(i)
        return [s for s in sym if s is not None]

    def segment(self, seg: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """(ids, code points of each) of one segment; a byte piece that is not
        the last of its character counts none."""
        parts = self._merge(seg)
        found = tuple(map(self.ids.get, parts))
        if None not in found:
            return found, tuple(map(len, parts))
        ids: list[int] = []
        width: list[int] = []
        for p, i in zip(parts, found, strict=True):
            if i is not None:
                ids.append(i)
                width.append(len(p))
            elif self.fallback:
                raw = p.encode()
                ids.extend(self.bytes_id[b] for b in raw)
                width.extend([0] * (len(raw) - 1) + [len(p)])
            else:
                ids.append(self.unk)
                width.append(len(p))
        return tuple(ids), tuple(width)

    def _known(self, seg: str):
        got = self.known.get(seg)
        if got is None:
            got = self.segment(seg)
            if len(seg) <= 64:
                if len(self.known) >= self.memory:
                    self.known.clear()
                self.known[seg] = got
        return got

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, span start, span end); spans are bytes of the original text."""
        if not text:
            z = np.zeros(0, np.int32)
            return z, z, z
        simple = self.plain(text)
        if simple:
            norm = text.replace(" ", self.space)
            if self.dummy:
                norm = self.space + norm
        else:
            norm, a, b = self.normalise(text)
        segs = [self._known(s) for s in self.cut.findall(norm)]
        ids = np.fromiter(chain.from_iterable([s[0] for s in segs]), np.int32)
        width = np.fromiter(chain.from_iterable([s[1] for s in segs]), np.int64)
        if not self.fallback and len(ids):                        # a run of unknowns is one piece
            head = np.ones(len(ids), bool)
            head[1:] = ~((ids[1:] == self.unk) & (ids[:-1] == self.unk))
            width = np.add.reduceat(width, np.flatnonzero(head))
            ids = ids[head]
        last = np.cumsum(width)                                   # code points up to each piece's end
        if simple:
            size = _utf8_sizes(text)
            edge = np.concatenate(([0], np.cumsum(size)))
            if self.dummy:
                edge = np.concatenate(([0], edge))
            end = edge[last]
            start = np.concatenate(([0], end[:-1]))
        else:
            if not len(ids):
                z = np.zeros(0, np.int32)
                return z, z, z
            end = b[np.maximum(last, 1) - 1]
            first = np.minimum(np.concatenate(([0], last[:-1])), len(a) - 1)
            start = a[first]
        # the bytes of one character: each byte piece takes its own byte
        if self.fallback and (width == 0).any():
            start, end = self._byte_spans(width, start, end)
        return ids, start.astype(np.int32), end.astype(np.int32)

    def encode_all(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, str]]:
        """(ids, span start, span end, decoded) of each text.

        Where normalising only makes spaces visible and adds the prefix, and a text has
        single spaces between visible characters, its segments are its words: distinct
        words are merged once, and ids and byte widths are gathered from them.  Other
        texts go through :meth:`encode`."""
        texts = pc.fill_null(texts, "")
        if not texts or not self.dummy or self.squeeze or self.map.firsts or not self.fallback or SPACE not in self.ids or max(self.widths) == 255:
            got = [self.encode(t) for t in texts.to_pylist()]
            return [(*g, self.decode(g[0])) for g in got]
        odd = pc.or_(pc.match_substring_regex(texts, f"  |^ | $|\\A |{SPACE}| \\z"), pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for k in np.flatnonzero(odd).tolist():
            got = self.encode(texts[k].as_py())
            out[k] = (*got, self.decode(got[0]))
        even = np.flatnonzero(~odd)
        if not len(even):
            return out
        cut = pc.split_pattern(texts.take(pa.array(even)), " ")
        coded = cut.flatten().dictionary_encode()
        word = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        known = self.words.fetch(distinct, self._learn)
        size = np.array([len(k[1]) for k in known], np.int64)
        first = np.cumsum(size) - size
        count = size[word]
        ends = np.cumsum(count)
        at = np.arange(ends[-1]) + np.repeat(first[word] - ends + count, count)
        ids = np.frombuffer(b"".join([k[0] for k in known]), np.int32)[at]
        width = np.frombuffer(b"".join([k[1] for k in known]), np.uint8)[at].astype(np.int64)
        decoded = [" " + w if k[2] is None else k[2] for w, k in zip(distinct, known, strict=True)]
        total = np.cumsum(width)
        words = np.cumsum(pc.list_value_length(cut).to_numpy())
        last = ends[words - 1].tolist()
        index = word.tolist()
        a = w = 0
        for k, b, v in zip(even.tolist(), last, words.tolist(), strict=True):
            # the prefix has no bytes of its own: the first piece of a text starts and counts one less
            end = (total[a:b] - (total[a] - width[a] + 1)).astype(np.int32)
            start = np.empty_like(end)
            start[0], start[1:] = 0, end[:-1]
            out[k] = (ids[a:b], start, end, "".join([decoded[x] for x in index[w:v]])[1:])
            a, w = b, v
        return out

    def _learn(self, words: list[str]) -> Iterator[tuple[bytes, bytes, str | None]]:
        """Per word, with the prefix before it, (ids, bytes of each piece, decoded text
        where it is not the word's own); no character map applies here, so the
        library's merging of single words is used."""
        for word, ids in zip(words, self.library.encode(words, num_threads=1), strict=True):
            text = None
            if min(ids) <= self.last_byte:
                text = self.decode([self.ids[SPACE], *ids])
            elif (own := "".join(map(self.pieces.__getitem__, ids)).replace(SPACE, " ")) != " " + word:
                text = own
            yield struct.pack(f"{len(ids)}i", *ids), bytes(map(self.widths.__getitem__, ids)), text

    @staticmethod
    def _byte_spans(width, start, end):
        start, end = start.copy(), end.copy()
        i, n = 0, len(width)
        zeros = np.flatnonzero(width == 0)
        done = -1
        for z in zeros.tolist():
            if z <= done:
                continue
            i = z
            while i < n and width[i] == 0:
                i += 1
            lo, hi, count = int(start[z]), int(end[i]), i - z + 1
            for j in range(count):
                start[z + j] = min(lo + j, hi)
                end[z + j] = min(lo + j + 1, hi) if j < count - 1 else hi
            done = i
        return start, end

    # -- decoding ------------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids: pieces joined, visible spaces back to
        spaces, one space of the dummy prefix dropped."""
        if not len(ids):
            return ""
        surface, byte_of = self.surface, self.byte_of
        arr = np.asarray(ids)
        low, high = min(byte_of, default=-1), max(byte_of, default=-2)
        if not ((arr >= low) & (arr <= high)).any():
            raw = b"".join([surface[i] for i in arr.tolist()])
            text = raw.decode()
        else:
            out: list[bytes] = []
            run: list[int] = []
            for i in arr.tolist():
                if i in byte_of:
                    run.append(byte_of[i])
                    continue
                if run:
                    out.append(_valid(bytes(run)))
                    run = []
                out.append(surface[i])
            if run:
                out.append(_valid(bytes(run)))
            text = b"".join(out).decode()
        if (self.dummy or self.squeeze) and self.kinds[int(arr[0])] == NORMAL and self.pieces[int(arr[0])].startswith(SPACE):
            text = text[1:]
        return text


def _valid(raw: bytes) -> bytes:
    """Byte pieces as UTF-8; each byte that fits no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode().encode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(b"\xef\xbf\xbd")
            at += 1
    return b"".join(out)


def _utf8_sizes(text: str) -> np.ndarray:
    """UTF-8 bytes of each code point."""
    if text.isascii():
        return np.ones(len(text), np.int64)
    cp = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF)


_MODELS: dict[bytes, Model] = {}


def _model(blob: bytes) -> Model:
    """One model (and its memory of segments) per Python worker."""
    if blob not in _MODELS:
        _MODELS.clear()
        _MODELS[blob] = Model(blob)
    return _MODELS[blob]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: (id, *carry, ids array<int>, span_start, span_end
    array<int>, decoded string).  The model file (a fixed half megabyte, read on
    the driver) travels with the task's code."""
    with open(model_path, "rb") as f:
        blob = f.read()
    keep = [id_col, *carry]
    own = text_col if text_col in keep else "__text"     # a carried text is sent once
    rows = docs.select(*keep) if own in keep else docs.select(*keep, F.col(text_col).alias(own))
    ddl = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep),
                     "ids array<int>, span_start array<int>, span_end array<int>, decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(blob)
        for whole in batches:
            for b in _slices(whole, own, 2_000_000):
                got = model.encode_all(b.column(own))
                decoded = [g[3] for g in got]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in keep), *(_lists([g[k] for g in got]) for k in range(3)),
                     pa.array(decoded, pa.string())], names=[*keep, "ids", "span_start", "span_end", "decoded"])

    return rows.mapInArrow(run, ddl)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _slices(batch: pa.RecordBatch, col: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each part are about ``most`` bytes."""
    size = np.array([x or 0 for x in pc.binary_length(batch.column(col)).to_pylist()], np.int64) \
        if batch.num_rows else np.zeros(0, np.int64)
    part = np.cumsum(size) // most
    at = 0
    while at < batch.num_rows:
        n = int(np.searchsorted(part, part[at], "right")) - at
        yield batch.slice(at, n)
        at += n
