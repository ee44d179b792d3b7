"""Alignment of two tokenizers over a corpus, with corpus-wide link scores kept
as inverted pair bitmaps.

Tokenizer A is a byte-level BPE, tokenizer B a piece BPE that adds a space before
the text; both give back the bytes of ``" " + text``.  Byte offsets where tokens of
both end cut a text into groups; every A token of a group is linked with every B
token of it.

Method.  A task numbers its documents in containers of at most 65,536 documents and
about ``POSTINGS`` postings.  For each linked id pair it writes one row: the
documents of the container that hold the pair as a compressed bitmap (16-bit
numbers, or 65,536 bits where that is shorter) and, where a document holds it more
than once, the multiplicities as bit planes over the bitmap's members.  Containers
have no document in common, so the bitmaps of a pair are merged by their container
number and its document count is the sum of their popcounts.  Counts and each A id's
highest count are joined to the rows by pair and sent back by container, where the
postings add them up per document: no row per link or per (pair, document) is ever
moved, and a pair that every document holds is a row per container.

Both tokenizers work on each word and the space before it alone (checked on the
models; others are given whole texts), so words are encoded and aligned once and
remembered, about ``MEMORY`` of them in a worker, those met last.

Defined results: a text that is null, empty or not given back exactly by both
tokenizers has no tokens: zeros and an empty alignment.  Repeated rows are documents
of their own.  Control strings inside texts are plain text.  A group's links are
kept as distinct id pairs with multiplicities, so a long group of few ids is small.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .common import Memory, stage
from .sp_codec import SPACE, Model, _slices

POSTINGS = 2_000_000
CONTAINER = 1 << 16
SPARSE = CONTAINER // 16 - 1         # members up to which 16-bit numbers are shorter than the bits
MEMORY = 250_000
BLANK = re.compile(r" (?:\s|\Z)")    # an empty part, or one that starts with white space
B_BITS = 24                          # of a pair: A id, then B id


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the other bytes in ascending order for U+0100 and on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Groups and links of texts; ``a_file`` is a tokenizers JSON, ``b_file`` a
    sentencepiece model (their bytes)."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import json

        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letters = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in range(self.b.vocab_size())]
        self.a_width = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_width = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_text = np.array([f"{i}{end}".encode() for i in range(len(self.a_bytes)) for end in ",|"], object)
        self.b_text = np.array([f"{i}{end}".encode() for i in range(len(self.b_bytes)) for end in ",;"], object)
        self.a_digits, self.b_digits = (np.array([len(x) for x in y], np.int64) for y in (self.a_text, self.b_text))
        spec = json.loads(a_file)
        self.by_word = (spec["normalizer"] is None and spec["pre_tokenizer"] ==
                        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
        try:
            own = Model(b_file)
            self.by_word &= bool(own.dummy) and not own.squeeze and not own.map.firsts
        except ValueError:                                    # a kind of model whose words are not apart
            self.by_word = False
        self.known = Memory(MEMORY)

    # -- words ---------------------------------------------------------------
    def words(self, text: str) -> list[str]:
        """Parts whose encodings, each with a space before it, make the text's: a
        part ends before a single space that a visible character follows."""
        if not self.by_word:
            return [text]
        parts = text.split(" ")
        if not text[0].isspace() and not BLANK.search(text):
            return parts
        out, before = [], ""
        for k, p in enumerate(parts):
            if k and (not p or not before or p[0].isspace()):
                out[-1] += " " + p
            else:
                out.append(p)
            before = p
        return out

    def _a_ids(self, words: list[str], joint: int) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of the words and how many each has; the first ``joint`` words are
        encoded as one text and cut at their byte ends."""
        if joint:
            ids = np.array(self.a.encode(" " + " ".join(words[:joint]), add_special_tokens=False).ids, np.int64)
            ends = np.cumsum(self.a_width[ids])
            want = np.cumsum(_sizes(words[:joint]))
            at = np.searchsorted(ends, want)
            if at[-1] == len(ends) - 1 and (ends[at] == want).all():
                rest, n = self._a_ids(words[joint:], 0)
                return np.concatenate([ids, rest]), np.concatenate([np.diff(at, prepend=-1), n])
        own = [self.a.encode(" " + w, add_special_tokens=False).ids for w in words]
        return _flat(own)

    def align(self, words: list[str]) -> list[tuple | bool]:
        """Per word (A tokens, B tokens, groups, links, alignment as text, linked
        pairs, their multiplicities); False where the bytes are not given back."""
        place = range(len(words))
        if self.by_word:                                      # visible words first
            seen = [bool(w) and not w[0].isspace() and not w[-1].isspace() for w in words]
            place = [k for k, x in enumerate(seen) if x] + [k for k, x in enumerate(seen) if not x]
            words = [words[k] for k in place]
        ia, n_a = self._a_ids(words, sum(seen) if self.by_word else 0)
        ib, n_b = _flat(self.b.encode(words, num_threads=1))
        out: list[tuple | bool] = [False] * len(words)
        good = self._given_back(words, ia, n_a, ib, n_b)
        if not good.any():
            return out
        if not good.all():
            ia, ib = ia[np.repeat(good, n_a)], ib[np.repeat(good, n_b)]
            n_a, n_b = n_a[good], n_b[good]
        ends_a, ends_b = np.cumsum(self.a_width[ia]), np.cumsum(self.b_width[ib])
        cut = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a]
        cut = cut[np.concatenate(([True], cut[1:] != cut[:-1]))]
        ga, gb = np.searchsorted(cut, ends_a), np.searchsorted(cut, ends_b)
        na, nb = np.bincount(ga, minlength=len(cut)), np.bincount(gb, minlength=len(cut))
        sa, sb = np.cumsum(na) - na, np.cumsum(nb) - nb

        # text: the tokens of both in group order
        codes = np.empty(len(ia) + len(ib), object)
        last_a, last_b = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
        last_a[sa + na - 1] = 1
        last_b[sb + nb - 1] = 1
        digits = np.empty(len(codes), np.int64)
        for at, text, width, of in ((np.arange(len(ia)) + sb[ga], self.a_text, self.a_digits, 2 * ia + last_a),
                                    (np.arange(len(ib)) + (sa + na)[gb], self.b_text, self.b_digits, 2 * ib + last_b)):
            codes[at], digits[at] = text[of], width[of]
        codes, ends_text = b"".join(codes.tolist()), np.cumsum(digits)

        # links: small groups by index arithmetic, others by their distinct ids
        many = na * nb > 64
        links = np.where(many, 0, na * nb)
        g = np.repeat(np.arange(len(cut)), links)
        at = np.arange(len(g)) - np.repeat(np.cumsum(links) - links, links)
        pair = (ia[sa[g] + at // nb[g]] << B_BITS) | ib[sb[g] + at % nb[g]]
        times = np.ones(len(pair), np.int64)
        if many.any():
            pairs, counts, owner = [pair], [times], [g]
            for k in np.flatnonzero(many).tolist():
                xa, ca = np.unique(ia[sa[k]: sa[k] + na[k]], return_counts=True)
                xb, cb = np.unique(ib[sb[k]: sb[k] + nb[k]], return_counts=True)
                pairs.append(((xa[:, None] << B_BITS) | xb[None]).ravel())
                counts.append((ca[:, None] * cb[None]).ravel())
                owner.append(np.full(len(pairs[-1]), k))
            pair, times, g = np.concatenate(pairs), np.concatenate(counts), np.concatenate(owner)
            order = np.argsort(g, kind="stable")
            pair, times, g = pair[order], times[order], g[order]

        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        groups = ga[to_a - 1] + 1                             # groups up to each word's end
        to_link = 8 * np.searchsorted(g, groups)
        total = np.concatenate(([0], np.cumsum(na * nb)))[groups]
        pairs, counts = pair.tobytes(), times.tobytes()
        wt = wl = 0
        for k, a, b, n, links, et, el in zip(np.flatnonzero(good).tolist(), n_a.tolist(), n_b.tolist(), np.diff(groups, prepend=0).tolist(),
                                             np.diff(total, prepend=0).tolist(), ends_text[to_a + to_b - 1].tolist(), to_link.tolist(), strict=True):
            out[place[k]] = a, b, n, links, codes[wt:et], pairs[wl:el], counts[wl:el]
            wt, wl = et, el
        return out

    def _given_back(self, words: list[str], ia: np.ndarray, n_a: np.ndarray, ib: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Whether both tokenizers give the bytes of each word and the space before it."""
        want = (" " + " ".join(words)).encode()
        ends = np.cumsum(_sizes(words))
        same, found = [], []
        for ids, n, pieces, width in ((ia, n_a, self.a_bytes, self.a_width), (ib, n_b, self.b_bytes, self.b_width)):
            found.append(b"".join([pieces[i] for i in ids.tolist()]))
            same.append(np.concatenate(([0], np.cumsum(width[ids])))[np.cumsum(n)])
        if found[0] == want == found[1] and (same[0] == ends).all() and (same[1] == ends).all():
            return (n_a > 0) & (n_b > 0)
        good = np.zeros(len(words), bool)
        x = y = z = 0
        for k, (a, b, e) in enumerate(zip(same[0].tolist(), same[1].tolist(), ends.tolist(), strict=True)):
            good[k] = found[0][x:a] == want[z:e] == found[1][y:b]
            x, y, z = a, b, e
        return good

    def texts(self, texts: list[str | None]) -> Iterator[tuple | None]:
        """:meth:`align`'s tuple of whole texts."""
        cut = [self.words(t) if t else [] for t in texts]
        distinct = list({w for words in cut for w in words})
        known = dict(zip(distinct, self.known.fetch(distinct, self._learn), strict=True))
        if max(len(self.known.young), len(self.known.old)) > MEMORY or not self.by_word:
            self.known = Memory(MEMORY)                       # one slice held more words than the memory may
        whole = all(known.values())
        for t, words in zip(texts, cut, strict=True):
            parts = [known[w] for w in words]
            if not whole and False in parts and len(words) > 1:   # judge the whole text
                parts = self.align([t])
            if not parts or not whole and False in parts:
                yield None
                continue
            n_a, n_b, groups, links, text, pairs, times = zip(*parts, strict=True)
            yield sum(n_a), sum(n_b), sum(groups), sum(links), b"".join(text)[:-1], b"".join(pairs), b"".join(times)

    def _learn(self, words: list[str]) -> Iterator[tuple | bool]:
        for k in range(0, len(words), 20_000):
            yield from self.align(words[k: k + 20_000])


def _sizes(words: list[str]) -> np.ndarray:
    """UTF-8 bytes of each word and the space before it."""
    return np.fromiter([1 + (len(w) if w.isascii() else len(w.encode())) for w in words], np.int64, len(words))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(lists), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))


class _Container:
    """Postings of up to 65,536 documents: (pair, document, multiplicity)."""

    def __init__(self, number: int):
        self.number, self.docs, self.size = number, 0, 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, pairs: bytes, times: bytes) -> None:
        key = (np.frombuffer(pairs, np.int64) << 16) | self.docs
        self.docs += 1
        order = np.argsort(key, kind="stable")
        key, n = key[order], np.frombuffer(times, np.int64)[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        self.keys.append(key[first])
        self.times.append(np.add.reduceat(n, first))
        self.size += len(first)

    def rows(self) -> dict[str, list]:
        if not self.keys:
            return {"pair": [], "members": [], "bitmap": [], "planes": []}
        key, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        slots = (key & 0xFFFF).astype(np.uint16)
        pair = key >> 16
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        ends = [*first[1:].tolist(), len(key)]
        most = np.maximum.reduceat(times, first).tolist()
        starts = first.tolist()
        raw = slots.tobytes()
        return {"pair": pair[first].tolist(), "members": [e - s for s, e in zip(starts, ends, strict=True)],
                "bitmap": [raw[2 * s: 2 * e] if e - s <= SPARSE else dense(slots[s:e]) for s, e in zip(starts, ends, strict=True)],
                "planes": [planes(times[s:e], m) if m > 1 else b"" for s, e, m in zip(starts, ends, most, strict=True)]}


def dense(slots: np.ndarray) -> bytes:
    bits = np.zeros(CONTAINER, bool)
    bits[slots] = True
    return np.packbits(bits).tobytes()


def planes(times: np.ndarray, most: int) -> bytes:
    """Bit planes of the multiplicities, lowest first, over the members in order."""
    return b"".join(np.packbits(times >> p & 1).tobytes() for p in range(int(most).bit_length()))


def members(bitmap: bytes) -> np.ndarray:
    if len(bitmap) == CONTAINER // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8)))
    return np.frombuffer(bitmap, np.uint16)


def multiplicities(raw: bytes, n: int) -> np.ndarray | int:
    if not raw:
        return 1
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, (n + 7) // 8), axis=1)[:, :n].astype(np.int64)
    return (bits << np.arange(len(bits))[:, None]).sum(axis=0)


_LOADED: dict[tuple[bytes, bytes], Aligner] = {}


def _aligner(a_file: bytes, b_file: bytes) -> Aligner:
    """One aligner (and its memory of words) per Python worker."""
    if (a_file, b_file) not in _LOADED:
        _LOADED.clear()
        _LOADED[a_file, b_file] = Aligner(a_file, b_file)
    return _LOADED[a_file, b_file]


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                    digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, scores).

    ``documents``: one row per input row: id, n_a, n_b, n_groups, n_links, groups
    (the alignment as text, ``a1,a2|b1;a3|b2``; its SHA-256 with ``digest``, '' without
    tokens), n_best (links whose pair is its A id's most frequent) and count_sum
    (sum of the links' document counts).  ``scores``: a_id, b_id, documents, best.
    The tokenizer files travel with the task's code."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        a_file, b_file = f.read(), g.read()
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    counts = ("n_a", "n_b", "n_groups", "n_links")
    schema = StructType([StructField("__id", rows.schema["__id"].dataType), *StructType.fromDDL(
        "is_doc boolean, box bigint, slot int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
        "pair bigint, members bigint, bitmap binary, planes binary").fields])
    arrow = to_arrow_schema(schema)

    def batch(n: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns
             else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_file, b_file)
        serial = TaskContext.get().partitionId() << 32
        box = _Container(serial)

        def pairs():
            r = box.rows()
            n = len(r["pair"])
            return batch(n, r | {"is_doc": [False] * n, "box": [box.number] * n}) if n else None

        for whole in batches:
            for part in _slices(whole, "__text"):
                out: dict[str, list] = {c: [] for c in ("box", "slot", *counts, "groups")}
                full = []
                for got in aligner.texts(part.column("__text").to_pylist()):
                    if box.docs == CONTAINER or box.size >= POSTINGS:
                        full.append(pairs())
                        box = _Container(box.number + 1)
                    out["box"].append(box.number)
                    if got is None:
                        values, text, slot = (0, 0, 0, 0), "", -1
                    else:
                        values, slot = got[:4], box.docs
                        text = hashlib.sha256(got[4]).hexdigest() if digest else got[4].decode()
                        box.add(got[5], got[6])
                    out["slot"].append(slot)
                    for c, v in zip(counts, values, strict=True):
                        out[c].append(v)
                    out["groups"].append(text)
                yield batch(part.num_rows, out | {"__id": part.column("__id"), "is_doc": [True] * part.num_rows})
                yield from (x for x in full if x is not None)
        if (rest := pairs()) is not None:
            yield rest

    found = stage(rows.mapInArrow(run, schema), "aligned")
    bitmaps = found.filter("NOT is_doc").select("box", "pair", "members", "bitmap", "planes")
    a_id, b_id = F.shiftright("pair", B_BITS), F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    merged = bitmaps.groupBy("pair").agg(F.sum("members").alias("documents")).select("*", a_id.alias("a_id"))
    merged = stage(merged, "merged")
    top = merged.groupBy("a_id").agg(F.max("documents").alias("top"))
    scores = merged.join(top, "a_id").select("pair", "documents", (F.col("documents") == F.col("top")).alias("best"))
    sums = StructType.fromDDL("box bigint, slot int, n_best bigint, count_sum bigint")
    back = (bitmaps.join(scores, "pair").select("box", "bitmap", "planes", "documents", "best")
            .repartition("box").sortWithinPartitions("box").mapInArrow(_return_scores(to_arrow_schema(sums)), sums))
    documents = (found.filter("is_doc").select(F.col("__id").alias(id_col), "box", "slot", *counts, "groups")
                 .join(back, ["box", "slot"], "left")
                 .select(id_col, *counts, "groups", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                         F.coalesce("count_sum", F.lit(0)).alias("count_sum")))
    return documents, scores.select(a_id.cast("int").alias("a_id"), b_id.cast("int").alias("b_id"), "documents", "best")


def _return_scores(schema: pa.Schema):
    """Rows of a container, one after the other -> the scores of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, best, total = None, None, None

        def done():
            slots = np.flatnonzero(total)                     # every linked document has a count of at least 1
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(slots), box), pa.int64()), pa.array(slots, pa.int32()),
                                               pa.array(best[slots]), pa.array(total[slots])], schema=schema)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for number, bitmap, raw, documents, top in zip(*columns, strict=True):
                if number != box:
                    if box is not None:
                        yield done()
                    box, best, total = number, np.zeros(CONTAINER, np.int64), np.zeros(CONTAINER, np.int64)
                slots = members(bitmap)
                n = multiplicities(raw, len(slots))
                total[slots] += n * documents
                if top:
                    best[slots] += n
        if box is not None:
            yield done()

    return run
