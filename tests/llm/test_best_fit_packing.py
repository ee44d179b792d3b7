"""Packing: pieces against the tokenizer library, laws of sequences, and how many there are."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm.best_fit_packing import Island, Packing, WordTokens, best_fit, pack_documents, pack_pieces
from strata.llm.packing_query import SEQUENCE, op12_best_fit_packing

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def pieces(docs, size=SEQUENCE):
    t = Tokenizer.from_file(PATH)
    out = []
    for i, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), size)):
            part = ids[a:a + size]
            out.append((i, p, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check(rows, docs, size=SEQUENCE):
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, pieces(docs, size)))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_whole_table(spark, tables):
    d = tables("documents")
    docs = list(zip(d.doc_id.tolist(), [None if t != t else t for t in d.text], strict=True))
    rows = op12_best_fit_packing(spark, tables.path).collect()
    used = check(rows, docs)
    assert used <= -(-sum(r.length for r in rows) // SEQUENCE) + 1


def test_odd_texts(spark):
    texts = [None, "", " ", "\t\n", "Don't STOP 123", "á é ΣΑΣ İ", "x<|endoftext|>y <|startoftext|>", "日本語 テキスト", "\x1c\x1d x\x1fy", "no break　space",
             "😀🏳️‍🌈", "w" * 9000, "one two " * 3000, "same", "same", "é́ ́start", "a\r\nb\x85c d"]
    docs = [(None if k == 3 else k // 2, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, uid int, length int").repartition(3)
    check(pack_documents(frame, PATH).collect(), docs)
    check(pack_documents(frame, PATH, capacity=16).collect(), docs, 16)


def test_blocks_and_levels(spark):
    """Blocks far smaller than the input still end close to what the tokens need, and nothing is lost."""
    rnd = np.random.default_rng(5)
    lengths = np.concatenate([rnd.integers(1, 900, 3000), rnd.integers(900, 2048, 400), [2048] * 5])
    rows = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "uid bigint, length bigint").repartition(5)
    got = pack_pieces(rows, 2048, block=128).collect()
    assert sorted(r.uid for r in got) == list(range(len(lengths)))
    fill = defaultdict(int)
    for r in got:
        fill[r.sequence_id] += int(lengths[r.uid])
    assert max(fill.values()) <= 2048
    assert len(fill) <= 1.01 * -(-int(lengths.sum()) // 2048) + 1


def test_words_are_encoded_as_in_the_text(tables):
    d = tables("documents")
    with open(PATH, "rb") as f:
        tokens = WordTokens(f.read())
    assert tokens.by_word
    library = Tokenizer.from_file(PATH)
    texts = [t for t in d.text if t == t]
    for t, ids in zip(texts, tokens.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(5))
def test_crossover_keeps_every_piece_and_whole_bins(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 100, 300)
    island = Island(lengths, 100, (seed,))
    for _ in range(2):
        order = rnd.permutation(len(lengths)).tolist()
        bins = [0] * len(lengths)
        best_fit(lengths.tolist(), order, bins, [], 100)
        island.packings.append(Packing(np.array(bins), lengths))
    a, b = island.packings
    child = island.cross(a, b)
    assert len(child.bins) == len(lengths) and child.fill.max() <= 100
    assert (np.bincount(child.bins, weights=lengths) == child.fill).all()
    groups = {frozenset(np.flatnonzero(b.bins == k).tolist()) for k in range(len(b.fill))}
    own = {frozenset(np.flatnonzero(child.bins == k).tolist()) for k in range(len(child.fill))}
    assert len(groups & own) >= 1
    start = min(p.rank for p in island.packings)
    island.packings.sort(key=lambda p: p.rank)
    island.evolve(40)
    assert island.packings[0].rank <= start


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0
