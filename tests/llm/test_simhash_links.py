"""Segment tables against all pairs of fingerprints, at every radius and with hot segment values."""

import random

import pytest

import corpus_pipeline
from strata.llm import simhash


def values():
    r = random.Random(5)
    out = {0, 2**64 - 1, 2**63, 3 << 62}
    for _ in range(12):
        x = r.getrandbits(64)
        out |= {x} | {x ^ sum({1 << r.randrange(64) for _ in range(n)}) for n in (1, 2, 3, 4, 5, 6) for _ in range(3)}
    hot = r.getrandbits(32)                      # many fingerprints share their lower or upper half
    out |= {hot | r.getrandbits(8) << 32 | r.getrandbits(4) << 60 for _ in range(60)}
    out |= {hot << 32 | r.getrandbits(20) for _ in range(60)}
    return sorted(out)


@pytest.mark.parametrize("segments, bits", [(4, 0), (4, 1), (4, 2), (4, 3), (4, 5), (5, 2), (5, 4), (5, 5), (2, 2), (1, 1), (3, 3)])
@pytest.mark.parametrize("hot", [2, 64])
def test_all_links(spark, monkeypatch, segments, bits, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    fps = values()
    signed = {simhash._signed(x): x for x in fps}
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = {(r.src, r.dst): r.bits for r in simhash.simhash_links(frame, bits, segments).collect()}
    order = sorted(signed)
    want = {(b, a): (signed[a] ^ signed[b]).bit_count() for k, b in enumerate(order) for a in order[:k]
            if (signed[a] ^ signed[b]).bit_count() <= bits}
    assert got == want


def test_bad_arguments(spark):
    frame = spark.createDataFrame([(1,)], "fp bigint")
    for bits, segments in ((2, 0), (2, 65), (-1, 4), (9, 2)):
        with pytest.raises(ValueError):
            simhash.simhash_links(frame, bits, segments)


def test_rows_without_id_are_not_linked_by_it(spark):
    """One row without id is a copy of document 5, the others are texts of their own, all kept by the stage."""
    rows = [(5, "a b c d e"), (None, "a b c d e"), (None, "one two three four"), (None, "w x y z"), (7, "k l m n"), (7, "p q r s t")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars int")
    got = [(r.doc_id, r.component_id) for r in simhash.simhash_components(docs).collect()]
    assert sorted(got, key=str) == sorted([(5, 5), (None, 5), (None, None), (None, None), (7, 7), (7, 7)], key=str)
    kept = corpus_pipeline.near_dedup(spark, docs, "").select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == sorted(rows[:1] + rows[2:], key=str)
