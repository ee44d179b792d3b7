"""Every operator query on the whole small tables against its brute-force version."""

import pytest

from strata.llm import queries as q
from strata.llm.token_count import UNKNOWN_PENALTY, Vocabulary

from . import brute


@pytest.fixture(scope="module")
def docs(tables):
    d = tables("documents")
    return list(zip(d.doc_id.tolist(), [None if t != t else t for t in d.text], strict=True))


def by_id(df, *names):
    rows = df.collect()
    out = {r[0]: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def test_substring_dedup(spark, tables, docs):
    got = by_id(q.op1_substring_dedup(spark, tables.path), "n_words", "n_removed", "kept_sha256")
    assert got == brute.substring_dedup(docs)


def test_chat(spark, tables):
    c = tables("conversations")
    rows = [tuple(None if x != x else x for x in r) for r in c[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    rows += [(-1, 0, "user", q.EXTRA_CONVERSATION), (-1, 1, "assistant", q.EXTRA_CONVERSATION)]
    got = by_id(q.op2_chat_formatting(spark, tables.path), "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == brute.chat(rows)


def test_hilbert(spark, tables, docs):
    rows = q.op3_hilbert_sharding(spark, tables.path).collect()
    text = dict(docs)
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        assert r["size"] == len((text[r.doc_id] or "").encode()) + 1
        assert r.text_crc32 == brute.crc(text[r.doc_id])
    counts = []
    for k in range(q.N_SHARDS):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
        counts.append(len(slots))
    assert max(counts) - min(counts) <= 1
    order = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_token_counts(spark, tables, docs):
    v = Vocabulary.from_model(q.tokenizer_path())
    short = {i: t for i, t in docs if len(t or "") < 1500}
    got = by_id(q.op4_token_counts(spark, tables.path), "n_tokens", "n_unknown", "best_score")
    assert len(got) == len(docs)
    for i, t in list(short.items())[:60]:
        assert got[i] == brute.token_count(t, v.scores, v.fallback, v.lowest - UNKNOWN_PENALTY)


def test_simhash(spark, tables, docs):
    assert by_id(q.op5_simhash(spark, tables.path), "fingerprint", "component_id") == brute.simhash(docs)


def test_sentencepiece(spark, tables, docs):
    got = by_id(q.op6_sentencepiece(spark, tables.path), "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == brute.sentencepiece(docs, q.tokenizer_path())


def test_syncmers(spark, tables, docs):
    rows = q.op7_syncmer_fingerprints(spark, tables.path).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == brute.edited(docs)
    order = sorted(rows, key=lambda r: r.doc_id)
    text, of_text = dict(docs), {}
    for r in order:
        assert of_text.setdefault(text[r.doc_id] or "", r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        if a.fingerprint == b.fingerprint:
            assert a.near_next == 1
    long = [r for r in order if r.n_chars > 500]
    assert sum(r.near_edited for r in long) / len(long) > sum(r.near_next for r in long) / len(long) + 0.1


def test_warc(spark, tables):
    p = tables("pages")
    pages = list(zip(p.page_id.tolist(), [None if t != t else t for t in p.html], strict=True))
    got = by_id(q.op8_warc(spark, tables.path), "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == brute.warc(pages)


def test_decontamination(spark, tables, docs):
    got = {(r.doc_id, r.item_id) for r in q.op9_decontamination(spark, tables.path).collect()}
    b = tables("benchmark")
    plain = [" ".join(brute.words((t or "").lower())) for _, t in docs]
    exact = {(docs[k][0], i) for i, t in zip(b.item_id.tolist(), b.text, strict=True) for k, d in enumerate(plain)
             if len(brute.words(t)) >= 8 and " ".join(brute.words(t.lower())) in d}
    assert exact <= got


def test_quality(spark, tables, docs):
    rows = q.op10_quality(spark, tables.path).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    labels = dict(tables("labels")[["doc_id", "quality"]].itertuples(index=False))
    for r in rows:
        assert r.held_out == (brute.crc(str(r.doc_id)) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    wins = [(a > b) + 0.5 * (a == b) for a in good for b in bad]
    assert sum(wins) / len(wins) > 0.8
