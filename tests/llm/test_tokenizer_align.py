"""Alignment against token-by-token Python over whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders

from strata.llm import tokenizer_align
from strata.llm.align_query import op11_tokenizer_alignment
from strata.llm.tokenizer_align import SPARSE, align_documents, byte_alphabet, dense, members, multiplicities, planes

A, B = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(docs):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_alphabet()
    out, linked, holders = [], [], Counter()
    for i, t in docs:
        ia = a.encode(" " + (t or ""), add_special_tokens=False).ids
        ib = b.encode(t or "")
        ba = [bytes(letters[c] for c in a.id_to_token(k)) for k in ia]
        bb = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ib]
        if not t or b"".join(ba) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            out.append([i, 0, 0, 0, ""])
            linked.append(Counter())
            continue
        ends = [set(np.cumsum([len(x) for x in y]).tolist()) for y in (ba, bb)]
        cut = sorted(ends[0] & ends[1])
        groups, pa, pb, xa, xb = [], 0, 0, 0, 0
        for c in cut:
            one = ([], [])
            while xa < c:
                one[0].append(ia[pa])
                xa += len(ba[pa])
                pa += 1
            while xb < c:
                one[1].append(ib[pb])
                xb += len(bb[pb])
                pb += 1
            groups.append(one)
        links = Counter()
        for x, y in groups:
            cx, cy = Counter(x), Counter(y)
            for p in cx:
                for q in cy:
                    links[p, q] += cx[p] * cy[q]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append([i, len(ia), len(ib), len(groups), hashlib.sha256(text.encode()).hexdigest()])
        linked.append(links)
        holders.update(links.keys())
    top = defaultdict(int)
    for (p, _), n in holders.items():
        top[p] = max(top[p], n)
    rows = []
    for (i, na, nb, ng, sha), links in zip(out, linked, strict=True):
        rows.append((i, na, nb, ng, sum(links.values()), sum(n for k, n in links.items() if holders[k] == top[k[0]]),
                     sum(n * holders[k] for k, n in links.items()), sha))
    return rows


def test_whole_table(spark, tables):
    d = tables("documents")
    docs = list(zip(d.doc_id.tolist(), [None if t != t else t for t in d.text], strict=True))
    got = [tuple(r[n] for n in ("doc_id", *NAMES)) for r in op11_tokenizer_alignment(spark, tables.path).collect()]
    assert sorted(got) == sorted(brute(docs))


def test_odd_texts(spark):
    texts = [None, "", " ", "  two  spaces ", "a\n\nb \n c", "\ttab", "<|endoftext|> </s> <0x41>", "▁", "x▁y", "naïve façade Ünïcödé", "日本語 テキスト",
             "😀😀 🏳️‍🌈", "a" * 5000, "ab" * 3000, "=" * 400, "don't we'll I'm", "\x1c\x1d x", "é é", "A B　C", "1234567890 3.14",
             "same words here", "same words here", "\x00zero", "end ", " start", "tail\n", " line"]
    docs = [(None if k == 4 else k // 2, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, pair int, box int").repartition(3)
    rows = align_documents(frame, A, B, digest=True)[0].withColumnRenamed("groups", "groups_sha256").collect()
    got = [tuple(r[n] for n in ("doc_id", *NAMES)) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, brute(docs)))


def test_alignment_text_and_scores(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "the dog the"), (3, "")], "doc_id bigint, text string")
    documents, scores = align_documents(docs, A, B)
    text = {r.doc_id: r.groups for r in documents.collect()}
    assert text[3] == "" and text[1].count("|") == text[1].count(";") + 1
    the = text[1].split(";")[0].split("|")
    found = scores.filter((F.col("a_id") == int(the[0])) & (F.col("b_id") == int(the[1]))).first()
    assert (found.documents, found.best) == (2, True)


def test_bitmaps():
    rnd = np.random.default_rng(1)
    for n in (1, 7, 8, 9, SPARSE, SPARSE + 1, 5000, 65_536):
        slots = np.sort(rnd.choice(1 << 16, n, replace=False)).astype(np.uint16)
        raw = dense(slots) if n > SPARSE else slots.tobytes()
        assert (members(raw) == slots).all()
        times = rnd.integers(1, 300, n)
        assert (multiplicities(planes(times, times.max()), n) == times).all()


def test_byte_alphabet_decodes_as_the_library():
    letters = byte_alphabet()
    assert sorted(letters.values()) == list(range(256))
    for c, b in letters.items():
        if b < 128:
            assert decoders.ByteLevel().decode([c]) == chr(b)


def test_empty_table(spark):
    assert align_documents(spark.createDataFrame([], "doc_id bigint, text string"), A, B)[0].count() == 0


def test_memory_keeps_words_met_again(spark, monkeypatch):
    """A full memory drops the words that were not met lately, not those of every slice."""
    monkeypatch.setattr(tokenizer_align, "MEMORY", 40)
    with open(A, "rb") as f, open(B, "rb") as g:
        aligner = tokenizer_align.Aligner(f.read(), g.read())
    learnt, align = Counter(), aligner.align
    monkeypatch.setattr(aligner, "align", lambda words: learnt.update(words) or align(words))
    slices = [["the cat sat on the mat " + " ".join(f"w{k}x{j}" for j in range(15))] for k in range(30)]
    fresh = []
    for texts in slices:
        fresh += list(aligner.texts(texts))
    assert learnt["the"] == learnt["mat"] == 1
    monkeypatch.setattr(tokenizer_align, "MEMORY", 10_000)
    with open(A, "rb") as f, open(B, "rb") as g:
        other = tokenizer_align.Aligner(f.read(), g.read())
    assert fresh == list(other.texts([t for s in slices for t in s]))
