"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import queries as q
from strata.llm.hilbert import write_shards
from strata.llm.syncmers import anchor_positions, fingerprints, likeness, next_document

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, m string, fp bigint, component string"
LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
ROWS = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, LONG), (6, LONG), (6, LONG), (7, "one two"), (7, "three"),
        (None, "one two three four"), (None, None)]


def write(spark, path, rows):
    path = str(path)
    docs = [(i, t, None, "hot", None, "m", 1, "c") for i, t in rows]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, f"http://a/\r\n{i}", t) for i, t in rows], "page_id bigint, url string, html string") \
        .write.parquet(f"{path}/pages.parquet")
    talk = [(i, n, r, t) for i, t in rows for n, r in ((0, "system"), (1, "user"), (2, "assistant"), (None, None))]
    spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string") \
        .write.parquet(f"{path}/conversations.parquet")
    spark.createDataFrame([(9, None), (10, ""), (None, "w1 w2")], "item_id bigint, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, None if t is None else 1, 0) for i, t in rows], "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd") / "t", ROWS)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("none") / "t", [])


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_odd_rows(spark, odd, name):
    rows = q.QUERIES[name](spark, odd).collect()
    if name.startswith("op2_"):
        ids = {i for i, _ in ROWS} | {-1}
        assert len(rows) == len(ids) and {r.conv_id for r in rows} == ids
    elif name.startswith("op13_"):
        assert len(rows) == len({i for i, _ in ROWS}) and {r.conv_id for r in rows} == {i for i, _ in ROWS}
    elif name.startswith("op12_"):
        assert sorted(str(r.doc_id) for r in rows if r.piece == 0) == sorted(str(i) for i, _ in ROWS)
    elif name.startswith("op9_"):
        assert rows == []
    else:
        assert sorted(str(r[0]) for r in rows) == sorted(str(i) for i, _ in ROWS)


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_empty_tables(spark, none, name):
    assert q.QUERIES[name](spark, none).count() == (1 if name.startswith("op2_") else 0)


def test_repeats_and_ties(spark, odd):
    got = {(r.doc_id, r.n_words): r.n_removed for r in q.op1_substring_dedup(spark, odd).collect()}
    assert got[5, 60_000] == 0 and got[6, 60_000] == 60_000
    same = [r for r in q.op5_simhash(spark, odd).collect() if r.doc_id in (1, 2, 3)]
    assert {(r.fingerprint, r.component_id) for r in same} == {("0" * 16, 1)}


def test_stages(spark, odd, none):
    for path, least in ((odd, 1), (none, 0)):
        docs = spark.read.parquet(f"{path}/documents.parquet").select(*corpus_pipeline.DOC_COLUMNS)
        for name, apply in corpus_pipeline.STAGES:
            out = apply(spark, docs, path)
            assert (out.count() > 0) == bool(least), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
    one = corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{odd}/documents.parquet"), odd)
    kept = [(r.doc_id, r.text) for r in one.collect()]
    assert kept.count((5, LONG)) == 1 and (6, LONG) not in kept


def test_short_texts_have_own_fingerprints(spark):
    """5 or 6 symbols without a closed syncmer: the whole sequence is the anchor."""
    texts = [" ".join(f"a{i}n{n}x{j}" for j in range(n)) for n in (1, 4, 5, 6) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, " "])], "doc_id bigint, text string")
    got = {r.doc_id: tuple(r.sketch) for r in fingerprints(docs).collect()}
    assert got.pop(len(texts)) == got.pop(len(texts) + 1) == ()
    assert () not in got.values() and len(set(got.values())) == len(texts)


def test_unspaced_near_copy(spark):
    """One inserted character leaves most anchors of a text without spaces."""
    run = "".join(chr(0x4E00 + (i * i * 7919 + i * 31) % 20_000) for i in range(2_000))
    docs = spark.createDataFrame([(run, run[:40] + "x" + run[40:])], "a string, b string")
    two = fingerprints(fingerprints(docs, "a", "x"), "b", "y")
    assert two.select(likeness(F.col("x"), F.col("y"))).first()[0] > 0.8


def test_written_shards(spark, tmp_path):
    """Every row, null ids and repeats too, is in the files, dealt by law ``rows``."""
    rows = [(None, "a"), (None, "b"), (None, None), *[(7, "again")] * 30, *[(i, f"t{i}") for i in range(60)]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars int")
    write_shards(docs, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    counts = {r.shard: r["count"] for r in back.groupBy("shard").count().collect()}
    assert len(counts) == 8 and max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("limit", [0, 40])
def test_long_conversations_are_streamed(spark, odd, monkeypatch, limit):
    """Conversations over the limit are never one row, and have the same digests."""
    whole = sorted(map(str, q.op2_chat_formatting(spark, odd).collect()))
    monkeypatch.setattr(q, "LONG_CONVERSATION", limit)
    rows, gathered = q._chat_digests, []
    monkeypatch.setattr(q, "_chat_digests", lambda read: gathered.append(read.select("conv_id")) or rows(read))
    assert sorted(map(str, q.op2_chat_formatting(spark, odd).collect())) == whole
    assert not {r.conv_id for g in gathered for r in g.collect()} & {5, 6}


def test_next_document_over_bucket_ends(spark):
    """The first row of the next bucket follows a bucket's last one, without a join by the bucket's formula: on
    0.6 GB the optimizer put that formula on the side of the join that lacks its column."""
    rows = [(None if i % 10 == 0 else i // 2, None if i % 7 == 0 else f"t{i} " * (i % 5)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    order = sorted(docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect(),
                   key=lambda r: (-(2**63) if r.doc_id is None else r.doc_id, r.h))
    want = [(r.doc_id, r.text, n.text) for r, n in zip(order, order[1:] + order[:1], strict=True)]
    for size in (4, 1000):
        got = next_document(docs, "doc_id", "text", rows_per_bucket=size)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.splitlines() if "Join" in x and "__bucket" in x]


def test_anchors_by_definition(spark):
    """Closed syncmers and their hashes, symbol by symbol, for several lengths."""
    words = [f"w{(i * i) % 23}" for i in range(90)]
    docs = spark.createDataFrame([(n, " ".join(words[:n])) for n in (0, 3, 5, 6, 90)], "doc_id bigint, text string")
    for k, s in ((5, 2), (4, 3), (7, 3), (8, 2)):
        got = {(r.doc_id, r.pos) for r in anchor_positions(docs, k=k, s=s).collect()}
        run = "xxhash64(x[i], x[i + 1])" if s == 2 else "xxhash64(xxhash64(x[i], x[i + 1]), xxhash64(x[i + 1], x[i + 2]))"
        hashes = docs.selectExpr("doc_id", "transform(filter(split(text, ' '), w -> w != ''), w -> xxhash64(w)) AS x").selectExpr(
            "doc_id", f"CASE WHEN size(x) >= {s} THEN transform(sequence(0, size(x) - {s}), i -> {run}) ELSE array() END AS h")
        want = set()
        for i, h in hashes.collect():
            for p in range(len(h) - (k - s)):
                inner = h[p:p + k - s + 1]
                if min(inner) in (inner[0], inner[-1]):
                    want.add((i, p))
        assert got == want


def test_texts_go_to_python_once(spark, odd):
    """A carried text is not sent (and shuffled) a second time as bytes."""
    docs = spark.read.parquet(f"{odd}/documents.parquet").select(*corpus_pipeline.DOC_COLUMNS)
    rest = tuple(c for c in docs.columns if c != "doc_id")
    model = q.quality_model(spark, docs, odd)
    for out in (q.score_documents(docs, model, carry=tuple(docs.columns)), q.substring_dedup(docs, q.MIN_WORDS, carry=rest),
                q.encode_documents(docs, q.tokenizer_path(), carry=("text",))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "text" in out.columns and "__t" not in plan.split("MapInArrow")[1].split("\n")[0]
        assert "AS __t#" not in plan.replace("__th", "") and "AS __text#" not in plan
    plain = {(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in q.substring_dedup(docs, q.MIN_WORDS).collect()}
    assert plain == {(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in q.substring_dedup(docs, q.MIN_WORDS, carry=rest).collect()}
