"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole table
and derives digest columns from the operator's own output.  Where SQL has no
entry, ``tests/llm`` checks the query against a brute-force version.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .align_query import op11_tokenizer_alignment
from .chat_format import chat_windows, read_loss, read_turns
from .common import key_of, stage, table
from .decontaminate import contaminated
from .hilbert import hilbert_shards
from .packing_query import op12_best_fit_packing
from .quality import QualityModel, fit_quality, score_documents
from .repair_query import OP13_SQL, op13_conversation_repair
from .simhash import simhash_components
from .sp_codec import encode_documents
from .substring_dedup import substring_dedup
from .syncmers import edited_fingerprints, fingerprint_text, likeness
from .token_count import Vocabulary, count_tokens
from .warc import archive_round_trip

PIECES = "piece_bpe_32k.model"
N_SHARDS = 8
MIN_WORDS = 50
SHINGLE, MAX_BITS = 3, 2
ACCEPT = 0.7
LONG_CONVERSATION = 32_000_000       # bytes; longer ones are digested as a stream, not in one row
EXTRA_CONVERSATION = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str = PIECES) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _hex(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return (substring_dedup(table(spark, sf_dir, "documents"), MIN_WORDS)
            .select("doc_id", "n_words", "n_removed", _hex(F.col("kept_text")).alias("kept_sha256")))


def op2_chat_formatting(spark, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    extra = spark.sql("SELECT -1 AS conv_id, t.turn, t.role, :text AS text FROM VALUES (0, 'user'), (1, 'assistant') "
                      "AS t(turn, role)", {"text": EXTRA_CONVERSATION})
    names = ["conv_id", "turn", "role", "text"]
    kinds = {c: conv.schema[c].dataType for c in names}
    rows = conv.select(names).unionByName(extra.select([F.col(c).cast(kinds[c]) for c in names]))
    ck = key_of("ck", F.col("conv_id"))
    size = sum(F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in ("role", "text")) + 2
    long = rows.groupBy(ck).agg(F.sum(size).alias("b")).filter(F.col("b") > LONG_CONVERSATION).select("ck")
    if long.isEmpty():
        return _chat_digests(_chat_read(rows))
    long = F.broadcast(stage(long, "long"))              # at most one in LONG_CONVERSATION bytes of the table
    keyed = rows.withColumn("ck", ck)
    return _chat_digests(_chat_read(keyed.join(long, "ck", "left_anti"))).unionByName(
        _chat_digests_streamed(_chat_read(keyed.join(long, "ck", "left_semi"))))


def _chat_read(rows: DataFrame) -> DataFrame:
    """What the windows of ``rows`` give back, a row each."""
    windows = chat_windows(rows)
    own = read_turns(F.col("formatted"), F.col("n_context"))
    return windows.select(
        "ck", "conv_id", "block", "span", F.size(own).cast("bigint").alias("n"),
        F.concat_ws("", F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss")).alias("target"),
        F.char_length("formatted").cast("bigint").alias("chars"))


def _chat_digests(read: DataFrame) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("block", "span", "turns", "target")))
    whole = read.groupBy("ck").agg(F.max("conv_id").alias("conv_id"), F.sum("n").alias("n_turns"), parts.alias("p"),
                                   F.sum("chars").alias("formatted_chars"))
    target = F.concat_ws("", F.transform("p", lambda x: x["target"]))
    return whole.select(
        "conv_id", "n_turns", _hex(F.concat_ws("", F.transform("p", lambda x: x["turns"]))).alias("turns_sha256"),
        F.char_length(target).cast("bigint").alias("loss_chars"), _hex(target).alias("loss_sha256"), "formatted_chars")


def _chat_digests_streamed(read: DataFrame) -> DataFrame:
    """:func:`_chat_digests` with a running digest per conversation, for those
    that are too long for one row; a task holds one window batch at a time."""
    def run(batches):
        key, state = None, None

        def done():
            conv_id, n, turns, chars, loss, formatted = state
            return pa.RecordBatch.from_pydict({
                "conv_id": [conv_id], "n_turns": [n], "turns_sha256": [turns.hexdigest()], "loss_chars": [chars],
                "loss_sha256": [loss.hexdigest()], "formatted_chars": [formatted]}, schema=schema)

        for batch in batches:
            for ck, conv_id, n, turns, target, loss_chars, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ck != key:
                    if state:
                        yield done()
                    key, state = ck, [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += n
                state[2].update(turns)
                state[3] += loss_chars
                state[4].update(target)
                state[5] += chars
        if state:
            yield done()

    kind = read.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    rows = read.repartition("ck").sortWithinPartitions("ck", "block", "span")
    rows = rows.select("ck", "conv_id", "n", F.col("turns").cast("binary"), F.col("target").cast("binary"),
                       F.char_length("target").cast("bigint").alias("loss_chars"), "chars")
    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                "loss_sha256 string, formatted_chars bigint")


def op3_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    return (hilbert_shards(table(spark, sf_dir, "documents"), N_SHARDS)
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "curve"))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), Vocabulary.from_model(tokenizer_path()))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return (simhash_components(table(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return (encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())
            .select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                    _hex(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
                    _hex(F.col("decoded")).alias("decoded_sha256")))


def op7_syncmer_fingerprints(spark, sf_dir: str) -> DataFrame:
    return (edited_fingerprints(table(spark, sf_dir, "documents"))
            .select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), _hex(F.col("edited")).alias("edited_sha256"),
                    fingerprint_text(F.col("fp")).alias("fingerprint"),
                    fingerprint_text(F.col("edited_fp")).alias("edited_fingerprint"),
                    likeness(F.col("fp"), F.col("edited_fp")).cast("double").alias("near_edited"),
                    likeness(F.col("fp"), F.col("next_fp")).cast("double").alias("near_next")))


def op8_warc(spark, sf_dir: str) -> DataFrame:
    return (archive_round_trip(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_model(spark, docs: DataFrame, sf_dir: str) -> QualityModel:
    """Fitted on the labels of ids that are not held out."""
    labels = table(spark, sf_dir, "labels")
    return fit_quality(docs, labels.filter(~_held_out(F.col("doc_id"))))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (score_documents(docs, quality_model(spark, docs, sf_dir))
            .select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= ACCEPT).cast("int").alias("predicted")))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_chat_formatting, op3_hilbert_sharding, op4_token_counts, op5_simhash, op6_sentencepiece,
    op7_syncmer_fingerprints, op8_warc, op9_decontamination, op10_quality, op11_tokenizer_alignment,
    op12_best_fit_packing, op13_conversation_repair)}

#: Windows of 50 words by their own text; every word under a window whose words also start in a smaller document goes.
_OP1 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM win JOIN firsts USING (h) WHERE doc_id > m),
kept AS (
  SELECT t.doc_id, count(*) AS n, string_agg(t.x, ' ' ORDER BY t.p) AS k
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM words) t
  ANTI JOIN gone ON gone.doc_id = t.doc_id AND gone.p = t.p GROUP BY t.doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

#: The payload digest needs base32 of SHA-1: each 5 bits of the 160 (as 40 hex digits) pick a letter.
_OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((('0x' || substr(h, CAST(1 + 10 * (i // 8) AS INT), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) AS INT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM p JOIN g USING (h)
"""

ORACLE = {"op1_substring_dedup": _OP1, "op8_warc": _OP8, "op13_conversation_repair": OP13_SQL}
