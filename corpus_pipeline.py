"""Corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows the next one gets, which ``run`` writes as Parquet to the
shared folder and rereads.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BATCH, DOC_COLUMNS, id_key, stage, table
from strata.llm.decontaminate import contaminated
from strata.llm.quality import score_documents
from strata.llm.queries import ACCEPT, MAX_BITS, MIN_WORDS, SHINGLE, quality_model, tokenizer_path
from strata.llm.simhash import simhash_components
from strata.llm.sp_codec import encode_documents
from strata.llm.substring_dedup import substring_dedup


def _rest(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c != "doc_id")


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score >= ACCEPT)."""
    scored = score_documents(docs, quality_model(spark, docs, sf_dir), carry=tuple(docs.columns), out="__score")
    return stage(scored.filter(F.col("__score") >= ACCEPT).select(docs.columns), "accepted", BATCH)


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id (null last, then by text hash) of each
    SimHash component; of repeated rows one."""
    keyed = docs.withColumn("__k", id_key(F.col("doc_id"))).withColumn("__h", F.xxhash64("text"))
    groups = simhash_components(keyed, SHINGLE, MAX_BITS, carry=("__k", "__h"))
    keep = groups.groupBy("class").agg(F.min(F.struct("__k", "__h")).alias("r")).select("r.*")
    return keyed.join(keep, ["__k", "__h"]).dropDuplicates(["__k", "__h"]).select(docs.columns)


def passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start in an earlier document; a text that
    loses nothing stays as it is."""
    cut = substring_dedup(docs, MIN_WORDS, carry=_rest(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    kind = docs.schema["n_chars"].dataType
    return (cut.withColumn("text", text)
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
            .select(docs.columns))


def decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy, exact or edited, of a benchmark item."""
    keyed = docs.withColumn("__k", id_key(F.col("doc_id"))).withColumn("__h", F.xxhash64("text"))
    found = contaminated(keyed, table(spark, sf_dir, "benchmark"), carry=("__k", "__h")).select("__k", "__h").distinct()
    return keyed.join(found, ["__k", "__h"], "left_anti").select(docs.columns)


def tokens(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the byte span of each in the text, and a check that they decode to the text."""
    coded = encode_documents(docs, tokenizer_path(), carry=("lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", "text", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        "span_start", "span_end", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_dedup), ("substring dedup", passages),
          ("benchmark decontamination", decontamination), ("SentencePiece encoding and decoding", tokens)]

#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOC_COLUMNS)
    for k, (_, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"stage{k}", BATCH)
    return docs
