"""Query of the cross-tokenizer alignment operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .common import table
from .tokenizer_align import align_documents


def op11_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    a, b = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    documents, _ = align_documents(table(spark, sf_dir, "documents"), a, b, digest=True)
    return documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                            documents["groups"].alias("groups_sha256"))
