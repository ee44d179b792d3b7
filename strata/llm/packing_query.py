"""Query of the packing operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .best_fit_packing import pack_documents
from .common import table

SEQUENCE = 2048


def op12_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack_documents(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")), SEQUENCE)
