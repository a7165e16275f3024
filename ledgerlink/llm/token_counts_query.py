"""Query of the token counts (SQL has no tokenizer; tests hold it against the tiktoken library and a plain version)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import token_counts as op
from ledgerlink.llm.frames import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, a token across lines going to the one with most of its bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = op.section_tokens(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return found.select(F.col("id").alias("doc_id"), F.col("section").cast("long").alias("line"), "start", "end", (F.col("tokens") / 1000).cast("long").alias("n_tokens"), "text_tokens")
