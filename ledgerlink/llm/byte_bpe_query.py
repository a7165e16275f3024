"""Query of the byte-level BPE (SQL can't merge pairs by rank; tests hold it against the tiktoken library)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import byte_bpe as op
from ledgerlink.llm.frames import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = op.encode(docs, path, public_tokenizers.PATTERN, keep_text=False)
    return op.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
