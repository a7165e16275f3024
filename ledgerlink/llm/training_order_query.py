"""Query of the training order (no SQL: tokenizer and network; tests hold it against the tiktoken library and a plain network)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import training_order as op
from ledgerlink.llm.byte_bpe import read_ranks
from ledgerlink.llm.frames import scratch, stage, table
from ledgerlink.session import delete_on_exit

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
KEY = 20_240_613


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of every document at its slot, with a digest of its bytes as they are read back from the shards written."""
    path = public_tokenizers.path(VOCABULARY)
    texts = stage(op.encoded(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), "encoded")
    rows = op.in_training_order(texts, KEY, op.id_type(len(read_ranks(path))).itemsize)
    shards = scratch(spark, "training-shards")
    op.write_shards(rows, shards)
    delete_on_exit(spark, shards)
    return op.read_shards(spark, shards, rows).select("shard", "slot", F.col("id").alias("doc_id"), "sequence", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"))
