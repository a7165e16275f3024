"""Query of the sharding (its table is filled turn by turn, which SQL can't say at this size; tests hold it against a plain version)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import sharding as op
from ledgerlink.llm.frames import scratch, table
from ledgerlink.session import delete_on_exit

SHARDS = [f"shard-{i:03d}" for i in range(100)]


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard, read back from the shards that all documents are written to, and its shard once shard-000 is gone."""
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), scratch(spark, "shards")
    written = op.write_shards(docs, path, ["doc_id"], SHARDS, ["doc_id", "text"])
    delete_on_exit(spark, path)
    fewer = op.place(written.select("doc_id", "slot", "shard"), ["doc_id"], SHARDS[1:], slot_col="slot_again", shard_col="shard_without_first")
    return fewer.select("doc_id", "slot", "shard", "shard_without_first", (F.col("shard") != F.col("shard_without_first")).alias("moves"))
