"""Registry upserts driven by Structured Streaming.

Staged registry rows (the 14-column schema) landing as parquet files in a folder are
merged into the registry one micro-batch at a time with ``foreachBatch``; each batch
rewrites only the partitions its keys fall into.  Of several rows with one key the newest
by ``last_updated_ts`` counts, within a batch and against the registry, so a batch
replayed after a failure or arriving late changes nothing that is newer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.operators.upsert import keep_one_per_key
from ledgerlink.schemas import REGISTRY_SCHEMA
from ledgerlink.sources import store


def _merge_micro_batch(registry: str):
    def merge(batch: DataFrame, epoch_id: int) -> None:
        # newest row per key: order by the negated timestamp (as epoch micros); undated rows last
        newest = batch.withColumn("_age", F.coalesce(-F.unix_micros(F.col("last_updated_ts")), F.lit(2**62)))
        staged = keep_one_per_key(newest, ["_age"]).drop("_age")
        store.upsert_registry(batch.sparkSession, registry, staged, newer_by="last_updated_ts")
    return merge


def start_registry_stream(spark: SparkSession, staged_dir: str, registry: str, checkpoint_location: str,
                          available_now: bool = True):
    """Start the stream; with ``available_now`` it drains what is there and stops."""
    store.create_registry(spark, registry)
    source = spark.readStream.schema(REGISTRY_SCHEMA).parquet(staged_dir)
    writer = (source.writeStream.foreachBatch(_merge_micro_batch(registry))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
