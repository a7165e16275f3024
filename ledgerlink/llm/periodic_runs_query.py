"""Query of the periodic runs (SQL can't extend squares to runs in bounded time; tests hold it against all (start, period) pairs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlink.llm import periodic_runs as op
from ledgerlink.llm.frames import table


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op.periodic_runs(docs, keep_text=False, rewrite=op.planted_period).select("doc_id", "runs.*")
